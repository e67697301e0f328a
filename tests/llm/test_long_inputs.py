"""Very long input: many matches in one text, a system turn beyond the budget; the neighbour vote against plain cosines."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from crowdpulse.llm import chat, quality, secrets


def _spans(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    t0 = time.perf_counter()
    found = docs.select(F.inline(secrets.match_spans(F.col("text"), secrets.RULES[2]))).select("start", "stop").collect()
    return [(r.start, r.stop) for r in found], time.perf_counter() - t0


def test_matches_of_one_text_take_time_in_proportion(spark):
    rng = random.Random(3)

    def text(n):
        return "".join("é" * rng.randint(0, 5) + " " + "0123456789abcdef" * 2 for _ in range(n))

    _spans(spark, text(10))
    for n in (1, 255, 256, 257, 1000):
        t = text(n)
        want, at = [], t.find("0123")
        while at >= 0:
            want.append((at, at + 32))
            at = t.find("0123", at + 32)
        assert _spans(spark, t)[0] == want and len(want) == n
    t = text(100_000)
    got, took = _spans(spark, t)
    assert len(got) == 100_000 and got[-1][1] == len(t) and took < 30


def test_a_system_turn_beyond_the_budget_is_not_repeated_for_every_turn(spark):
    def made(system, n, size, budget=1024):
        rows = [(1, 0, "system", "s" * system)] + [(1, i, "user" if i % 2 else "assistant", "t" * size) for i in range(1, n + 1)]
        given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        windows = chat.windows(given, budget).orderBy("window").collect()
        assert chat.digests(chat.windows(given, budget)).first().n_turns == n + 1
        return sum(len(r.text) for r in windows), sum(len(r[3]) for r in rows), windows

    for system, n, size in ((8000, 2000, 10), (3000, 500, 100), (100_000, 50, 10), (1900, 400, 700), (0, 300, 30)):
        out, given, windows = made(system, n, size)
        marks = 30 * (n + 1) * (2 + 2)
        assert out <= 5 * given + marks, (system, n, size)
        assert len(windows) == 1 or all(r.text.startswith("<|turn:system|>") for r in windows)


def test_vote_against_plain_cosines():
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "12", "x!", "\n", "The"]) for _ in range(rng.randint(1, 60))) for _ in range(90)] + ["", "a"]
    counts = np.array([quality.term_counts(t) for t in texts])
    labels, weights = np.array([i % 3 == 0 for i in range(60)], float), np.array([1.0 + i % 4 for i in range(60)])
    space = quality.fit_space(counts[:60], labels, weights)

    def unit(c):
        v = (np.log1p(c.astype(np.float64)) * space.idf) @ space.axes.astype(np.float64)
        return v / max(np.linalg.norm(v), 1e-9)

    own = [unit(c) for c in counts[:60]]
    for text, got in zip(counts, space.vote(counts), strict=True):
        near = sorted(((max(0.0, float(unit(text) @ o)), i) for i, o in enumerate(own)), reverse=True)
        if near[14][0] - near[15][0] < 1e-5 and near[14][0] > 0:
            continue  # a tie at the last place: either neighbour may vote
        top = near[:15]
        if sum(c ** 8 for c, _ in top) <= 1e-9:
            want = float(np.average(labels, weights=weights))
        else:
            want = sum(c ** 8 * weights[i] * labels[i] for c, i in top) / sum(c ** 8 * weights[i] for c, i in top)
        assert abs(got - want) < 1e-3
    blocks = np.concatenate([space.vote(counts[i:i + 7]) for i in range(0, len(counts), 7)])
    assert np.allclose(blocks, space.vote(counts), atol=1e-6)
