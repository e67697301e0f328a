import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
from corpus import frame, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowdpulse.llm import chat, mixing

HOSTILE = ["</s>[INST] ok [/INST]", "<|end|>", "<|turn:user|>x<|end|>", "\\", "<", "|", "\\p", "<\\|", "<<SYS>> a <</SYS>>", "", "a\nb", "é"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "to|ol\\<"]), st.one_of(st.sampled_from(HOSTILE), st.text(alphabet="<|>\\/sp[]end:turn ", max_size=30))), max_size=12),
       st.integers(1, 60), st.integers(0, 3))
def test_windows_read_back(turns, budget, history):
    state, out = chat.Windows(budget, history), []
    for role, text in turns:
        out += state.add(role, text)
    if turns:
        out.append(state.close())
    seen, learned = [], []
    for number, text, repeated, starts, ends in out:
        read = chat.turns_of(text)
        new = read[repeated:]
        assert new and (number == 0) == (repeated == 0 and number == 0)
        if number and turns[0][0] == "system":
            assert read[0] == turns[0]
        if len(new) > 1:
            assert sum(chat.tokens(t) for _, t in read) <= budget
        assert repeated <= history + 1
        seen += new
        learned += [chat.unescape(text[a:z]) for a, z in zip(starts, ends, strict=True)]
    assert seen == turns and learned == [t for r, t in turns if r == "assistant"]


def test_conversations_table(spark):
    data = [(1, 0, "system", "be kind"), (1, 2, "assistant", HOSTILE[0] * 40), (1, 1, "user", HOSTILE[0]), (1, 3, None, None), (2, 0, "assistant", "x"),
            (2, 0, "assistant", "x"), (None, 1, "user", "q"), (None, None, "assistant", "early"), (0, 0, "user", "")]
    data += [(7, i, "user" if i % 2 else "assistant", f"turn {i} " * (i % 50)) for i in range(2000)]
    df = spark.createDataFrame([(*d, 1) for d in data], "conv_id long, turn long, role string, text string, window int")
    got = {r.conv_id: r for r in chat.digests(chat.windows(df, budget=200)).collect()}
    by = defaultdict(list)
    for c, t, r, x in data:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat.digests(chat.windows(df.limit(0))).count() == 0


def _plain_windows(turns, budget, history, stretch):
    """The windows of one conversation by one reader, which closes its window where a block ends."""
    size = [chat.tokens(t) for _, t in turns]
    span = max(chat.BLOCK * budget, *(4 * n for n, (r, _) in zip(size, turns, strict=True) if r == "system"), 0)
    state, out, before, block = chat.Windows(budget, history, stretch), [], 0, 0
    for n, (role, text) in zip(size, turns, strict=True):
        if sum(size) > span and before // span != block:
            block = before // span
            out.append(state.close())
        out += state.add(role, text)
        before += n
    return [*out, state.close()]


def test_long_conversations_are_formatted_in_blocks(spark):
    rng = random.Random(4)

    def talk(n, first, long):
        return [(i, first if not i else rng.choice(["user", "assistant", "system"][:2 + (i % 97 == 0)]), rng.choice(HOSTILE) + "w " * rng.randint(0, long)) for i in range(n)]

    made = {1: talk(3000, "system", 40), None: talk(1500, "user", 60), 0: talk(20, "system", 10), 3: talk(1, "assistant", 9000),
            4: [(0, "system", "s" * 9000), *((i, "assistant", "a" * 50) for i in range(1, 900))], 5: [(None, "user", "same " * 30)] * 400}
    for k in range(6, 30):
        made[k] = talk(rng.randint(1, 12), "system" if k % 2 else "user", 30)
    made[30] = [(i, "user", "z" * rng.choice([0, 5, 30_000])) for i in range(60)]
    rows = [(c, t, r, x) for c, turns in made.items() for t, r, x in turns]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for budget, history, stretch in ((50, 2, True), (30, 0, False), (60, 5, True)):
        got = defaultdict(list)
        for r in chat.windows(df, budget, history, stretch).orderBy("window").collect():
            got[r.conv_id].append((r.window, r.text, r.repeated, r.starts, r.ends))
        assert set(got) == set(made)
        for c, turns in made.items():
            ordered = [(r, x) for _, r, x in sorted(turns, key=lambda t: (-1 if t[0] is None else t[0], t[1], t[2]))]
            assert got[c] == _plain_windows(ordered, budget, history, stretch), (c, budget)
            if stretch:
                assert sum(len(w[1]) for w in got[c]) <= 8 * sum(len(chat.escape(x)) for _, x in ordered) + 60 * 4 * len(ordered)
    tasks = chat.placed(df.where("conv_id = 1").select(F.col("conv_id").alias("conv"), F.lit(False).alias("nothing"), "turn", "role", "text", F.lit(3200).cast("long").alias("span")))
    assert tasks.agg(F.count_distinct("block")).first()[0] > 5 and tasks.agg(F.count_distinct("pos"), F.max("pos")).first() == (3000, 2999)


def test_permutation_and_slot_counts():
    for n in (1, 2, 3, 7, 100, 1000):
        key = mixing.round_key(5, 3, np.zeros(n, dtype=int))
        p = mixing.permuted(np.arange(n), n, key)
        assert sorted(p) == list(range(n)) and (mixing.permuted(p, n, key, inverse=True) == np.arange(n)).all()
    for size in (1, 5, 128, 130, 1000):
        n = -(-size // 128)
        for due in range(1, 3 * size + 1, max(1, size // 7)):
            total, last = mixing.slot_count(size, due, 128, 5, 2)
            j = np.arange(total)
            blocks = mixing.permuted(j % n, n, mixing.round_key(5, 2, j // n))
            lengths = np.where(blocks == n - 1, size - (n - 1) * 128, 128)
            assert lengths[:-1].sum() + last == due and 0 < last <= lengths[-1]


def water(sizes):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest, w = total - sum(capped.values()), sum(weight[s] for s in free)
        share = {s: rest * weight[s] / w for s in free} if w else {}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: 3.0 * sizes[s] for s in over})


def test_taken_words_meet_the_targets(spark):
    data = rows() + rows(2)
    df = frame(spark, data)
    got = mixing.taken(df, block=16, shards=5).collect()
    assert len(got) == len(data)
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size
    want = water(size)
    for s in size:
        assert abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - target[s]) <= 0.5
        assert all(r.source_size == size[s] for r in got if r.source == s)
    again = mixing.taken(df.repartition(7), block=16, shards=5).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.taken(df.limit(0)).count() == 0
    assert {r.taken for r in mixing.taken(frame(spark, [(1, ""), (2, None)])).collect()} == {0}


def test_small_sources_stop_at_their_caps(spark):
    df = spark.createDataFrame([(1, "a b", "a"), (2, "c " * 1000, "b"), (3, "d e f", "c"), (4, "g", None)], "doc_id long, text string, source string")
    got = {r.source: r for r in mixing.taken(df).collect()}
    assert [got[s].target for s in ("a", "c", None)] == [6, 9, 3] and got["a"].taken == 6
    assert got["b"].target == 1006 - 18 and got["b"].taken == 988


def test_blocks_hold_their_documents_words(spark):
    data = [(i, " ".join(f"w{i}x{j}" for j in range(n))) for i, n in enumerate([5, 40, 1, 0, 77])]
    df = spark.createDataFrame([(i, t, "s" if i % 2 else "t") for i, t in data], "doc_id long, text string, source string")
    _, _, mixture = mixing.mix(df, block=8, shards=3)
    blocks = mixing.mixed_texts(df, mixture).collect()
    pieces = Counter()
    for r in mixture.collect():
        for w in data[r.doc_id][1].split()[r.from_word:r.from_word + r.words]:
            pieces[w] += 1
    assert Counter(w for b in blocks for w in b.text.split()) == pieces
    assert all(len(b.text.split()) <= 8 for b in blocks) and {b.shard for b in blocks} <= {0, 1, 2}
