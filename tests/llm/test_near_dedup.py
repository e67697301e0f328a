import random

import numpy as np
import pytest
from corpus import frame, rows, words

from crowdpulse.llm import near_dedup as nd


def shingles(text, k):
    w = [x.lower() for x in (text or "").encode().split()]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(data, k, percent):
    """doc_id -> smallest reachable id, by comparing all pairs."""
    ids = sorted({i for i, _ in data if i is not None})
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(i, shingles(t, k)) for i, t in data if i is not None]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("p", [nd.CONTRACT, nd.Params()])
def test_groups_equal_all_pairs(spark, p):
    rng = random.Random(4)
    data = [d for d in rows() if d[0] != 7 or "another" not in (d[1] or "")]
    base = words(rng, 60).split()
    for i in range(40):     # a chain of near copies, some nearer to a neighbour than to any pivot
        w = list(base)
        for j in rng.sample(range(60), rng.randint(0, 5)):
            w[j] = f"edit{i}x{j}"
        data.append((1000 + i, " ".join(w)))
    got = nd.near_duplicates(frame(spark, data), p).collect()
    assert len(got) == len(data)
    want = brute(data, p.words, p.percent)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (want[r.doc_id] == r.doc_id)
    sizes = {i: len(shingles(t, p.words)) for i, t in data if i is not None}
    assert all(r.n_shingles == sizes[r.doc_id] for r in got if r.doc_id is not None)


def test_texts_that_repeat_an_id_and_empty_table(spark):
    df = frame(spark, rows())
    assert nd.near_duplicates(df).count() == df.count()
    assert nd.near_duplicates(df.limit(0)).count() == 0
    kept = nd.drop_near_duplicates(df)
    assert kept.columns == df.columns and kept.where("doc_id is null").count() == 2


def test_pivots_that_miss_are_made_up_for_by_the_prefix_join(spark):
    """Two pairs in one bucket: neither pair is near the pivot of the other."""
    rng = random.Random(9)
    common = words(rng, 40)
    one, two = common + " " + words(rng, 25), common + " " + words(rng, 25)
    data = [(1, one), (2, one + " z"), (3, two), (4, two + " y"), (5, common)]
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(frame(spark, data), nd.Params(rows=1, bands=40)).collect()}
    assert got == brute(data, 5, 80)


def test_registers_agree_as_often_as_sets_overlap():
    rng = np.random.RandomState(0)
    signer = nd.Signer(nd.Params())
    agree, estimate = [], []
    for _ in range(200):
        h = np.unique(rng.randint(0, 2**63, size=300).astype(np.uint64) * np.uint64(2))
        a, b = np.sort(h[:-30]), np.sort(h[30:])
        x, y = signer.registers(a), signer.registers(b)
        agree.append((x == y).mean())
        estimate.append(nd.corrected_similarity(x, y))
    assert abs(np.mean(agree) - 240 / 300) < 0.02 and abs(np.mean(estimate) - 240 / 300) < 0.02
    far = [nd.corrected_similarity(signer.registers(np.sort(rng.randint(0, 2**63, size=50).astype(np.uint64))),
                                   signer.registers(np.sort(rng.randint(0, 2**63, size=50).astype(np.uint64)))) for _ in range(100)]
    assert np.mean(far) < 0.01
