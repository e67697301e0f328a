"""Recovered digests against sets, and sketches that are too small at first."""

import random

from pyspark.sql import functions as F

from crowdpulse.llm import fingerprints as fp


def _pairs(spark, sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for i, (both, a, b) in enumerate(sizes):
        ks = rng.sample(range(1 << 31), both + a + b)
        x, y = ks[:both + a], ks[:both] + ks[both + a:]
        rng.shuffle(x)
        rng.shuffle(y)
        rows.append((i, x, y))
    return rows, spark.createDataFrame(rows, "id int, a array<int>, b array<int>")


def test_recovered_digests_are_the_difference(spark):
    sizes = [(0, 0, 0), (5, 0, 0), (0, 1, 0), (50, 3, 4), (200, 0, 9), (3, 40, 40), (1000, 30, 1), (0, 700, 650), (10, 0, 500), (400, 25, 25), (0, 3000, 2)]
    rows, df = _pairs(spark, sizes)
    got = {r.id: r for r in fp.compare(df, ["id"], "a", ["b"]).collect()}
    for i, a, b in rows:
        assert (set(got[i].only_a_b), set(got[i].only_b)) == (set(a) - set(b), set(b) - set(a))
        assert len(got[i].only_a_b) + len(got[i].only_b) == len(set(a) ^ set(b))


def test_base_fails_and_a_larger_sketch_succeeds(spark):
    rows, df = _pairs(spark, [(20, 60, 50)] * 8)
    base = df.select("id", fp.peeled(fp.subtracted(fp.sketch(F.col("a")), fp.sketch(F.col("b"))), fp.BASE).alias("found"))
    assert all(r.found is None for r in base.collect())
    kept = df.withColumns({"size": F.lit(512), "c": F.lit(1)})
    larger = {r.id: r for r in fp.peel_larger(kept.repartition(3, "id"), ["id"], 1).collect()}
    for i, a, b in rows:
        assert larger[i].open == 0 and {(x.k, x.c) for x in larger[i].found} == {(k, 1) for k in set(a) - set(b)} | {(k, -1) for k in set(b) - set(a)}


def test_larger_sketches_double_until_all_pairs_are_solved(spark, monkeypatch):
    monkeypatch.setattr(fp, "ROOM", 0.05)       # the first larger sketch is far too small
    rows, df = _pairs(spark, [(5, 90, 80), (0, 300, 300), (50, 1, 0)], 4)
    got = {r.id: set(r.only_a_b) | set(r.only_b) for r in fp.compare(df, ["id"], "a", ["b"]).collect()}
    assert got == {i: set(a) ^ set(b) for i, a, b in rows}


def test_difference_is_the_sketches_subtracted_and_estimates_fit(spark):
    rows, df = _pairs(spark, [(30, 20, 25), (0, 60, 60), (90, 2, 3)] * 5, 7)
    both = df.select(fp.difference(F.col("a"), F.col("b"), 8).alias("x"), fp.subtracted(fp.sketch(F.col("a")), fp.sketch(F.col("b"))).alias("y"),
                     fp.estimate(fp.difference(F.col("a"), F.col("b")), F.col("a"), F.col("b")).alias("about")).collect()
    assert all(r.x == r.y for r in both)
    for want, at in ((45, 0), (120, 1), (5, 2)):
        mean = sum(r.about for r in both[at::3]) / 5
        assert 0.5 * want <= mean <= 1.6 * want
