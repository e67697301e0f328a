import hashlib
import math
import random

import pytest

from crowdpulse.llm import vector_codes as vc

DDL = "vec_id long, embedding array<double>, label int, vector string, code int, error string"


def plain(rows, positions=8, entries=16, rounds=6):
    """Lloyd's rounds over all rows, in plain integers."""
    kept = [(i, v, la) for i, v, la in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = {}
    for i, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        first.setdefault(i, v)
    size = len(next(iter(first.values())))
    width = -(-size // positions)

    def parts(v):
        ints = [math.floor(4096 * x) for x in v] + [0] * (width * positions - size)
        return [ints[p * width:(p + 1) * width] for p in range(positions)]

    cut = [parts(v) if len(v) == size else None for _, v, _ in kept]
    books = [[parts(v)[p] for v in list(first.values())[:entries]] for p in range(positions)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(positions):
            groups = {}
            for c in cut:
                if c:
                    groups.setdefault(near(c[p], books[p])[1], []).append(c[p])
            for k, own in groups.items():
                books[p][k] = [sum(col) // len(own) for col in zip(*own)]
    out, totals = [], {}
    for (i, v, la), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(positions)] if c else None
        err = sum(d for d, _ in found) if c else None
        totals[la] = totals.get(la, 0) + (err or 0)
        out.append((i, "".join(f"{k:02x}" for _, k in found) if c else None, err, la))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted([(i, code, err, totals[la], digest, la) for i, code, err, la in out], key=str)


def rows(seed, n, size=24):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(size)] for _ in range(30)]
    data = [(i, [x + rng.gauss(0, 0.05) for x in rng.choice(centres)], rng.choice([None, 1, 2, 3])) for i in range(n)]
    data += [data[4]] * 3 + [(900 + i, data[7][1], 1) for i in range(150)]  # repeated rows, and one vector under many ids
    data += [(2000, None, 1), (2001, [None] + [0.1] * (size - 1), 1), (2002, [float("nan")] + [0.1] * (size - 1), None),
             (2003, [float("inf")] * size, 2), (2004, [-float("inf")] * size, 2), (None, data[9][1], None), (None, data[10][1], 3)]
    rng.shuffle(data)
    return data


def frame(spark, data):
    return spark.createDataFrame([(i, v, la, "x", 1, "y") for i, v, la in data], DDL).repartition(5)


def got(df):
    return sorted([tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256", "label")) for r in df.collect()], key=str)


@pytest.mark.parametrize("size", [24, 21])
def test_codes_against_plain_lloyd(spark, size):
    data = rows(size, 300, size)
    assert got(vc.digests(frame(spark, data))) == plain(data)


def test_other_lengths_keep_their_row(spark):
    data = rows(5, 60) + [(500, [0.5] * 7, 2), (501, [], None)]
    have = got(vc.digests(frame(spark, data)))
    assert have == plain(data)
    assert [r[1:3] for r in have if r[0] in (500, 501)] == [(None, None)] * 2


def test_few_and_no_vectors(spark):
    few = [(5, [0.25] * 16, None), (3, [-0.25] * 16, 1), (3, [-0.25] * 16, 1)]
    assert got(vc.digests(frame(spark, few))) == plain(few)
    assert vc.digests(frame(spark, [(1, None, 1), (2, [float("nan")] * 8, 1)])).count() == 0
    assert vc.digests(spark.createDataFrame([], DDL)).count() == 0


def test_books_do_not_depend_on_partitions_and_decode_near(spark):
    vectors = vc.kept_vectors(frame(spark, rows(8, 200))).select("vec_id", "vector")
    books = vc.fit(vectors)
    assert books.digest() == vc.fit(vectors.repartition(2)).digest()
    huge = vc.fit(vectors, positions=4, entries=3, rounds=2)
    assert huge.entries.shape == (4, 3, 6)
    back = vc.decode(vc.encode(vectors.withColumn("given", vectors.vector), books), books).collect()
    for r in back:
        assert abs(sum((math.floor(4096 * a) - 4096 * b) ** 2 for a, b in zip(r.given, r.vector)) - r.error) < 1e-6


def test_only_parts_that_change_entry_move(spark):
    vectors = vc.kept_vectors(frame(spark, rows(11, 200))).select("vec_id", "vector")
    books = vc.first_books(vectors, 8, 16)
    state = vc.dealt(vectors.select("vector"), books, 6, 2)
    n = state.getNumPartitions()
    now = vc.updated(state, books.entries)
    split = vc.compared(state, now, n).cache()
    members = split.map(lambda x: (x[2], int(x[1][4].sum()))).reduceByKey(lambda a, b: a + b).collectAsMap()
    assert members[True] + members[False] == 8 * vectors.count() and 0 < members[False] < members[True]
    at = split.filter(lambda x: x[2]).mapPartitionsWithIndex(lambda i, xs: [i == x[0] == vc.owner(*x[1][:3], n) for x in xs]).collect()
    assert at and all(at)
