"""Near-duplicate groups by HyperMinHash, every link confirmed on the full shingle sets.

Signature. A shingle's 64-bit hash picks one of the registers by its leading bits; the register keeps the smallest
remainder, stored as a leading-zero count and ten mantissa bits. An empty register borrows from the next full one in
its own fixed random order, so that two texts agree in any register with a probability equal to their sets' similarity.

Candidates. ``bands`` groups of ``rows`` registers are hashed; texts that share a band meet in a bucket. Texts of equal
shingle sets are one class from the start, so copies never meet. A bucket does not emit its pairs: its members are
compared to one pivot, the member that meets the most others over all its buckets, which in a family of near
copies is the text nearest to all. Registers estimate each pair's similarity, corrected for chance agreement of
registers; only clear misses are spared the exact check.

Links the pivots miss. Where a bucket still spans several components, the texts in question are joined exactly: by their
rarest shingles first, two sets that are similar enough must share one of their first few (prefix filter), and only pairs
of different components are checked, against the rest of a shingle's list for members outside its largest component.
So no partner or candidate is capped anywhere.

Defined cases: words are split at ASCII blanks with A-Z lower-cased; a text of fewer words than a shingle is one
shingle; null or empty texts have an empty set and link with nothing, not even each other; repeated rows get the same
answer each; where rows share an id but not a text, one of them (the largest registers) stands for the id in the search; a
row with a null ``doc_id`` joins no group: its component is null and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.common import BROADCAST_BYTES, fold_docs, held_bytes, small, stash, without_ids, words_of

MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


@dataclass(frozen=True)
class Params:
    """``percent``: least similarity, in hundredths. The chance that all bands miss a pair at the threshold is
    (1 - s^rows)^bands: 7e-9 for 0.85 with rows 5 and bands 32, 7e-10 for 0.8 with rows 4 and bands 40."""
    words: int = 5
    percent: int = 80
    rows: int = 4
    bands: int = 40
    seed: int = 1

    @property
    def registers(self) -> int:
        return self.rows * self.bands


CONTRACT = Params(words=3, percent=85, rows=5, bands=32)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - k + 1)
    with np.errstate(over="ignore"):
        total = np.full(n, len(words) if len(h) < k else k, dtype=np.uint64)
        for i in range(min(k, len(h))):
            total = _mixed(total * MIX[3] + h[i:i + n] * MIX[0])
    return np.unique(total)


class Signer:
    """Registers of a shingle set; ``order[j]`` is the order in which empty register j asks the others."""

    def __init__(self, p: Params):
        self.p = p
        k = p.registers
        rng = np.random.RandomState(p.seed)
        self.order = np.argsort(rng.rand(k, k), axis=1)
        self.width = np.uint64((2**64 - 1) // k)
        self.edges = np.arange(k + 1, dtype=np.uint64) * self.width
        self.odd = (rng.randint(1, 2**62, size=(p.bands, p.rows)).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
        self.salt = _mixed(np.arange(1, p.bands + 1, dtype=np.uint64))

    def registers(self, hashes: np.ndarray) -> np.ndarray:
        """16 bits each: 6 of leading zeros, 10 of mantissa. ``hashes`` is sorted and not empty."""
        at = np.searchsorted(hashes, self.edges)
        at[-1] = len(hashes)
        full = at[1:] > at[:-1]
        low = hashes[np.minimum(at[:-1], len(hashes) - 1)] - self.edges[:-1]
        share = np.clip(low.astype(np.float64) / float(self.width), 2.0 ** -62, 1 - 2.0 ** -53)
        mantissa, exponent = np.frexp(share)    # share = mantissa * 2**exponent, mantissa in [0.5, 1)
        reg = ((-exponent).astype(np.int64) << 10 | ((mantissa - 0.5) * 2048).astype(np.int64)).astype(np.uint16)
        empty = np.flatnonzero(~full)
        step = 0
        while len(empty):
            ask = self.order[empty, step]
            found = full[ask]
            reg[empty[found]] = reg[ask[found]]
            empty = empty[~found]
            step += 1
        return reg

    def band_keys(self, reg: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            rows = _mixed(reg.astype(np.uint64) + np.uint64(1)).reshape(self.p.bands, self.p.rows)
            return _mixed((rows * self.odd).sum(axis=1, dtype=np.uint64) + self.salt)


def corrected_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Share of agreeing registers, less the share that agrees by chance (the registers' expected collisions)."""
    chance = float((_level_shares(a) * _level_shares(b)).sum()) / 1024
    return max(0.0, (float((a == b).mean()) - chance) / (1 - chance))


def _level_shares(reg: np.ndarray) -> np.ndarray:
    """How the registers spread over leading-zero counts; within a count the mantissas are even."""
    return np.bincount(reg >> 10, minlength=64)[:64] / len(reg)


def signatures(p: Params):
    """Text to (n shingles, digest of the set, registers); digest and registers of an empty set are null."""
    @F.pandas_udf("struct<n long, digest binary, reg binary>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        signer = Signer(p)
        for texts in batches:
            sets = [shingle_set(t, p.words) for t in texts]
            yield pd.DataFrame({"n": [len(s) for s in sets],
                                "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                                "reg": [signer.registers(s).tobytes() if len(s) else None for s in sets]})
    return sign


def _bands(p: Params):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        signer = Signer(p)
        for b in batches:
            if len(b):
                keys = np.concatenate([signer.band_keys(np.frombuffer(r, dtype=np.uint16)) for r in b["reg"]])
                yield pd.DataFrame({"bucket": keys.view(np.int64), "id": np.repeat(b["id"].to_numpy(), p.bands)})
    return run


def _estimated(p: Params, slack: float = 6.0):
    """Pairs that may reach the threshold: the estimate's error is allowed ``slack`` standard deviations."""
    least = p.percent / 100
    least -= slack * (least * (1 - least) / p.registers) ** 0.5

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = [corrected_similarity(np.frombuffer(x, dtype=np.uint16), np.frombuffer(y, dtype=np.uint16)) >= least
                    for x, y in zip(b["ra"], b["rb"], strict=True)]
            yield b.loc[keep, ["a", "b"]]
    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on the full sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return len(a) > 0 and len(b) > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _verified(p: Params):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, None         # pairs come sorted by a, whose set is then made once
        for b in batches:
            keep = []
            for a, ta, tb in zip(b["a"], b["ta"], b["tb"], strict=True):
                if a != last:
                    last, held = a, shingle_set(ta, p.words)
                keep.append(linked(held, shingle_set(tb, p.words), p.percent))
            yield b.loc[keep, ["a", "b"]]
    return run


def _shingle_rows(p: Params):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingle_set(t, p.words) for t in b["text"]]
            n = [len(s) for s in sets]
            if sets:
                yield pd.DataFrame({"id": np.repeat(b["id"].to_numpy(), n), "n": np.repeat(n, n), "h": np.concatenate(sets).view(np.int64)})
    return run


def confirm(pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold. ``texts``: id, text of each class's representative.

    A text that is the a of very many pairs is copied to ``a``'s salted parts, so no join key holds more than
    about a thousand pairs.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(1 << 20)))
    load = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("load")).withColumn("parts", F.ceil(F.col("load") / 1000).cast("int"))
    salted = salted.join(load.select("a", "parts"), "a").withColumn("part", (F.col("salt") % F.col("parts")).cast("int"))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta")).join(load.select("a", "parts"), "a")
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    both = salted.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").drop("salt", "parts")
    return (both.join(left, ["a", "part"]).select("a", "b", "ta", "tb").sortWithinPartitions("a")
            .mapInPandas(_verified(p), "a long, b long"))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of every linked id, the component's smallest id: rounds of hooking to the smallest
    neighbour and jumping along pointers, each round a table in the shared folder, until nothing changes."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = stash(both, f"{name}-links")
    at = stash(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("c")).withColumnRenamed("a", "id"), name)
    while True:
        to = at.select(F.col("id").alias("b"), F.col("c").alias("near"))
        hooked = both.join(to, "b").groupBy("a").agg(F.min("near").alias("near"))
        best = (at.join(hooked.withColumnRenamed("a", "id"), "id", "left")
                .select("id", F.least("c", F.coalesce("near", "c")).alias("best"), "c"))
        # every id that hangs on c may follow c's best: one hook moves its whole tree
        jump = best.groupBy("c").agg(F.min("best").alias("lower")).select(F.col("c").alias("k"), "lower")
        moved = best.join(jump, F.col("c") == F.col("k")).select("id", F.least("best", "lower").alias("m"), "c")
        root = moved.select(F.col("id").alias("m"), F.col("m").alias("up"))
        new = stash(moved.join(root, "m", "left").select("id", F.least("m", F.coalesce("up", "m")).alias("c"), F.col("c").alias("old")), name)
        changed = new.where("c <> old").limit(1).count()
        at = new.select("id", "c")
        if not changed:
            return at.withColumnRenamed("c", "component")


def _pivot_pairs(buckets: DataFrame) -> DataFrame:
    """(a, b): each bucket's members with its pivot, the member that meets the most others over all its buckets."""
    size = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = stash(buckets.join(size, "bucket"), "buckets")
    reach = met.groupBy("id").agg(F.sum("size").alias("reach"))
    pivots = (met.join(reach, "id").groupBy("bucket")
              .agg(F.max(F.struct("reach", (-F.col("id")).alias("minus"))).alias("top"))
              .select("bucket", (-F.col("top.minus")).alias("a")))
    return met.select("bucket", "id"), met.join(pivots, "bucket").where("a <> id").select("a", F.col("id").alias("b")).distinct()


def _cross_pairs(rows: DataFrame, p: Params) -> DataFrame:
    """Pairs of different components that share a shingle of either's prefix. ``rows``: id, component, n, h."""
    often = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    ranked = rows.join(often.where("df > 1"), "h")
    # shingles that no other text holds come first in every order; n minus the shared ones of them use up the prefix
    shared = ranked.groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
    room = F.col("n") - F.ceil(F.col("n") * p.percent / 100).cast("int") + 1 - (F.col("n") - F.col("shared"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "h"))
    prefix = stash(ranked.join(shared, "id").withColumn("room", room).where("room > 0").withColumn("place", place)
                   .where(F.col("place") <= F.col("room"))
                   .select("h", "id", "component", "n", (F.col("shared") - F.col("place") + 1).alias("rest")), "prefixes")
    per = prefix.groupBy("h", "component").agg(F.count(F.lit(1)).alias("k"))
    top = per.groupBy("h").agg(F.max(F.struct("k", "component")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    spread = prefix.join(top.select("h", F.col("top.component").alias("largest")), "h")
    outside = spread.where("component <> largest").select("h", F.col("id").alias("x"), F.col("component").alias("cx"), F.col("largest").alias("lx"), F.col("n").alias("nx"), F.col("rest").alias("rx"))
    mates = spread.select("h", F.col("id").alias("y"), F.col("component").alias("cy"), F.col("n").alias("ny"), F.col("rest").alias("ry"))
    # at the first shingle that two sets share, what follows it in either bounds their intersection
    fits = (F.least("rx", "ry") * (100 + p.percent) >= (F.col("nx") + F.col("ny")) * p.percent) & F.expr("cx <> cy and (cy = lx or x < y)")
    pairs = outside.join(mates, "h").where(fits)
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, p: Params = Params(), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    folded = fold_docs(docs)
    signed = stash(folded.select("doc_id", signatures(p)("text").alias("s")).select("doc_id", "s.*"), "signatures")
    classes = signed.where("doc_id is not null and n > 0").groupBy("digest").agg(F.min("doc_id").alias("id"))
    member = signed.select("doc_id", "n", "digest").join(classes, "digest", "left")
    reps = stash(signed.where("n > 0").join(classes.select("id"), F.col("doc_id") == F.col("id"), "left_semi")
                 .groupBy(F.col("doc_id").alias("id")).agg(F.max("reg").alias("reg")), "classes")
    met, pairs = _pivot_pairs(reps.mapInPandas(_bands(p), "bucket long, id long"))
    near = (pairs.join(reps.select(F.col("id").alias("a"), F.col("reg").alias("ra")), "a")
            .join(reps.select(F.col("id").alias("b"), F.col("reg").alias("rb")), "b"))
    near = stash(near.select("a", "b", "ra", "rb").mapInPandas(_estimated(p), "a long, b long"), "candidates")

    def texts_of(ids: DataFrame) -> DataFrame:
        ids = stash(ids, "ids")
        one = folded.where("doc_id is not null").join(small(ids, held_bytes(ids), broadcast_bytes), F.col("doc_id") == F.col("id"), "left_semi")
        return one.select(F.col("doc_id").alias("id"), "text")

    both_ids = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    links = stash(confirm(near, stash(texts_of(both_ids), "texts"), p), "links")
    grouped = components(links)

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(grouped, "id", "left").withColumn("component", F.coalesce("component", "id"))

    open_buckets = placed(met).groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    unsettled = met.join(open_buckets.select("bucket"), "bucket", "left_semi").select("id").distinct()
    rows = texts_of(unsettled).mapInPandas(_shingle_rows(p), "id long, n long, h long")
    cross = stash(_cross_pairs(placed(rows), p), "cross")
    if cross.limit(1).count():
        ids = cross.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        more = stash(confirm(cross, stash(texts_of(ids), "texts"), p), "more-links")
        if more.limit(1).count():
            grouped = components(links.unionByName(more), "all-components")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
    return member.join(grouped, "id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group; rows that repeat such an id stay too."""
    return without_ids(docs, near_duplicates(docs, p).where(~F.col("kept")))
