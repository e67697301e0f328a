"""Mixing sources to target weights by fixed-length token blocks.

Each source's documents are laid end to end and cut into blocks of ``block`` words. A source that owes t words gives
whole rounds of all its blocks and then part of one more round, cut to the word. Slot j of a source holds block
perm(j mod n) of round j div n, where each round has its own pseudorandom permutation of the block numbers (a keyed Feistel
network, walked until it lands inside), so any slot is found from its number alone, without sorting or shuffling the
source. How many slots of each source an output shard gets is a multinomial draw over the shards, conditioned on the
source's total, so that the targets are met exactly and not just on average. Slots and blocks meet in one join on (source, block).

Positions inside a source are prefix sums over hashed buckets: a source that holds a third of all rows is summed in
``buckets`` independent parts. Slots are made in chunks spread over the cluster.

Defined cases: null or empty texts have size 0 and are never taken; a null source is a source, the last in order; repeated
rows and null ids are rows of their own; a corpus without words has targets of 0. Reruns with the same seed agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.common import BROADCAST_BYTES, WORD, doc_key, held_bytes, small, stash, text_or_empty

CAP = 3     # no source, and so no block, is used more often


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, rid (hash of the text), size in words."""
    return docs.select(doc_key().alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.xxhash64(text_or_empty()).alias("rid"), F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"))


def targets(sizes: DataFrame) -> DataFrame:
    """sid, source, source_size, target: one row per source.

    Sources in code point order (null last) weigh 1, 2, 3, repeating, and share the words of all sources; none owes
    more than CAP times its size. With sources sorted by cap per weight, the capped ones come first: each is capped if
    its share of what the ones before it leave over is at least its cap.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weighed = ranked.withColumn("weight", (F.col("sid") - 1) % 3 + 1).withColumn("cap", F.col("source_size") * CAP)
    before = Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = weighed.withColumn("rest", rest).withColumn("weights", weights)
    capped = F.col("cap") * F.col("weights") <= F.col("rest") * F.col("weight")
    free = F.first(F.when(~capped, F.col("rest") / F.col("weights")), ignorenulls=True).over(
        Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return level.withColumn("free", free).select(
        "sid", "source", "source_size",
        F.when(capped, F.col("cap").cast("double")).otherwise(F.col("free") * F.col("weight")).alias("target"))


def placed(sizes: DataFrame, sources: DataFrame, buckets: int = 1024) -> DataFrame:
    """The rows with sid and ``start``, the words of their source before them."""
    rows = sizes.where("size > 0").join(sources.select("sid", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "rid"), F.lit(buckets)))
    totals = rows.groupBy("sid", "part").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("sid").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("words").over(up_to), F.lit(0)).alias("offset"))
    before = Window.partitionBy("sid", "part").orderBy("doc_id", "rid").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("inner", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return (summed.join(offsets, (F.col("sid") == F.col("s")) & (F.col("part") == F.col("p")))
            .select("doc_id", "rid", "sid", "size", (F.col("offset") + F.col("inner")).alias("start")))


def pieces(rows: DataFrame, block: int) -> DataFrame:
    """sid, block, at, words: each document's words in each block; ``at`` is their place in the block."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    cut = rows.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start"), F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return cut.select("sid", "block", "doc_id", "rid", "start", "size", (begin - F.col("block") * block).alias("at"),
                      (begin - F.col("start")).alias("from_word"), (end - begin).alias("words"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def permuted(index: np.ndarray, n: int, key: np.ndarray, inverse: bool = False, rounds: int = 6) -> np.ndarray:
    """A permutation of 0..n-1 for each key, applied to ``index`` (or undone)."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = index.astype(np.uint64)
    key = np.broadcast_to(key.astype(np.uint64), out.shape)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            x, k = out[todo], key[todo]
            left, right = x >> shift, x & mask
            for r in (range(rounds - 1, -1, -1) if inverse else range(rounds)):
                if inverse:
                    left, right = right ^ (_mixed(left + _mixed(k + np.uint64(r + 1))) & mask), left
                else:
                    left, right = right, left ^ (_mixed(right + _mixed(k + np.uint64(r + 1))) & mask)
            out[todo] = (left << shift) | right
            todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def round_key(seed: int, sid: int, rounds: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(np.uint64(seed) * np.uint64(1_000_003) + np.uint64(sid) * np.uint64(8191) + _mixed(rounds.astype(np.uint64)))


def slot_count(size: int, words: int, block: int, seed: int, sid: int) -> tuple[int, int]:
    """(slots, words of the last slot) that give exactly ``words``."""
    if size <= 0 or words <= 0:
        return 0, 0
    n = -(-size // block)
    short = n * block - size
    whole, rest = divmod(words, size)
    if rest == 0:
        last = permuted(np.array([n - 1]), n, round_key(seed, sid, np.array([whole - 1])))[0]
        return whole * n, block - short if last == n - 1 else block
    place = permuted(np.array([n - 1]), n, round_key(seed, sid, np.array([whole])), inverse=True)[0]
    m = -(-rest // block)
    if place < m:
        m = -(-(rest + short) // block)
    got = m * block - (short if place < m else 0)
    full = block - short if place == m - 1 else block
    return whole * n + m, int(full - (got - rest))


def _slots(block: int, shards: int, seed: int, chunk: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for sid, size, words, part in zip(b["sid"], b["source_size"], b["words"], b["chunk"], strict=True):
                total, last = slot_count(size, words, block, seed, sid)
                j = np.arange(part * chunk, min(total, (part + 1) * chunk))
                if not len(j):
                    continue
                n = -(-size // block)
                drawn = np.random.default_rng([seed, sid]).multinomial(total, np.full(shards, 1 / shards))
                yield pd.DataFrame({"sid": sid, "block": permuted(j % n, n, round_key(seed, sid, j // n)),
                                    "shard": np.searchsorted(np.cumsum(drawn), j, side="right"),
                                    "slot": j, "take": np.where(j == total - 1, last, block)})
    return run


def slots(sources: DataFrame, block: int, shards: int, seed: int, chunk: int = 16_384) -> DataFrame:
    """sid, block, shard, slot, take: the blocks that each output shard gets; ``take`` words of the block count."""
    due = sources.select("sid", "source_size", F.round("target").cast("long").alias("words")).where("source_size > 0 and words > 0")
    most = F.ceil((F.col("words") + F.col("source_size")) / block) + F.ceil(F.col("words") / F.col("source_size")) + 1
    cut = due.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(most / chunk))))
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut.repartition(parts, "sid", "chunk").mapInPandas(
        _slots(block, shards, seed, chunk), "sid int, block long, shard int, slot long, take long")


def mix(docs: DataFrame, block: int = 128, shards: int = 64, seed: int = 5, broadcast_bytes: int = BROADCAST_BYTES):
    """(sizes, sources, mixture). The mixture has one row per piece of a document in a block of a shard: shard, sid,
    slot, at, doc_id, rid, start, from_word, words."""
    sizes = stash(sized(docs), "sizes")
    sources = stash(targets(sizes), "sources")
    few = small(sources, held_bytes(sources), broadcast_bytes)
    cut = pieces(placed(sizes, few), block)
    # slots are made from the few rows of sources, which would make Spark believe that they are few too
    got = cut.join(slots(sources, block, shards, seed).hint("merge"), ["sid", "block"])
    words = F.least(F.col("words"), F.col("take") - F.col("at"))
    return sizes, few, got.withColumn("words", words).where("words > 0").select(
        "shard", "sid", "slot", "at", "doc_id", "rid", "start", "size", "from_word", "words")


def mixed_texts(docs: DataFrame, mixture: DataFrame) -> DataFrame:
    """shard, sid, slot, text: the blocks themselves, words joined by blanks."""
    @F.pandas_udf("string")
    def words_from(text: pd.Series, begin: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([b" ".join(t.encode("utf-8", "surrogatepass").split()[i:i + k]).decode("utf-8", "surrogatepass")
                          for t, i, k in zip(text, begin, n, strict=True)], dtype=object)

    texts = docs.select(doc_key().alias("d"), text_or_empty().alias("text")).withColumn("r", F.xxhash64("text")).dropDuplicates(["d", "r"])
    same: Column = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("rid") == F.col("r"))
    cut = mixture.join(texts, same).withColumn("piece", words_from("text", "from_word", "words"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]), " ")
    return cut.groupBy("shard", "sid", "slot").agg(joined.alias("text"))


def taken(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, source: one row per document."""
    sizes, sources, mixture = mix(docs, **options)
    used = mixture.groupBy("sid", "start", "doc_id", "rid", "size").agg(F.sum("words").alias("words"))
    # repeated rows have one place each; the n-th of them takes the n-th place's words
    key = ["doc_id", "rid", "sid"]
    turn = F.row_number().over(Window.partitionBy(*key).orderBy("start"))
    used = used.withColumn("turn", turn).select(F.col("doc_id").alias("d"), F.col("rid").alias("r"), F.col("sid").alias("u"), "turn", "words")
    rows = sizes.join(sources.select(F.col("source").alias("s"), "sid", "source_size", "target"), F.col("source").eqNullSafe(F.col("s")))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy("size")))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("rid") == F.col("r")) & (F.col("sid") == F.col("u")) & (F.col("nth") == F.col("turn"))
    return rows.join(used, same, "left").select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).alias("taken"), "source")
