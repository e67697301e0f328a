"""Benchmark decontamination: test items found inside documents, in SQL functions only.

An item counts as leaked into a document that holds at least ``percent`` of the item's distinct five-word shingles,
wherever they stand. Containment is not symmetric: a long document's own minima say nothing about a short item, so the
sketches are the items'. Items are partitioned by size, and each partition has its own sketch length: the s smallest
shingle hashes (a bottom-s MinHash) with s one more than the shingles an item of that size may miss. At least one of
them must stand in any document that holds enough of the item, so the search misses nothing at any document length.
Documents probe with all their shingle hashes; hits are (document, item) candidates, and exact containment on the
shingles' texts decides.

The items' side and the suspects' ids are broadcast while their measured bytes (as hash tables) stay within 64 MB; beyond
that Spark joins by shuffle, with the same result.
Candidates are pre-aggregated per document and item, so a passage in a third of all documents costs one row each.

Defined cases: words are split at ASCII blanks and lower-cased; an item or text of fewer words than a shingle has the
whole sequence as its one shingle, so an item of fewer words matches only texts that consist of just its words, as in
the operator's SQL, and is not found inside a longer text; null or empty items match nothing, null or empty texts hold nothing; repeated
documents are reported once per id (rows with a null id under null), repeated items under each of their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.common import BROADCAST_BYTES, doc_key, fold_docs, held_bytes, small, stash, text_or_empty, without_ids


def with_words(df: DataFrame) -> DataFrame:
    """Column w: the lower-cased words of ``text``."""
    return df.withColumn("w", F.filter(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")).drop("text")


def with_hashes(df: DataFrame, k: int) -> DataFrame:
    """Column hs from w: the hashes of the k-word shingles, in order.

    Word hashes are folded with their neighbours k - 1 times. Each fold is a projection of its own that names the one
    before it more than once, so Spark keeps them apart and computes each once.
    """
    df = df.withColumn("h", F.transform("w", lambda x: F.xxhash64(x))).withColumn("hs", F.col("h"))
    for i in range(1, k):
        n = F.greatest(F.size("h") - i, F.lit(0))
        df = df.withColumn("hs", F.zip_with(F.slice("hs", 1, n), F.slice("h", i + 1, n), lambda x, y: F.xxhash64(x, y)))
    short = F.array(F.aggregate("h", F.lit(42).cast("long"), lambda a, x: F.xxhash64(a, x)))
    none = F.array().cast("array<long>")
    return df.withColumn("hs", F.when(F.size("h") >= k, F.col("hs")).when(F.size("h") > 0, short).otherwise(none)).drop("h")


def with_texts(df: DataFrame, k: int) -> DataFrame:
    """Column ss from w: the k-word shingles as texts, in order."""
    several = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - k + 1, F.lit(1))), lambda i: F.array_join(F.slice("w", i, k), " "))
    none = F.array().cast("array<string>")
    return df.withColumn("ss", F.when(F.size("w") > 0, several).otherwise(none))


def item_shingles(benchmark: DataFrame, k: int) -> DataFrame:
    """item_id, shingle, size: one row per distinct shingle of an item."""
    items = benchmark.select(doc_key("item_id").alias("item_id"), text_or_empty().alias("text")).distinct()
    items = with_texts(with_hashes(with_words(items.withColumn("version", F.xxhash64("text"))), k), k)
    rows = items.select("item_id", "version", F.inline_outer(F.arrays_zip("ss", "hs"))).where("hs is not null").distinct()
    size = F.count(F.lit(1)).over(Window.partitionBy("item_id", "version"))
    return rows.select("item_id", "version", F.col("ss").alias("shingle"), F.col("hs").alias("h"), size.alias("size"))


def sketches(shingles: DataFrame, percent: int) -> DataFrame:
    """The items' bottom-s hashes; s is set per size partition (a power of two holds the partition's sizes)."""
    upper = F.pow(F.lit(2), F.ceil(F.log2("size"))).cast("int")
    length = upper - F.ceil(upper * percent / 100).cast("int") + 1
    place = F.row_number().over(Window.partitionBy("item_id", "version").orderBy("h", "shingle"))
    return shingles.withColumn("place", place).where(F.col("place") <= length).select("item_id", "version", "h")


def leaks(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every item that leaked into a document."""
    # explode_outer: the filter that explode() implies would be pushed below the projections and compute them again
    shingles = stash(item_shingles(benchmark, k), "items")
    item_bytes = held_bytes(shingles)
    folded = fold_docs(docs)
    probes = with_hashes(with_words(folded), k).select("doc_id", F.explode_outer("hs").alias("h")).where("h is not null")
    found = (probes.join(small(sketches(shingles, percent).distinct(), item_bytes, broadcast_bytes), "h")
             .groupBy("doc_id", "item_id", "version").agg(F.count(F.lit(1)).alias("hits")))
    candidates = stash(found.select("doc_id", "item_id", "version"), "candidates")
    # null shares its key with the least long: that can only bring a text too many, which the last join drops
    key = F.coalesce("doc_id", F.lit(-2**63))
    suspects = stash(candidates.select(key.alias("key")).distinct(), "suspects")
    texts = folded.withColumn("key", key).join(small(suspects, held_bytes(suspects), broadcast_bytes), "key", "left_semi")
    held = with_texts(with_words(texts.drop("key")), k).select("doc_id", F.explode_outer("ss").alias("shingle")).where("shingle is not null")
    own = shingles.select("item_id", "version", "shingle", "size")
    shared = (held.join(small(own, item_bytes, broadcast_bytes), "shingle")
              .groupBy("doc_id", "item_id", "version", "size").agg(F.countDistinct("shingle").alias("n_shared")))
    exact = shared.where(F.col("n_shared") * 100 >= F.col("size") * percent)
    best = (exact.join(candidates.select(F.col("doc_id").alias("d"), F.col("item_id").alias("i"), F.col("version").alias("v")),
                       F.col("doc_id").eqNullSafe(F.col("d")) & F.col("item_id").eqNullSafe(F.col("i")) & (F.col("version") == F.col("v")), "left_semi")
            .groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("n_shared") / F.col("size"), "n_shared", "size")).alias("b")))
    return best.select("doc_id", "item_id", F.col("b.size").cast("long").alias("n_shingles"), F.col("b.n_shared").cast("long").alias("n_shared"),
                       (F.col("b.n_shared") / F.col("b.size")).alias("containment"))


def clean(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` into which no item leaked; rows with a null id stay unless a row with a null id leaked."""
    return without_ids(docs, leaks(docs, benchmark, k, percent))
