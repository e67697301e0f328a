"""Helpers shared by the training-data operators: inputs, shared scratch tables, word splitting."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.session import checkpoint_root

#: A word is a run of anything but blank, tab, newline, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to a fresh table in the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


#: What one broadcast side may take in memory, on the driver and on each executor.
BROADCAST_BYTES = 64 << 20


def held_bytes(df: DataFrame) -> int:
    """Measured bound of what ``df`` takes as a broadcast hash table: per row 64 bytes of headers and slots and 24 a
    column (value, null bit, key copy), and the bytes of its texts twice, as row and as key. Columns are of fixed width
    or texts."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    text_bytes = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c in texts), F.lit(0).cast("long"))
    rows, held = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(text_bytes), F.lit(0))).first()
    return rows * (64 + 24 * len(df.columns)) + 2 * held


def small(df: DataFrame, size: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if its measured ``size`` is at most ``limit``; Spark chooses the join otherwise."""
    return F.broadcast(df) if size <= limit else df


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def doc_key(c: str = "doc_id") -> Column:
    """The document's id as a long."""
    return F.col(c).cast("long")


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words with A-Z lower-cased (other letters are left as they are)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fold_docs(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id, text and the named columns; null text becomes empty. Other columns, whatever their names, are dropped."""
    return docs.select(doc_key().alias("doc_id"), text_or_empty().alias("text"), *extra)


def packed(docs: DataFrame) -> DataFrame:
    """All columns in one struct ``row``, so that no helper column can clash with one of theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``ids`` (doc_id; null matches null)."""
    gone = ids.select(F.col("doc_id").alias("gone")).distinct()
    return packed(docs).join(gone, F.col("row.doc_id").cast("long").eqNullSafe(F.col("gone")), "left_anti").select("row.*")
