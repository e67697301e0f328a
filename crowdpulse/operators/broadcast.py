"""Size-checked broadcast.

A side is broadcast only when the optimizer's size estimate of its plan (no job runs; without CBO a filter or aggregate
never lowers it), times a factor for what compressed files hold in memory, fits the limit. Otherwise the plan keeps Spark's
shuffle join; AQE may still switch to a broadcast from measured shuffle sizes, and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ~64 MB: well inside an executor, and far below the driver's collect limit.
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Any positive value asks for the size check; None or 0 turns the hint off.
DEFAULT_MAX_BROADCAST_ROWS = 1
# The estimate of a file scan is the files' size; a hashed relation of their rows takes several times that.
IN_MEMORY_FACTOR = 5.0


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df``'s plan in bytes, or None."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 - not available on this client
        return None


def is_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, expansion: float = 1.0) -> bool:
    """``df`` times ``expansion`` fits in ``max_bytes`` of memory by the static estimate."""
    if df.isStreaming:
        return False
    est = estimated_bytes(df)
    return est is not None and est * IN_MEMORY_FACTOR * expansion <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS, *,
                       max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, size_of: DataFrame | None = None,
                       expansion: float = 1.0) -> DataFrame:
    """``broadcast(df)`` if proven small, else ``df`` unchanged.

    ``size_of``/``expansion`` check a source before a bounded expansion (e.g.
    markers before each is exploded into at most ``expansion`` buckets).
    ``max_rows=None`` (or 0) disables the hint."""
    if not max_rows:
        return df
    return F.broadcast(df) if is_small(size_of if size_of is not None else df, max_bytes, expansion) else df


#: Bits of a key filter: 2^27, 16 MB whatever the number of keys, in 4096 bitmaps.
KEY_BITS = 27


def _spot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << KEY_BITS))


def key_bits(keys: DataFrame, key: Column) -> DataFrame:
    """A filter for ``maybe_among``: a bit for the hash of each ``key`` that is not null, as bitmaps (at most 4096 rows of 4 KB)."""
    at = keys.where(key.isNotNull()).select(_spot(key).alias("_at"))
    return at.groupBy(F.bitmap_bucket_number("_at").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits"))


def maybe_among(df: DataFrame, key: Column, bits: DataFrame) -> DataFrame:
    """The rows whose ``key`` is one of those that ``bits`` were made of, and a share of the others (as large as that of the bits
    that are set). For rows that a later step leaves out anyway: it is spared most of them, and no shuffle is needed."""
    byte = F.expr("CAST(conv(hex(substring(_bits, CAST(_place div 8 + 1 AS INT), 1)), 16, 10) AS INT)")
    spotted = df.withColumn("_at", _spot(key)).withColumn("_place", F.bitmap_bit_position("_at"))
    held = spotted.join(F.broadcast(bits), F.bitmap_bucket_number("_at") == F.col("_bucket"))
    return held.where(byte.bitwiseAND(F.expr("shiftleft(1, CAST(_place % 8 AS INT))")) != 0).select(*[F.col(f"`{c}`") for c in df.columns])
