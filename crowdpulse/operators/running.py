"""Sequential window operators that stay parallel on a hot key.

A plain ``Window.partitionBy(key).orderBy(t)`` puts a whole key in one task;
a live broadcast is one key. Here the ordered work is done per
``(key, bucket)`` (buckets are ranges of the order column), and the
cross-bucket part comes from a small per-bucket aggregate (one row per key
and bucket) carried in with a second, tiny window. Result equals the single
partition computation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "_bucket"


def running_agg(df: DataFrame, partition, order, value: Column | str, bucket: Column, out: str,
                how: str = "sum", exclusive: bool = False) -> DataFrame:
    """Add ``out`` = running ``how`` (sum | max) of ``value`` per
    ``partition`` in ``order``; ``exclusive`` leaves the current row out.
    ``bucket`` must be monotone in the order (e.g. a time bucket)."""
    agg = {"sum": F.sum, "max": F.max}[how]
    partition = list(partition)
    order = list(order)
    v = F.col(value) if isinstance(value, str) else value
    # dealt once by (partition, bucket): the window and the per-bucket aggregate share one exchange of the input
    b = df.withColumn("_v", v).withColumn(_B, bucket).repartition(*partition, _B)
    hi = -1 if exclusive else 0
    w_local = Window.partitionBy(*partition, _B).orderBy(*order).rowsBetween(Window.unboundedPreceding, hi)
    b = b.withColumn("_local", agg("_v").over(w_local))
    per_bucket = b.groupBy(*partition, _B).agg(agg("_v").alias("_bv"))
    w_carry = Window.partitionBy(*partition).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(*partition, _B, agg("_bv").over(w_carry).alias("_carry"))
    j = b.join(carry, [*partition, _B], "left")
    if how == "sum":
        res = F.coalesce(F.col("_local"), F.lit(0)) + F.coalesce(F.col("_carry"), F.lit(0))
        res = F.when(F.col("_local").isNull() & F.col("_carry").isNull(), F.lit(None)).otherwise(res)
    else:
        res = F.greatest(F.col("_local"), F.col("_carry"))
    return j.withColumn(out, res).drop("_v", "_local", "_carry", _B)


def bucketed_lead(df: DataFrame, partition, ts: str, cols, bucket: Column, prefix: str = "next_") -> DataFrame:
    """``lead(c)`` for each c in ``cols`` (plus ``ts``) per ``partition``
    ordered by ``ts``: inside each (partition, bucket), and for the last row of
    a bucket, the first row of the next non-empty bucket."""
    partition = list(partition)
    cols = [c for c in cols if c != ts]
    # dealt once by (partition, bucket): the window and the per-bucket aggregate then share one exchange of the input
    b = df.withColumn(_B, bucket).repartition(*partition, _B)
    # ties on ts are ordered by the carried columns, so the result is deterministic
    w = Window.partitionBy(*partition, _B).orderBy(ts, *cols)
    for c in [ts, *cols]:
        b = b.withColumn(f"_l_{c}", F.lead(c).over(w))
    first = b.groupBy(*partition, _B).agg(F.min_by(F.struct(ts, *cols), F.struct(ts, *cols)).alias("_first"))
    wb = Window.partitionBy(*partition).orderBy(_B)
    nxt = first.select(*partition, _B, F.lead("_first").over(wb).alias("_nb"))
    j = b.join(nxt, [*partition, _B], "left")
    has_local = F.col(f"_l_{ts}").isNotNull()
    for c in [ts, *cols]:
        j = j.withColumn(f"{prefix}{c}", F.when(has_local, F.col(f"_l_{c}")).otherwise(F.col(f"_nb.{c}")))
    return j.drop(_B, "_nb", *[f"_l_{c}" for c in [ts, *cols]])


def time_bucket(ts: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(ts)) / F.lit(seconds * 1_000_000)).cast("long")
