"""Sinks.

Streaming sinks are exactly-once: the Parquet file sink commits through its
``_spark_metadata`` log, and ``foreachBatch`` writes are keyed by ``batch_id``
so a replayed batch overwrites itself instead of adding rows. Failures raise
(the reference printed and swallowed them, D9/D10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crowdpulse.operators.quality import fail_if_any, fail_if_observed, gold_quality_report, key_rules, observed
from crowdpulse.session import freed_shuffles
from crowdpulse.sources.readers import read_jdbc_table


def _trigger(writer, trigger):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def bronze_ingest(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = "10 seconds",
                  partition_by: str | None = "event_date") -> StreamingQuery:
    """Append raw records to Parquet with a checkpoint (SK1, ST10), optionally
    partitioned by ingest date (SK2) so backfills prune partitions."""
    out = stream
    if partition_by == "event_date":
        out = out.withColumn("event_date", F.to_date("timestamp"))
    w = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    return _trigger(w, trigger).start()


def _write_batch(batch_df: DataFrame, path: str, batch_id: int) -> None:
    batch_df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/batch_id={batch_id}")


def create_table(spark: SparkSession, path: str, columns, partition_by=()) -> None:
    """An empty Parquet table with the given columns (DDL or schema) (SK4); a table that is there already stays as it is."""
    spark.createDataFrame([], columns).write.mode("ignore").partitionBy(*partition_by).parquet(path)


def latest_per_key(df: DataFrame, keys, version) -> DataFrame:
    """One row per key: the greatest by ``version`` columns, then by all others, so a rerun keeps the same row. The row is
    carried once, in that order of its columns."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*version, *[c for c in rest if c not in version])
    return df.groupBy(*keys).agg(F.max(row).alias("_row")).select(*keys, *[F.col(f"_row.`{c}`") for c in rest])


PART, FRESH = "key_part", "_fresh"


def _key_part(keys, parts: int):
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def silver_upsert(stream: DataFrame, path: str, checkpoint: str, keys, rules: dict | None = None,
                  trigger: str | None = "5 seconds", output_mode: str = "append", version=(), parts: int = 32,
                  stamp: str | None = None, clock=None) -> StreamingQuery:
    """Keyed upsert into Parquet (SK3-SK5, DQ6). The table is partitioned by a hash of the key; a micro-batch rewrites only the
    partitions that its keys fall in, by Spark's dynamic partition overwrite.

    The batch is evaluated once: reduced to one row per key (the greatest by ``version``) and staged, while its rows and the
    rows that break a rule are observed (by default, the five Silver keys must not be null). A broken rule raises before the
    table is touched; an empty batch ends there. Then staged and current rows of the touched partitions are merged (the
    greatest by ``version``, the batch's row on a tie) and written over: Spark keeps the files of such an overwrite apart until
    all are there, so there is no copy besides these and the table. A replayed batch merges to the same rows. One writer at a time, readers after it: a plain Parquet table has no snapshots. ``stamp`` names a column for the time
    of emission (``clock``, by default the current time)."""
    keys, version, spark = list(keys), list(version), stream.sparkSession
    rules = key_rules() if rules is None else rules
    stamped = stream.withColumn(stamp, F.current_timestamp() if clock is None else clock) if stamp else stream
    columns = stamped.schema
    create_table(spark, path, T.StructType([*columns, T.StructField(PART, T.IntegerType())]), [PART])
    base = f"{checkpoint.rstrip('/')}-staged"

    def process(batch_df: DataFrame, batch_id: int) -> None:
        with freed_shuffles(batch_df.sparkSession):
            upsert(batch_df)

    def upsert(batch_df: DataFrame) -> None:
        seen_rows, seen = observed(batch_df, rules)
        staged = f"{base}/batch"
        keyed = latest_per_key(seen_rows, keys, version).withColumn(PART, _key_part(keys, parts))
        keyed.write.mode("overwrite").partitionBy(PART).parquet(staged)
        if not fail_if_observed(seen):
            return
        spark = batch_df.sparkSession
        fresh = spark.read.schema(keyed.schema).parquet(staged)
        touched = [r[0] for r in fresh.select(PART).distinct().collect()]       # at most ``parts`` numbers
        current = spark.read.schema(keyed.schema).parquet(path).where(F.col(PART).isin(touched))
        both = current.withColumn(FRESH, F.lit(0)).unionByName(fresh.withColumn(FRESH, F.lit(1)))
        merged = latest_per_key(both, [*keys, PART], [*version, FRESH]).select(*keyed.columns)
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)

    w = stamped.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).outputMode(output_mode)
    return _trigger(w, trigger).start()


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``silver_upsert`` keeps: a row per key."""
    return spark.read.parquet(path).drop(PART)


def gold_write_partitioned(gold: DataFrame, path: str, partition: str = "event_date",
                           ts: str = "window_start", tasks_per_date: int = 8) -> None:
    """Idempotent partitioned rewrite (SK8, T5): dynamic partition overwrite
    replaces only the dates present. A date is written by several tasks, and
    rows are time-sorted inside each file (the sort leads with the partition
    column, as the writer's own does, so it is kept)."""
    out = gold.withColumn(partition, F.to_date(ts)) if partition not in gold.columns else gold
    part = F.pmod(F.xxhash64(*gold.columns), F.lit(tasks_per_date))
    with freed_shuffles(gold.sparkSession):
        out.repartition(partition, part).sortWithinPartitions(partition, ts).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def gold_publish(gold: DataFrame, url: str, table: str, properties: dict, max_lag_s: int = 600,
                 string_columns: str | None = None) -> None:
    """Quality-gated full overwrite over JDBC (SK6): the one-pass check report
    must pass, otherwise nothing is written and the job fails. What was checked
    is what is written: Gold is computed once."""
    kept = gold.persist()
    try:
        fail_if_any(gold_quality_report(kept, max_lag_s))
        w = kept.write.mode("overwrite").option("truncate", "true")
        if string_columns:
            w = w.option("createTableColumnTypes", string_columns)
        w.jdbc(url, table, properties=properties)
    finally:
        kept.unpersist()


def copy_table(spark: SparkSession, src: dict, dst: dict) -> None:
    """Copy a table between databases (SK7); each of ``src``/``dst`` is
    {url, table, properties}; ``src`` may add {partitioning} to read it in parallel."""
    df = read_jdbc_table(spark, src["url"], src["table"], src.get("properties", {}), src.get("partitioning"))
    df.write.mode(dst.get("mode", "overwrite")).jdbc(dst["url"], dst["table"], properties=dst.get("properties", {}))


def write_valid_and_dlq(validated_stream: DataFrame, valid_path: str, dlq_path: str, checkpoint: str,
                        trigger: str | None = "10 seconds") -> StreamingQuery:
    """Stream sink for the contract split (SK9): valid rows and dead letters
    written per batch, both keyed by batch_id."""
    from crowdpulse.operators.quality import split_valid_dlq

    def process(batch_df: DataFrame, batch_id: int) -> None:
        kept = batch_df.persist()       # parsed once for both sides
        try:
            valid, dlq = split_valid_dlq(kept)
            _write_batch(valid, valid_path, batch_id)
            _write_batch(dlq, dlq_path, batch_id)
        finally:
            kept.unpersist()

    w = validated_stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()
