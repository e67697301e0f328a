"""Sources: stream and batch scans of the feeds.

Kafka is the production transport; its connector jar is not part of this
environment, so every stream reader takes ``fmt``: ``kafka`` (options as for
Spark's Kafka source) or a file format (``json`` / ``text`` / ``parquet``) over
a landing folder. File streams yield the Bronze/Kafka layout so parsing is the
same for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse import schemas
from crowdpulse.sources.parse import filter_required, parse_markers, parse_player_events

# Lost offsets stop the stream; a caller who accepts gaps passes failOnDataLoss=false.
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "true"}


def _as_raw(df: DataFrame, topic: str) -> DataFrame:
    """Lines of a text/json file stream in the Kafka record layout."""
    return df.select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.lit(None).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"))


def read_raw_stream(spark: SparkSession, fmt: str, options: dict, topic: str = "player_events",
                    max_per_trigger: int | None = None) -> DataFrame:
    """Raw records, no parsing (IO3). ``max_per_trigger`` caps a micro-batch
    (Kafka ``maxOffsetsPerTrigger``, file ``maxFilesPerTrigger``) (IO4)."""
    opts = dict(options)
    if fmt == "kafka":
        opts = {**KAFKA_DEFAULTS, "subscribe": topic, **opts}
        if max_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return spark.readStream.format("kafka").options(**opts).load()
    path = opts.pop("path")
    if max_per_trigger:
        opts.setdefault("maxFilesPerTrigger", str(max_per_trigger))
    if fmt == "parquet":  # a Bronze folder already in Kafka layout
        return spark.readStream.schema(schemas.RAW).options(**opts).parquet(path)
    lines = spark.readStream.options(**opts).text(path)
    return _as_raw(lines.where(F.trim("value") != ""), topic)


def read_event_stream(spark: SparkSession, fmt: str, options: dict, max_per_trigger: int | None = 50000,
                      topic: str = "player_events") -> DataFrame:
    """Parsed, flattened, required-field-filtered event stream (IO1, P1-P3)."""
    raw = read_raw_stream(spark, fmt, options, topic, max_per_trigger)
    return filter_required(parse_player_events(raw))


def read_marker_stream(spark: SparkSession, fmt: str, options: dict, topic: str = "scte35_markers") -> DataFrame:
    """Parsed marker stream, no rate cap (IO2)."""
    raw = read_raw_stream(spark, fmt, options, topic, None)
    return filter_required(parse_markers(raw), ("marker_id", "wallclock"))


def read_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON lines with an explicit (pruned) schema, no inference (IO5)."""
    return spark.read.schema(schema).json(path)


def read_bronze(spark: SparkSession, path: str, start=None, end=None, ts_col: str = "timestamp",
                partition_col: str | None = "event_date") -> DataFrame:
    """Bronze parquet for backfill (IO8): optional ingest-time range, pruned
    on the ``event_date`` partition when Bronze is partitioned."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col(ts_col) >= F.lit(start).cast("timestamp"))
        if partition_col and partition_col in df.columns:
            df = df.where(F.col(partition_col) >= F.to_date(F.lit(start).cast("timestamp")))
    if end is not None:
        df = df.where(F.col(ts_col) < F.lit(end).cast("timestamp"))
        if partition_col and partition_col in df.columns:
            df = df.where(F.col(partition_col) <= F.to_date(F.lit(end).cast("timestamp")))
    return df


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict,
                    partitioning: dict | None = None) -> DataFrame:
    """JDBC scan (IO6). ``partitioning`` = {column, lowerBound, upperBound,
    numPartitions} splits the scan over executors instead of one task."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partitioning:
        reader = reader.option("partitionColumn", partitioning["column"]) \
            .option("lowerBound", str(partitioning["lowerBound"])) \
            .option("upperBound", str(partitioning["upperBound"])) \
            .option("numPartitions", str(partitioning["numPartitions"]))
    return reader.load()


def publish_jsonl(spark: SparkSession, src: str, fmt: str, target: dict, topic: str = "player_events") -> None:
    """Load a JSONL file, skip blank lines and publish each line (IO7):
    ``fmt='kafka'`` writes to a topic, otherwise lines land as text files in
    ``target['path']`` (a drop folder a file stream picks up)."""
    lines = spark.read.text(src).where(F.trim("value") != "")
    if fmt == "kafka":
        lines.select(F.col("value")).write.format("kafka").options(topic=topic, **target).save()
    else:
        lines.write.mode("append").text(target["path"])


def jsonl_to_parquet(spark: SparkSession, src: str, dst: str, schema, compression: str = "snappy") -> None:
    """JSONL to Snappy Parquet with an explicit schema (IO9)."""
    read_jsonl(spark, src, schema).write.mode("overwrite").option("compression", compression).parquet(dst)
