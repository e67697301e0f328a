"""Parsing and light shaping of the wire feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse import schemas
from crowdpulse.functions.columns import pseudonym, pts_to_seconds

WIRE_EVENT = schemas.PLAYER_EVENT
# wire timestamps are ISO strings; parse them as strings, convert with try_to_timestamp (a malformed one is null)
_WIRE_EVENT_TEXT = schemas.T.StructType([
    schemas.T.StructField(f.name, schemas.S if f.name == "timestamp" else f.dataType, True)
    for f in schemas.PLAYER_EVENT.fields])
_WIRE_MARKER_TEXT = schemas.T.StructType([
    schemas.T.StructField(f.name, schemas.S if f.name == "wallclock" else f.dataType, True)
    for f in schemas.SCTE35_MARKER.fields])


def _text(raw: DataFrame, value_col: str = "value"):
    return F.col(value_col).cast("string")


def parse_player_events(raw: DataFrame, value_col: str = "value", keep=("ingest_ts",)) -> DataFrame:
    """JSON payload -> flat event (P1, P2, F6, F10). A malformed payload gives
    a row of nulls that ``filter_required`` drops. Kafka ``timestamp`` is
    kept as ``ingest_ts`` when present."""
    extra = []
    if "timestamp" in raw.columns and "ingest_ts" in keep:
        extra.append(F.col("timestamp").alias("ingest_ts"))
    p = raw.select(F.from_json(_text(raw, value_col), _WIRE_EVENT_TEXT).alias("e"), *extra)
    return p.select(
        F.col("e.event_id").alias("event_id"), F.col("e.session_id").alias("session_id"),
        F.col("e.user_id").alias("user_id"),
        F.try_to_timestamp(F.col("e.timestamp")).alias("timestamp"),
        F.col("e.event_type").alias("event_type"), F.col("e.content_id").alias("content_id"),
        F.col("e.is_live").alias("is_live"),
        F.col("e.geo.region").alias("region"), F.col("e.geo.state").alias("state"),
        F.col("e.geo.city").alias("city"), F.col("e.geo.isp").alias("isp"),
        F.col("e.device.type").alias("device"), F.col("e.device.model").alias("device_model"),
        F.col("e.cdn").alias("cdn"), F.col("e.bitrate_kbps").alias("bitrate_kbps"),
        F.col("e.buffer_length_ms").alias("buffer_length_ms"),
        F.col("e.playhead_position_s").alias("playhead_position_s"),
        F.col("e.error_code").alias("error_code"), F.col("e.schema_version").alias("schema_version"),
        F.col("e.network_type").alias("network_type"), *([F.col("ingest_ts")] if extra else []),
    )


def parse_markers(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON payload -> marker row."""
    p = raw.select(F.from_json(_text(raw, value_col), _WIRE_MARKER_TEXT).alias("m"))
    return p.select(*[F.try_to_timestamp(F.col("m.wallclock")).alias("wallclock") if f.name == "wallclock"
                      else F.col(f"m.{f.name}").alias(f.name) for f in schemas.SCTE35_MARKER.fields])


def filter_required(df: DataFrame, cols=("event_id", "timestamp", "cdn")) -> DataFrame:
    """Drop rows missing a required field (P3); markers use
    ``("marker_id", "wallclock")``."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else (cond & F.col(c).isNotNull())
    return df.where(cond)


def minimise_pii(events: DataFrame, drop=("user_id", "city", "isp", "state", "device_model")) -> DataFrame:
    """Drop personal or unneeded columns before Silver (P10)."""
    return events.drop(*[c for c in drop if c in events.columns])


def schema_version_mix(events: DataFrame) -> DataFrame:
    """Rows, v2 rows (``network_type`` present) and their share."""
    v2 = F.col("network_type").isNotNull()
    return events.agg(F.count(F.lit(1)).alias("rows"), F.sum(v2.cast("long")).alias("v2_rows")).withColumn(
        "v2_share", F.col("v2_rows").cast("double") / F.col("rows"))


def normalise_versions(events: DataFrame) -> DataFrame:
    """Default v2 fields on v1 rows."""
    out = events
    if "network_type" not in out.columns:
        out = out.withColumn("network_type", F.lit(None).cast("string"))
    if "schema_version" not in out.columns:
        out = out.withColumn("schema_version", F.lit(None).cast("string"))
    return out.withColumn("network_type", F.coalesce("network_type", F.lit("unknown"))).withColumn(
        "schema_version", F.coalesce("schema_version", F.lit("v1")))


def pseudonymise(df: DataFrame, col: str = "user_id", key: str = "", length: int = 16,
                 out: str | None = None) -> DataFrame:
    """Replace ``col`` by its keyed pseudonym (F12). The key comes from the
    caller (configuration), never from code."""
    return df.withColumn(out or col, pseudonym(F.col(col), key, length))


def pts_seconds(markers: DataFrame) -> DataFrame:
    """Add ``pts_seconds`` from 90 kHz ``pts_time``."""
    return markers.withColumn("pts_seconds", pts_to_seconds("pts_time"))
