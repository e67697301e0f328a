"""Views of the driver tables in the shape of the four media inputs.

The driver's parquet tables carry no media data, so each input is a fixed,
deterministic rule over them. ``crowdpulse.plans.oracle`` writes the same rules
as DuckDB SQL, and the two must stay in step.

* player_events <- events (+ region): one event per row. At-least-once delivery
  is part of the feed: rows with k >= 95 arrive twice (exact replays), rows with
  90 <= k < 95 are re-sent 3 s later under the same event_id (D13).
* scte35_markers <- events where event_type = 'signup'.
* ad_decisions  <- lineitem (+ supplier): one decision per line item.
* content_metadata <- nation (+ region), ids padded with spaces (trim, F1);
  ``content_versions`` adds a second SCD2 version per content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.operators.broadcast import broadcast_if_small
from crowdpulse.session import ensure_defaults

# Fixed mapping values (same text in the DuckDB oracle).
CDNS = ("cdn-a", "cdn-b", "cdn-c")
DEVICES = ("smart_tv", "mobile", "web", "tablet")
NETWORKS = ("wifi", "cellular", "ethernet")
N_CHANNELS = 25
RESEND_SHIFT_S = 3
SCD2_CHANGE = "2024-01-15 00:00:00"


# Schemas of the driver tables read here: a given schema spares the footer
# scan job that schema inference runs on every read.
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The mapping is written as SQL expressions: one expression string per column
# keeps plan construction to a few calls into the JVM.
def _pick(idx: str, values, default: str | None = None) -> str:
    arms = " ".join(f"WHEN {idx} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {arms}{f' ELSE {default}' if default else ''} END"


def _channel(x: str) -> str:
    return f"concat('ch-', CAST({x} % {N_CHANNELS} AS STRING))"


def _events_with_k(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "CAST(ts AS TIMESTAMP) AS ts", "user_id", "event_type", "value",
        "CAST(get_json_object(props, '$.k') AS INT) AS k")


def player_events(spark: SparkSession, sf_dir: str, deliveries: bool = True, keep_k: bool = False) -> DataFrame:
    """Flat player events (P2 shape). ``deliveries`` adds the replayed copies;
    ``keep_k`` keeps the rule key ``k``."""
    ensure_defaults(spark)
    ev = _events_with_k(spark, sf_dir)
    # region has five rows in every TPC-H scale: a fixed-size broadcast.
    region = F.broadcast(table(spark, sf_dir, "region"))
    other = _pick("k % 10", ("video_end", "ad_start", "ad_end"), default="'heartbeat'")
    etype = ("CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'click' THEN 'buffer_start' "
             "WHEN event_type = 'purchase' THEN 'buffer_end' WHEN event_type = 'signup' THEN 'video_start' "
             f"ELSE {other} END")
    v2 = "k % 7 = 0"
    base = ev.join(region, (ev.user_id % 5) == region.r_regionkey, "left").selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CAST(user_id AS STRING) AS session_id",
        "CAST(user_id AS STRING) AS user_id",
        "ts AS timestamp",
        f"{etype} AS event_type",
        f"{_channel('user_id')} AS content_id",
        "r_name AS region",
        f"{_pick('k % 4', DEVICES)} AS device",
        f"{_pick('k % 3', CDNS)} AS cdn",
        "CAST(floor(value * 100) AS INT) AS bitrate_kbps",
        "k * 100 AS buffer_length_ms",
        "CASE WHEN event_type = 'error' THEN concat('E', CAST(k AS STRING)) END AS error_code",
        f"CASE WHEN {v2} THEN 'v2' END AS schema_version",
        f"CASE WHEN {v2} THEN {_pick('k % 3', NETWORKS)} END AS network_type",
        "k",
    )
    if deliveries:
        base = with_deliveries(base)
    return base if keep_k else base.drop("k")


def with_deliveries(base: DataFrame, keep_copy: bool = False) -> DataFrame:
    """At-least-once delivery in one pass: each row is exploded into its
    delivered copies (0 = original, 1 = exact replay, 2 = re-send shifted by
    ``RESEND_SHIFT_S``); column ``_copy`` names the copy."""
    copies = "CASE WHEN k >= 95 THEN array(0, 1) WHEN k >= 90 AND k < 95 THEN array(0, 2) ELSE array(0) END"
    out = base.selectExpr("*", f"explode({copies}) AS _copy")
    cols = [f"CASE WHEN _copy = 2 THEN `timestamp` + INTERVAL {RESEND_SHIFT_S} SECONDS ELSE `timestamp` END "
            "AS `timestamp`" if c == "timestamp" else f"`{c}`" for c in base.columns]
    return out.selectExpr(*cols, *(["_copy"] if keep_copy else []))


def markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCTE-35 cue markers: the signup rows."""
    ensure_defaults(spark)
    ev = _events_with_k(spark, sf_dir).where("event_type = 'signup'")
    break_type = _pick("k % 10", ("program_boundary", "blackout"), default="'commercial'")
    return ev.selectExpr(
        "CAST(event_id AS STRING) AS marker_id",
        f"{_channel('event_id')} AS channel",
        "'splice_insert' AS splice_command",
        "k AS event_id_scte",
        "true AS out_of_network",
        "(unix_micros(ts) * 9) div 100 AS pts_time",
        "ts AS wallclock",
        "(k % 31) * 30 AS duration_s",
        f"{break_type} AS break_type",
    )


def ad_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ad decision per line item; advertiser = supplier."""
    ensure_defaults(spark)
    li = table(spark, sf_dir, "lineitem")
    sup = broadcast_if_small(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))
    j = li.join(sup, li.l_suppkey == sup.s_suppkey, "left")
    return j.selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS decision_id",
        "CAST(l_orderkey AS STRING) AS marker_id",
        f"{_channel('l_orderkey')} AS channel",
        "l_linenumber AS slot_index",
        "CAST(l_partkey AS STRING) AS creative_id",
        "CAST(l_suppkey AS STRING) AS advertiser_id",
        "s_name AS advertiser_name",
        "l_extendedprice AS price_cpm_brl",
        "CAST(l_shipdate AS TIMESTAMP) AS served_ts",
    )


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue: one content per nation, padded id, genre = region name."""
    ensure_defaults(spark)
    n = table(spark, sf_dir, "nation")
    r = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    j = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return j.select(
        F.concat(F.lit(" ch-"), F.col("n_nationkey").cast("string"), F.lit(" ")).alias("content_id"),
        F.col("n_name").alias("title"),
        F.col("r_name").alias("genre"),
        (start + F.make_dt_interval(F.col("n_nationkey"))).alias("rights_window_start"),
        (start + F.make_dt_interval(F.col("n_nationkey") + 20)).alias("rights_window_end"),
        F.array(F.col("r_name"), F.lit("AMERICA")).alias("rights_territories"),
        F.lit("2023-12-01 00:00:00").cast("timestamp").alias("updated_at"),
    )


def content_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two SCD2 versions per content: the second renames the title at
    ``SCD2_CHANGE`` plus ``n_nationkey`` hours."""
    v1 = content(spark, sf_dir)
    key = F.regexp_extract(F.trim("content_id"), r"(\d+)$", 1).cast("int")
    v2 = v1.select(
        "content_id", F.concat(F.col("title"), F.lit(" (v2)")).alias("title"), "genre",
        "rights_window_start", "rights_window_end", "rights_territories",
        (F.lit(SCD2_CHANGE).cast("timestamp") + F.make_dt_interval(F.lit(0), key)).alias("updated_at"))
    return v1.unionByName(v2)


# ---- wire feeds (JSON in the Kafka record layout) ---------------------------
# Contract breaches injected by rule: k = 13 payload cut short (malformed),
# k = 17 no "cdn" key, k = 19 bitrate sent as text.
BROKEN_K, NO_CDN_K, BAD_TYPE_K = 13, 17, 19


def _event_payload(k: F.Column) -> F.Column:
    """One ``to_json`` per row; v1 rows then lose the v2 keys and the injected
    breaches are applied with plain string edits."""
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    device = F.struct(F.col("device").alias("type"),
                      F.concat(F.col("device"), F.lit("-m"), (k % 5).cast("string")).alias("model"),
                      F.concat(F.lit("os-"), (k % 3).cast("string")).alias("os"),
                      F.concat(F.lit("1.0."), (k % 4).cast("string")).alias("app_version"))
    geo = F.struct(F.col("region").alias("region"),
                   F.concat(F.lit("st-"), (F.col("user_id").cast("long") % 27).cast("string")).alias("state"),
                   F.concat(F.lit("city-"), (F.col("user_id").cast("long") % 50).cast("string")).alias("city"),
                   F.concat(F.lit("isp-"), (k % 6).cast("string")).alias("isp"))
    doc = F.struct(F.col("event_id"), F.col("session_id"), F.col("user_id"), iso.alias("timestamp"),
                   F.col("event_type"), F.col("content_id"), F.lit(True).alias("is_live"), device.alias("device"),
                   geo.alias("geo"), F.col("cdn"), F.col("bitrate_kbps"), F.col("buffer_length_ms"),
                   (k * 6).alias("playhead_position_s"), F.col("error_code"), F.col("schema_version"),
                   F.col("network_type"))
    text = F.to_json(doc, {"ignoreNullFields": "false"})
    text = F.when(F.col("schema_version").isNull(),
                  F.replace(text, F.lit(',"schema_version":null,"network_type":null'), F.lit(""))).otherwise(text)
    return (F.when(k == BROKEN_K, F.substring(text, 1, 25))
            .when(k == NO_CDN_K, F.regexp_replace(text, '"cdn":"[^"]*",', ""))
            .when(k == BAD_TYPE_K, F.regexp_replace(text, '"bitrate_kbps":-?[0-9]+', '"bitrate_kbps":"fast"'))
            .otherwise(text))


def raw_player_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The player feed as Kafka records (Bronze layout): JSON ``value``,
    key = session, 8 partitions by user, offset unique per delivered copy,
    ingest time = event time + (k % 5) s."""
    ensure_defaults(spark)
    pe = player_events(spark, sf_dir, deliveries=False, keep_k=True)
    k = F.col("k")
    feed = with_deliveries(pe, keep_copy=True)
    return feed.select(
        F.col("session_id").cast("binary").alias("key"),
        _event_payload(k).cast("binary").alias("value"),
        F.lit("player_events").alias("topic"),
        (F.col("session_id").cast("long") % 8).cast("int").alias("partition"),
        (F.col("event_id").cast("long") * 4 + F.col("_copy")).alias("offset"),
        (F.col("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), k % 5)).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def raw_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cue feed as Kafka records."""
    m = markers(spark, sf_dir)
    payload = F.to_json(F.struct(*[F.date_format("wallclock", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("wallclock")
                                   if c == "wallclock" else F.col(c) for c in m.columns]))
    return m.select(F.col("marker_id").cast("binary").alias("key"), payload.cast("binary").alias("value"),
                    F.lit("scte35_markers").alias("topic"), F.lit(0).alias("partition"),
                    F.col("marker_id").cast("long").alias("offset"), F.col("wallclock").alias("timestamp"),
                    F.lit(0).alias("timestampType"))
