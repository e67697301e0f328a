"""Registered streaming queries: the wire feed lands as JSON lines, Bronze
ingests it as a stream, Silver streams from Bronze; each query runs the
streams to completion (``availableNow``) in a fresh folder under the shared
checkpoint root and returns the sink as a static DataFrame.

A sentinel event and marker later than everything close the last windows
(append mode holds a window until the watermark passes it); sentinel output
is filtered out by its own id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from crowdpulse.plans.oracle import CTES, with_ctes
from crowdpulse.plans.registry import ORACLES, SPAN, WINDOW, register
from crowdpulse.session import freed_shuffles, scratch_path
from crowdpulse.operators.gold import stream_batch_reconcile
from crowdpulse.sinks.writers import bronze_ingest, read_upserted, silver_upsert
from crowdpulse.sources import testmap as tm
from crowdpulse.sources.parse import filter_required, parse_player_events
from crowdpulse.sources.readers import read_event_stream, read_marker_stream, read_raw_stream
from crowdpulse.operators.fragments import session_fragments, session_qoe, sessions_from_fragments
from crowdpulse.operators.silver import rebuffer_rolling5
from crowdpulse.operators.slo import slo_freshness
from crowdpulse.plans.silver_queries import silver_table
from crowdpulse.streaming.markers import silver_with_fresh_markers
from crowdpulse.streaming.pipeline import backfill, dedupe_stream, late_rows, silver_stream, silver_stream_salted, start_to_parquet

SENTINEL = "sentinel"


def _sentinel_time(df, margin: str = "30 days"):
    """A time later than all of ``df``'s, far enough to close every window."""
    return df.agg((F.max("timestamp") + F.expr(f"INTERVAL {margin}")).alias("t")).select(
        F.coalesce("t", F.current_timestamp()).alias("t"))


def _sentinel_event(df):
    t = F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp")
    lit = [F.lit(v).alias(k) for k, v in (("event_id", SENTINEL), ("session_id", SENTINEL), ("event_type", "heartbeat"),
                                          ("content_id", SENTINEL), ("region", SENTINEL), ("cdn", SENTINEL))]
    return _sentinel_time(df).select(F.to_json(F.struct(t, *lit)).alias("value"))


def _sentinel_marker(df):
    t = F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("wallclock")
    lit = [F.lit(v).alias(k) for k, v in (("marker_id", SENTINEL), ("channel", SENTINEL), ("break_type", "commercial"))]
    return _sentinel_time(df).select(F.to_json(F.struct(t, *lit)).alias("value"))


CTES.update({
    "markers_ms": (("markers",), """
SELECT * REPLACE (date_trunc('millisecond', wallclock) AS wallclock) FROM markers"""),
    "ev_dedup_parsed": (("pe_parsed",), """
SELECT DISTINCT * EXCLUDE (k) FROM pe_parsed"""),
})
CTES["ev_marked_parsed"] = (("ev_dedup_parsed", "markers_ms"), CTES["ev_marked"][1].replace(
    "FROM ev_dedup e LEFT JOIN markers m", "FROM ev_dedup_parsed e LEFT JOIN markers_ms m"))
CTES["silver_parsed"] = (("ev_marked_parsed",), CTES["silver"][1].replace("FROM ev_marked", "FROM ev_marked_parsed"))


def _land(spark, sf_dir, root):
    """Write the wire feeds as JSON-line files (several per feed) plus sentinels."""
    ev_dir, mk_dir = f"{root}/landing_events", f"{root}/landing_markers"
    tm.raw_player_events(spark, sf_dir).select(F.col("value").cast("string").alias("value")) \
        .repartition(4).write.mode("overwrite").text(ev_dir)
    tm.raw_markers(spark, sf_dir).select(F.col("value").cast("string").alias("value")) \
        .repartition(2).write.mode("overwrite").text(mk_dir)
    feed = tm.player_events(spark, sf_dir).select("timestamp")
    _sentinel_event(feed).write.mode("append").text(ev_dir)
    _sentinel_marker(feed).write.mode("append").text(mk_dir)
    return ev_dir, mk_dir


def _bronze(spark, sf_dir, root):
    ev_dir, mk_dir = _land(spark, sf_dir, root)
    raw = read_raw_stream(spark, "text", {"path": ev_dir}, "player_events")
    q = bronze_ingest(raw, f"{root}/bronze", f"{root}/ckpt_bronze", trigger="availableNow")
    q.awaitTermination()
    return f"{root}/bronze", mk_dir


def _silver_body(cols: str) -> str:
    return f"SELECT {cols} FROM silver_parsed"


_NO_CCV = ("window_start, window_end, region, device, cdn, marker_id, avg_bitrate_kbps, avg_buffer_length_ms, "
           "error_rate, rebuffering_ratio, event_count, error_count")


@register("silver_stream", with_ctes(_silver_body(_NO_CCV), "silver_parsed"))
def q_silver_stream(spark, sf_dir):
    """Bronze stream -> parse -> watermark dedupe -> stream-stream interval join
    -> windowed cube (ST1-ST4, ST7, ST8, ST10, SK1, SK2, IO1-IO4). CCV is HLL++
    on a stream, so it is left out of the comparison."""
    root = scratch_path(spark, "silver-stream")
    bronze, mk_dir = _bronze(spark, sf_dir, root)
    events = filter_required(parse_player_events(read_raw_stream(spark, "parquet", {"path": bronze})))
    markers = read_marker_stream(spark, "text", {"path": mk_dir})
    out = silver_stream(events, markers, WINDOW, SPAN, delay="15 seconds")
    start_to_parquet(out, f"{root}/silver", f"{root}/ckpt_silver").awaitTermination()
    res = spark.read.parquet(f"{root}/silver")
    return res.where(F.col("cdn") != SENTINEL).drop("ccv")


@register("silver_stream_static_markers", with_ctes(_silver_body(_NO_CCV), "silver_parsed"))
def q_silver_stream_static(spark, sf_dir):
    """Same stream against a static marker table (stream-static join, J2),
    which cannot be held back by a sparse cue stream (D12)."""
    root = scratch_path(spark, "silver-stream-static")
    bronze, _ = _bronze(spark, sf_dir, root)
    events = filter_required(parse_player_events(read_raw_stream(spark, "parquet", {"path": bronze})))
    markers = tm.markers(spark, sf_dir).withColumn(
        "wallclock", F.date_trunc("millisecond", "wallclock"))
    out = silver_stream(events, markers, WINDOW, SPAN, delay="15 seconds", static_markers=True)
    start_to_parquet(out, f"{root}/silver", f"{root}/ckpt_silver").awaitTermination()
    res = spark.read.parquet(f"{root}/silver")
    return res.where(F.col("cdn") != SENTINEL).drop("ccv")


@register("dedupe_stream", with_ctes("""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT event_id) AS n_ids FROM (SELECT DISTINCT event_id FROM pe_parsed) t""",
                                     "pe_parsed"))
def q_dedupe_stream(spark, sf_dir):
    """Watermarked dedupe by event_id only (ST2, D13) from the Bronze stream."""
    root = scratch_path(spark, "dedupe-stream")
    bronze, _ = _bronze(spark, sf_dir, root)
    events = filter_required(parse_player_events(read_raw_stream(spark, "parquet", {"path": bronze})))
    d = dedupe_stream(events, "15 seconds", by_id_only=True).select("event_id", "timestamp")
    start_to_parquet(d, f"{root}/out", f"{root}/ckpt").awaitTermination()
    res = spark.read.parquet(f"{root}/out").where(F.col("event_id") != SENTINEL)
    return res.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_ids"))


@register("backfill", with_ctes(f"""
SELECT * FROM silver_parsed
WHERE window_start >= TIMESTAMP '2024-01-08 00:00:00' AND window_start < TIMESTAMP '2024-01-15 00:00:00'""",
                                "silver_parsed"))
def q_backfill(spark, sf_dir):
    """Batch recompute of one week of Silver from Bronze with exact CCV and a
    dynamic partition overwrite (ST12, IO8, SK8)."""
    root = scratch_path(spark, "backfill")
    bronze = f"{root}/bronze"
    # Bronze as Kafka records with broker timestamps, partitioned by ingest date
    tm.raw_player_events(spark, sf_dir).withColumn("event_date", F.to_date("timestamp")) \
        .write.mode("overwrite").partitionBy("event_date").parquet(bronze)
    markers = tm.markers(spark, sf_dir).withColumn("wallclock", F.date_trunc("millisecond", "wallclock"))
    backfill(spark, bronze, f"{root}/silver", markers, "2024-01-08 00:00:00", "2024-01-15 00:00:00",
             WINDOW, SPAN)
    # a second run over the same range must leave the table unchanged (idempotent)
    out = backfill(spark, bronze, f"{root}/silver", markers, "2024-01-08 00:00:00", "2024-01-15 00:00:00",
                   WINDOW, SPAN)
    return out.drop("event_date")


@register("backfill_partial_day", with_ctes("SELECT * FROM silver_parsed", "silver_parsed"))
def q_backfill_partial_day(spark, sf_dir):
    """A full run, then a backfill of two hours inside a day (ST12). A third of the records reached Bronze three hours
    late and a third before their own event time; the table must still be the full Silver."""
    root = scratch_path(spark, "backfill-partial")
    bronze = f"{root}/bronze"
    third = F.pmod(F.xxhash64("value"), F.lit(3))
    shift = F.when(third == 0, F.expr("INTERVAL 3 HOURS")).when(third == 1, F.expr("INTERVAL -10 SECONDS")).otherwise(F.expr("INTERVAL 0 SECONDS"))
    tm.raw_player_events(spark, sf_dir).withColumn("timestamp", F.col("timestamp") + shift) \
        .withColumn("event_date", F.to_date("timestamp")).write.partitionBy("event_date").parquet(bronze)
    markers = tm.markers(spark, sf_dir).withColumn("wallclock", F.date_trunc("millisecond", "wallclock"))
    backfill(spark, bronze, f"{root}/silver", markers, None, None, WINDOW, SPAN)
    out = backfill(spark, bronze, f"{root}/silver", markers, "2024-01-10 10:00:00", "2024-01-10 12:00:00", WINDOW, SPAN)
    return out.drop("event_date")


@register("backfill_pruned", with_ctes("SELECT * FROM silver_parsed", "silver_parsed"))
def q_backfill_pruned(spark, sf_dir):
    """The same with a zone map (ST12, IO8): late and early records lie in other ingest dates than their own, and the map finds
    those dates."""
    root = scratch_path(spark, "backfill-pruned")
    bronze = f"{root}/bronze"
    third = F.pmod(F.xxhash64("value"), F.lit(3))
    shift = F.when(third == 0, F.expr("INTERVAL 3 HOURS")).when(third == 1, F.expr("INTERVAL -10 SECONDS")).otherwise(F.expr("INTERVAL 0 SECONDS"))
    tm.raw_player_events(spark, sf_dir).withColumn("timestamp", F.col("timestamp") + shift) \
        .withColumn("event_date", F.to_date("timestamp")).write.partitionBy("event_date").parquet(bronze)
    markers = tm.markers(spark, sf_dir).withColumn("wallclock", F.date_trunc("millisecond", "wallclock"))
    backfill(spark, bronze, f"{root}/silver", markers, None, None, WINDOW, SPAN, zones_path=f"{root}/zones")
    out = backfill(spark, bronze, f"{root}/silver", markers, "2024-01-10 10:00:00", "2024-01-10 12:00:00", WINDOW, SPAN, zones_path=f"{root}/zones")
    return out.drop("event_date")


@register("late_rows", with_ctes("""
SELECT DISTINCT event_id, "timestamp" FROM pe_parsed WHERE "timestamp" < TIMESTAMP '2024-01-10 00:00:00'""", "pe_parsed"))
def q_late_rows(spark, sf_dir):
    """Two deliveries, the second of days long past the watermark (ST8, ST9): the stream drops them, and the batch side
    finds exactly those in Bronze."""
    root = scratch_path(spark, "late-rows")
    feed = filter_required(parse_player_events(tm.raw_player_events(spark, sf_dir))).select("event_id", "timestamp")
    old = F.col("timestamp") < F.lit("2024-01-10 00:00:00").cast("timestamp")
    for part in (feed.where(~old), feed.where(old)):
        part.write.mode("append").parquet(f"{root}/feed")
        stream = spark.readStream.schema(feed.schema).parquet(f"{root}/feed")
        start_to_parquet(dedupe_stream(stream), f"{root}/processed", f"{root}/ckpt").awaitTermination()
    return late_rows(spark.read.parquet(f"{root}/feed"), spark.read.parquet(f"{root}/processed")).distinct()


def _two_deliveries(spark, sf_dir, root, **kw):
    """Silver rows in two feeds that write one table in turn: stale rows of every cell, then an empty feed, then the true rows
    of each half under the two checkpoints."""
    keys = ["window_start", "region", "device", "cdn", "marker_id"]
    given = silver_table(spark, sf_dir)
    with freed_shuffles(spark):
        given.write.parquet(f"{root}/silver")
    silver = spark.read.schema(given.schema).parquet(f"{root}/silver")
    half = F.col("window_start") < F.lit("2024-01-15 00:00:00").cast("timestamp")
    stale = silver.withColumns({"ccv": F.lit(0).cast("long"), "event_count": F.lit(0).cast("long")})
    for feed, part in (("a", stale), ("b", silver.limit(0)), ("b", silver.where(half)), ("a", silver.where(~half))):
        part.write.mode("append").parquet(f"{root}/feed-{feed}")
        stream = spark.readStream.schema(given.schema).parquet(f"{root}/feed-{feed}")
        silver_upsert(stream, f"{root}/table", f"{root}/ckpt-{feed}", keys, trigger="availableNow", parts=8, **kw).awaitTermination()
    return read_upserted(spark, f"{root}/table")


@register("silver_upsert", with_ctes("SELECT * FROM silver", "silver"))
def q_silver_upsert(spark, sf_dir):
    """Keyed upsert of Silver rows by their five keys (SK3-SK5, DQ6): two feeds in turn, the default checks, an empty
    delivery; the row written last for a cell remains."""
    return _two_deliveries(spark, sf_dir, scratch_path(spark, "upsert"))


@register("slo_freshness_silver", with_ctes("""
SELECT COUNT(*) AS rows, CAST(SUM(CASE WHEN lag <= 120 THEN 1 ELSE 0 END) AS BIGINT) AS within, MAX(lag) AS max_lag_s,
       CAST(SUM(CASE WHEN lag <= 120 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS share, 'freshness' AS slo,
       CAST(SUM(CASE WHEN lag <= 120 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) >= 0.999 AS met
FROM (SELECT 30.0 * (event_count % 6) AS lag FROM silver) t""", "silver"))
def q_slo_freshness_silver(spark, sf_dir):
    """Freshness of Silver at emission (SL1): the sink stamps each row as it is written, and the level is measured from a
    window's end to that. The feed is replayed, so its clock runs with the data: 30 s a step of event_count modulo 6."""
    clock = F.col("window_end") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), 30 * (F.col("event_count") % 6))
    table = _two_deliveries(spark, sf_dir, scratch_path(spark, "freshness"), stamp="emitted_at", clock=clock)
    return slo_freshness(table, "window_end", "emitted_at", 120)


@register("stream_batch_reconcile_live", with_ctes("""
SELECT COUNT(*) AS cells, CAST(0 AS BIGINT) AS differing_rows FROM silver_parsed""", "silver_parsed"))
def q_stream_batch_reconcile_live(spark, sf_dir):
    """The Silver stream's own output against a batch recompute of the same Bronze (J10): counts must agree exactly, CCV
    within three of the sketch's standard errors."""
    root = scratch_path(spark, "reconcile")
    bronze, mk_dir = _bronze(spark, sf_dir, root)
    events = filter_required(parse_player_events(read_raw_stream(spark, "parquet", {"path": bronze})))
    markers = read_marker_stream(spark, "text", {"path": mk_dir})
    start_to_parquet(silver_stream(events, markers, WINDOW, SPAN, delay="15 seconds"), f"{root}/silver", f"{root}/ckpt").awaitTermination()
    mk = tm.markers(spark, sf_dir).withColumn("wallclock", F.date_trunc("millisecond", "wallclock"))
    batch = backfill(spark, bronze, f"{root}/batch", mk, window=WINDOW, span=SPAN).where(F.col("cdn") != SENTINEL)
    live = spark.read.parquet(f"{root}/silver").where(F.col("cdn") != SENTINEL)
    keys = ["window_start", "region", "device", "cdn", "marker_id"]
    far = stream_batch_reconcile(live, batch, measures=("event_count", "error_count"))
    ccv = live.select(*keys, F.col("ccv").alias("a")).join(batch.select(*keys, F.col("ccv").alias("b")), keys)
    wide = ccv.where(F.abs(F.col("a") - F.col("b")) > F.greatest(F.lit(1.0), 0.15 * F.col("b")))
    parts = [df.select(F.lit(cell).alias("cell"), F.lit(bad).alias("bad")) for df, cell, bad in ((batch, 1, 0), (far, 0, 1), (wide, 0, 1))]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.agg(F.sum("cell").alias("cells"), F.sum("bad").alias("differing_rows"))


def _delivered(spark, sf_dir, root, files: int = 3):
    """The delivered feed as a stream of files, a sentinel event behind the last."""
    feed = tm.player_events(spark, sf_dir)
    feed.repartition(files).write.parquet(f"{root}/in")
    last = feed.limit(1).withColumns({c: F.lit(SENTINEL) for c in ("event_id", "session_id", "cdn", "content_id")}).withColumn(
        "timestamp", F.lit(_sentinel_time(feed).first()["t"]))
    last.write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema(feed.schema).parquet(f"{root}/in")


@register("rebuffer_rolling5_stream", ORACLES["rebuffer_rolling5"])
def q_rebuffer_rolling5_stream(spark, sf_dir):
    """The sliding rebuffer share as a stream (ST5): dedupe, panes, windows over panes."""
    root = scratch_path(spark, "rolling")
    out = rebuffer_rolling5(dedupe_stream(_delivered(spark, sf_dir, root), "15 seconds"), "5 hours", "1 hour")
    start_to_parquet(out, f"{root}/out", f"{root}/ckpt").awaitTermination()
    return spark.read.parquet(f"{root}/out").where(F.col("cdn") != SENTINEL)


@register("silver_stream_salted", with_ctes("""
SELECT window_start, window_end, region, device, cdn, marker_id, avg_bitrate_kbps, avg_buffer_length_ms, error_rate, rebuffering_ratio,
       event_count, error_count, TRUE AS ccv_near FROM silver_parsed""", "silver_parsed"))
def q_silver_stream_salted(spark, sf_dir):
    """The Silver stream with salted join state and two chained aggregates (ST4, J1): all measures equal the batch, and the
    sketches' CCV lies within four standard errors (at least 1) of the exact count."""
    root = scratch_path(spark, "silver-salted")
    bronze, mk_dir = _bronze(spark, sf_dir, root)
    events = filter_required(parse_player_events(read_raw_stream(spark, "parquet", {"path": bronze})))
    markers = read_marker_stream(spark, "text", {"path": mk_dir})
    start_to_parquet(silver_stream_salted(events, markers, WINDOW, SPAN, delay="15 seconds", salts=4), f"{root}/silver", f"{root}/ckpt").awaitTermination()
    live = spark.read.parquet(f"{root}/silver").where(F.col("cdn") != SENTINEL)
    mk = tm.markers(spark, sf_dir).withColumn("wallclock", F.date_trunc("millisecond", "wallclock"))
    exact = backfill(spark, bronze, f"{root}/batch", mk, window=WINDOW, span=SPAN)
    keys = ["window_start", "region", "device", "cdn", "marker_id"]
    both = live.join(exact.select(*keys, F.col("ccv").alias("exact")), keys)
    near = F.abs(F.col("ccv") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.052 * F.col("exact"))
    return both.select(*live.drop("ccv").columns, near.alias("ccv_near"))


@register("silver_stream_fresh_markers", with_ctes("SELECT * FROM silver_parsed", "silver_parsed"))
def q_silver_stream_fresh_markers(spark, sf_dir):
    """Markers that arrive while the stream runs (J2, D12): the marker table is empty at the start, and each delivery of
    events is followed by its markers, which the running query reads before it computes the windows. Equals the batch Silver."""
    root = scratch_path(spark, "fresh-markers")
    feed = filter_required(parse_player_events(tm.raw_player_events(spark, sf_dir))).drop("ingest_ts")
    markers = tm.markers(spark, sf_dir).withColumn("wallclock", F.date_trunc("millisecond", "wallclock"))
    markers.limit(0).write.parquet(f"{root}/markers")
    feed.limit(0).write.parquet(f"{root}/in")
    stream = dedupe_stream(spark.readStream.schema(feed.schema).parquet(f"{root}/in"), "15 seconds")
    query = silver_with_fresh_markers(stream, lambda: spark.read.schema(markers.schema).parquet(f"{root}/markers"), f"{root}/silver", f"{root}/held",
                                      f"{root}/ckpt", window=WINDOW, span=SPAN, hold="10 days", trigger={"processingTime": "0 seconds"})
    try:
        bounds = [None, "2024-01-11 00:00:00", "2024-01-21 00:00:00", None]
        for start, end in zip(bounds[:-1], bounds[1:]):
            for df, t, to in ((feed, "timestamp", "in"), (markers, "wallclock", "markers")):
                part = df if start is None else df.where(F.col(t) >= F.lit(start).cast("timestamp"))
                part = part if end is None else part.where(F.col(t) < F.lit(end).cast("timestamp"))
                part.write.mode("append").parquet(f"{root}/{to}")
                if to == "in":
                    query.processAllAvailable()
        last = feed.limit(1).withColumns({"event_id": F.lit(SENTINEL), "cdn": F.lit(SENTINEL), "timestamp": F.lit(_sentinel_time(feed).first()["t"])})
        last.write.mode("append").parquet(f"{root}/in")
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.parquet(f"{root}/silver").where(F.col("cdn") != SENTINEL).drop("batch_id")


_NEXT = """
SELECT session_id, "timestamp" AS t, event_type AS e, lead("timestamp") OVER w AS nt, lead(event_type) OVER w AS ne
FROM ev_dedup WINDOW w AS (PARTITION BY session_id ORDER BY "timestamp", event_type)"""
_QOE_SQL = f"""
WITH b AS (SELECT session_id, MIN("timestamp") AS start_ts, MAX("timestamp") AS end_ts, COUNT(*) AS events,
                  bool_or(event_type IN ('video_end', 'error')) AS closed,
                  bool_or(event_type = 'video_start') AND NOT bool_or(event_type = 'heartbeat') AS exit_before_start FROM ev_dedup GROUP BY 1),
s AS (SELECT session_id, COUNT(*) AS stalls, SUM((epoch_us(nt) - epoch_us(t)) / 1000.0) AS stall_ms
      FROM ({_NEXT}) n WHERE e = 'buffer_start' AND ne = 'buffer_end' GROUP BY 1),
v AS (SELECT session_id, MIN("timestamp") AS v FROM ev_dedup WHERE event_type = 'video_start' GROUP BY 1),
u AS (SELECT v.session_id, (epoch_us(MIN(e."timestamp")) - epoch_us(v.v)) / 1000.0 AS startup_ms
      FROM v JOIN ev_dedup e ON e.session_id = v.session_id AND e."timestamp" >= v.v AND e.event_type <> 'video_start' GROUP BY v.session_id, v.v)
SELECT b.*, (epoch_us(end_ts) - epoch_us(start_ts)) / 1000.0 AS watch_ms, COALESCE(s.stalls, 0) AS stalls, COALESCE(s.stall_ms, 0.0) AS stall_ms,
       CAST(ROUND(CAST(CASE WHEN end_ts > start_ts THEN COALESCE(s.stall_ms, 0.0) / ((epoch_us(end_ts) - epoch_us(start_ts)) / 1000.0) END
            AS DECIMAL(38,10)), 8) AS DOUBLE) AS rebuffer_ratio, u.startup_ms
FROM b LEFT JOIN s USING (session_id) LEFT JOIN u USING (session_id)"""


@register("session_qoe_stream", with_ctes(_QOE_SQL, "ev_dedup"))
def q_session_qoe_stream(spark, sf_dir):
    """Quality of experience per session from a stream (SE1-SE4, W2): dedupe, then fragments closed by the watermark, merged
    in the sink's table. Equals the batch figures."""
    root = scratch_path(spark, "session-qoe")
    parts = session_fragments(dedupe_stream(_delivered(spark, sf_dir, root), "15 seconds"), "6 hours")
    start_to_parquet(parts, f"{root}/out", f"{root}/ckpt").awaitTermination()
    qoe = session_qoe(spark.read.parquet(f"{root}/out").where(F.col("session_id") != SENTINEL))
    return qoe.withColumn("rebuffer_ratio", F.round(F.col("rebuffer_ratio").cast("decimal(38,10)"), 8).cast("double"))


@register("session_qoe", with_ctes(_QOE_SQL, "ev_dedup"))
def q_session_qoe(spark, sf_dir):
    """The same fragments in batch."""
    qoe = session_qoe(session_fragments(tm.player_events(spark, sf_dir).dropDuplicates(["event_id", "timestamp"]), "1 hour"))
    return qoe.withColumn("rebuffer_ratio", F.round(F.col("rebuffer_ratio").cast("decimal(38,10)"), 8).cast("double"))


@register("bronze_ingest", with_ctes("""
SELECT COUNT(*) + 1 AS records, COUNT(DISTINCT CASE WHEN k <> 13 THEN event_id END) + 1 AS event_ids
FROM pe_feed""", "pe_feed"))
def q_bronze_ingest(spark, sf_dir):
    """Landing files -> Bronze stream (raw Kafka layout, partitioned by ingest
    date) (IO3, SK1, SK2, ST10); counts every record incl. the sentinel and
    the event ids readable from the payloads (truncated ones have none)."""
    root = scratch_path(spark, "bronze")
    bronze, _ = _bronze(spark, sf_dir, root)
    b = spark.read.parquet(bronze)
    eid = F.get_json_object(F.col("value").cast("string"), "$.event_id")
    return b.agg(F.count(F.lit(1)).alias("records"), F.count_distinct(eid).alias("event_ids"))


@register("event_stream_batches", with_ctes("""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT event_id) AS n_ids, MIN("timestamp") AS first_ts, MAX("timestamp") AS last_ts, TRUE AS several_batches
FROM pe_parsed""", "pe_parsed"))
def q_event_stream_batches(spark, sf_dir):
    """The parsed event source with a rate limit (IO1, IO4): one landing file a micro-batch, so the feed takes several."""
    root = scratch_path(spark, "event-stream")
    ev_dir, _ = _land(spark, sf_dir, root)
    events = read_event_stream(spark, "text", {"path": ev_dir}, max_per_trigger=1).select("event_id", "timestamp")

    def process(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    events.writeStream.foreachBatch(process).option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{root}/out").where(F.col("event_id") != SENTINEL)
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_ids"), F.min("timestamp").alias("first_ts"),
                   F.max("timestamp").alias("last_ts"), (F.count_distinct("batch_id") > 1).alias("several_batches"))


@register("bronze_restart", with_ctes("""
SELECT COUNT(*) AS records, COUNT(DISTINCT CASE WHEN k <> 13 THEN event_id END) AS event_ids FROM pe_feed""", "pe_feed"))
def q_bronze_restart(spark, sf_dir):
    """Bronze stopped and started again under its checkpoint (ST10, ST11): the second run takes only what came since, and a third
    with nothing new adds nothing."""
    root = scratch_path(spark, "bronze-restart")
    lines = tm.raw_player_events(spark, sf_dir).select(F.col("value").cast("string").alias("value"))
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    for part in (lines.where(first), lines.where(~first), None):
        if part is not None:
            part.repartition(3).write.mode("append").text(f"{root}/landing")
        raw = read_raw_stream(spark, "text", {"path": f"{root}/landing"}, "player_events", max_per_trigger=2)
        bronze_ingest(raw, f"{root}/bronze", f"{root}/ckpt", trigger="availableNow").awaitTermination()
    eid = F.get_json_object(F.col("value").cast("string"), "$.event_id")
    return spark.read.parquet(f"{root}/bronze").agg(F.count(F.lit(1)).alias("records"), F.count_distinct(eid).alias("event_ids"))


@register("gold_write_partitioned", with_ctes("SELECT * FROM gold", "gold"))
def q_gold_write_partitioned(spark, sf_dir):
    """Gold written twice with dynamic partition overwrite and read back: the
    rewrite is idempotent (SK8, T5)."""
    from crowdpulse.plans.gold_queries import gold_table
    from crowdpulse.sinks.writers import gold_write_partitioned
    path = scratch_path(spark, "gold") + "/gold"
    gold_write_partitioned(gold_table(spark, sf_dir, filtered=True), path)
    gold_write_partitioned(gold_table(spark, sf_dir, filtered=True), path)
    return spark.read.parquet(path).drop("event_date")


@register("jsonl_roundtrip", with_ctes("""
SELECT marker_id, channel, splice_command, event_id_scte, out_of_network, pts_time, wallclock, duration_s,
       break_type FROM markers_ms""", "markers_ms"))
def q_jsonl_roundtrip(spark, sf_dir):
    """Markers published as JSON lines (IO7), converted to Snappy Parquet with
    the explicit contract schema (IO9, IO5) and read back."""
    from crowdpulse import schemas
    from crowdpulse.sources.readers import jsonl_to_parquet, publish_jsonl
    root = scratch_path(spark, "jsonl")
    tm.raw_markers(spark, sf_dir).select(F.col("value").cast("string").alias("value")).write.text(f"{root}/src")
    publish_jsonl(spark, f"{root}/src", "file", {"path": f"{root}/drop"})
    jsonl_to_parquet(spark, f"{root}/drop", f"{root}/pq", schemas.SCTE35_MARKER)
    return spark.read.parquet(f"{root}/pq")


@register("sessionise_stream", with_ctes("""
SELECT * FROM (
SELECT session_id, content_id, MIN("timestamp") AS session_start, MAX("timestamp") + INTERVAL 3 HOUR AS session_end,
       COUNT(*) AS events, bool_or(event_type IN ('video_end', 'error')) AS closed
FROM (SELECT *, SUM(brk) OVER (PARTITION BY session_id, content_id ORDER BY "timestamp"
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn
      FROM (SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY session_id, content_id
                                                                    ORDER BY "timestamp") < INTERVAL 3 HOUR
                           THEN 0 ELSE 1 END AS brk
            FROM ev_dedup) a) b
GROUP BY session_id, content_id, sn) s""", "ev_dedup"))
def q_sessionise_stream(spark, sf_dir):
    """Streaming sessionisation after watermarked dedupe (ST2, ST6) over the
    delivered feed, sentinel-closed; equals the batch sessions."""
    from crowdpulse.operators.sessions import sessionise
    root = scratch_path(spark, "sessions")
    feed = tm.player_events(spark, sf_dir)
    feed.repartition(3).write.parquet(f"{root}/in")
    sentinel = feed.limit(1).withColumn("session_id", F.lit(SENTINEL)).withColumn(
        "timestamp", F.lit(_sentinel_time(feed).first()["t"]))
    sentinel.write.mode("append").parquet(f"{root}/in")
    s = spark.readStream.schema(feed.schema).parquet(f"{root}/in")
    out = sessionise(dedupe_stream(s, "15 seconds"), "3 hours", keys=("session_id", "content_id"))
    start_to_parquet(out, f"{root}/out", f"{root}/ckpt").awaitTermination()
    return spark.read.parquet(f"{root}/out").where(F.col("session_id") != SENTINEL)


@register("sessionise_fragments_stream", ORACLES["sessionise_stream"])
def q_sessionise_fragments_stream(spark, sf_dir):
    """Streaming sessions from bounded fragments (ST6): no session's whole history is one state row, as it is with
    ``session_window``."""
    root, keys = scratch_path(spark, "session-fragments"), ("session_id", "content_id")
    parts = session_fragments(dedupe_stream(_delivered(spark, sf_dir, root), "15 seconds"), "6 hours", keys, gap="3 hours")
    start_to_parquet(parts, f"{root}/out", f"{root}/ckpt").awaitTermination()
    return sessions_from_fragments(spark.read.parquet(f"{root}/out").where(F.col("session_id") != SENTINEL), "3 hours", keys)
