"""Registered session, analytic-window and SLO queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from crowdpulse.operators import sessions as SE
from crowdpulse.operators import slo as SL
from crowdpulse.operators.gold import dedupe_decisions
from crowdpulse.operators.serving import cdn_error_weighted
from crowdpulse.plans.gold_queries import gold_table, rd
from crowdpulse.plans.oracle import SPAN_SQL, WINDOW_SQL, with_ctes
from crowdpulse.plans.registry import SPAN, WINDOW, register
from crowdpulse.plans.silver_queries import silver_table
from crowdpulse.plans.source_queries import parsed_events
from crowdpulse.sources import parse as P
from crowdpulse.sources import testmap as tm
from crowdpulse.operators.silver import dedupe_events

GAP = "3 hours"           # session gap on the sparse test feed
PUBLISH_TS = "2024-01-31 00:30:00"
BROADCAST_START = "2024-01-01 00:00:00"
DEGRADED = (1440, 2880)   # minutes [lo, hi): the second day of the feed
BUDGET = 1.0 - 0.95


def _events(spark, sf_dir):
    return dedupe_events(tm.player_events(spark, sf_dir))


_SESSIONS_SQL = """
SELECT session_id, content_id, MIN("timestamp") AS session_start, MAX("timestamp") + INTERVAL 3 HOUR AS session_end,
       COUNT(*) AS events, bool_or(event_type IN ('video_end', 'error')) AS closed
FROM (SELECT *, SUM(brk) OVER (PARTITION BY session_id, content_id ORDER BY "timestamp"
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn
      FROM (SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY session_id, content_id
                                                                    ORDER BY "timestamp") < INTERVAL 3 HOUR
                           THEN 0 ELSE 1 END AS brk
            FROM ev_dedup) a) b
GROUP BY session_id, content_id, sn"""


@register("sessionise", with_ctes(_SESSIONS_SQL, "ev_dedup"))
def q_sessionise(spark, sf_dir):
    return SE.sessionise(_events(spark, sf_dir), GAP, keys=("session_id", "content_id"))


@register("ccv_sweep", with_ctes(f"""
WITH s AS ({_SESSIONS_SQL}),
d AS (SELECT content_id, session_start AS t, 1 AS delta FROM s
      UNION ALL SELECT content_id, session_end AS t, -1 AS delta FROM s)
SELECT content_id, CAST(MAX(c) AS BIGINT) AS peak_concurrent FROM (
  SELECT content_id, SUM(delta) OVER (PARTITION BY content_id ORDER BY t, delta
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM d) x
GROUP BY 1""", "ev_dedup"))
def q_ccv_sweep(spark, sf_dir):
    s = SE.sessionise(_events(spark, sf_dir), GAP, keys=("session_id", "content_id"))
    return SE.peak_concurrency(s, "content_id").withColumn("peak_concurrent", F.col("peak_concurrent").cast("long"))


@register("ccv_sweep_points", with_ctes(f"""
WITH s AS ({_SESSIONS_SQL}),
d AS (SELECT content_id, session_start AS t, 1 AS delta FROM s
      UNION ALL SELECT content_id, session_end AS t, -1 AS delta FROM s)
SELECT content_id, COUNT(*) AS points, CAST(MAX(c) AS BIGINT) AS peak, CAST(SUM(c) AS BIGINT) AS total FROM (
  SELECT content_id, SUM(delta) OVER (PARTITION BY content_id ORDER BY t, delta
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM d) x
GROUP BY 1""", "ev_dedup"))
def q_ccv_sweep_points(spark, sf_dir):
    """Every change point of the sweep (W7), summed up per channel."""
    s = SE.sessionise(_events(spark, sf_dir), GAP, keys=("session_id", "content_id"))
    return SE.ccv_sweep(s).groupBy("content_id").agg(
        F.count(F.lit(1)).alias("points"), F.max("concurrent").cast("long").alias("peak"), F.sum("concurrent").cast("long").alias("total"))


@register("session_summary", with_ctes("""
SELECT session_id, MIN("timestamp") AS start_ts, MAX("timestamp") AS end_ts, COUNT(*) AS events,
       bool_or(event_type IN ('video_end', 'error')) AS closed,
       (epoch_us(MAX("timestamp")) - epoch_us(MIN("timestamp"))) / 1000000.0 AS duration_s
FROM ev_dedup GROUP BY 1""", "ev_dedup"))
def q_session_summary(spark, sf_dir):
    return SE.session_summary(_events(spark, sf_dir))


@register("video_startup_time", with_ctes("""
WITH s AS (SELECT session_id, MIN("timestamp") AS start_ts FROM ev_dedup WHERE event_type = 'video_start' GROUP BY 1)
SELECT s.session_id, s.start_ts, MIN(e."timestamp") AS first_ts,
       (epoch_us(MIN(e."timestamp")) - epoch_us(s.start_ts)) / 1000.0 AS startup_ms
FROM s JOIN ev_dedup e ON e.session_id = s.session_id AND e."timestamp" >= s.start_ts
     AND e.event_type <> 'video_start'
GROUP BY 1, 2""", "ev_dedup"))
def q_video_startup_time(spark, sf_dir):
    return SE.video_startup_time(_events(spark, sf_dir))


@register("exit_before_start", with_ctes("""
SELECT CAST(SUM(CASE WHEN s THEN 1 ELSE 0 END) AS BIGINT) AS sessions_started,
       CAST(SUM(CASE WHEN s AND NOT h THEN 1 ELSE 0 END) AS BIGINT) AS exits_before_start,
       CAST(SUM(CASE WHEN s AND NOT h THEN 1 ELSE 0 END) AS DOUBLE) / SUM(CASE WHEN s THEN 1 ELSE 0 END) AS exit_share
FROM (SELECT session_id, bool_or(event_type = 'video_start') AS s, bool_or(event_type = 'heartbeat') AS h
      FROM ev_dedup GROUP BY 1) t""", "ev_dedup"))
def q_exit_before_start(spark, sf_dir):
    return SE.exit_before_start(_events(spark, sf_dir))


_NEXT_SQL = """
SELECT session_id, "timestamp", event_type, bitrate_kbps,
       lead("timestamp") OVER w AS next_ts, lead(event_type) OVER w AS next_type
FROM ev_dedup WINDOW w AS (PARTITION BY session_id ORDER BY "timestamp", event_type)"""


@register("stall_intervals", with_ctes(f"""
SELECT session_id, COUNT(*) AS stalls, SUM((epoch_us(next_ts) - epoch_us("timestamp")) / 1000.0) AS stall_ms,
       MIN("timestamp") AS first_stall
FROM ({_NEXT_SQL}) n WHERE event_type = 'buffer_start' AND next_type = 'buffer_end' GROUP BY 1""", "ev_dedup"))
def q_stall_intervals(spark, sf_dir):
    st = SE.stall_intervals(_events(spark, sf_dir))
    return st.groupBy("session_id").agg(F.count(F.lit(1)).alias("stalls"), F.sum("stall_ms").alias("stall_ms"),
                                        F.min("stall_start").alias("first_stall"))


@register("rebuffer_ratio", with_ctes(f"""
WITH st AS (SELECT session_id, SUM((epoch_us(next_ts) - epoch_us("timestamp")) / 1000.0) AS stall_ms
            FROM ({_NEXT_SQL}) n WHERE event_type = 'buffer_start' AND next_type = 'buffer_end' GROUP BY 1),
w AS (SELECT session_id, (epoch_us(MAX("timestamp")) - epoch_us(MIN("timestamp"))) / 1000000.0 * 1000 AS watch_ms
      FROM ev_dedup GROUP BY 1)
SELECT w.session_id, w.watch_ms, COALESCE(st.stall_ms, 0.0) AS stall_ms,
       {rd('CASE WHEN w.watch_ms > 0 THEN COALESCE(st.stall_ms, 0.0) / w.watch_ms END', 8)} AS rebuffer_ratio
FROM w LEFT JOIN st ON st.session_id = w.session_id""", "ev_dedup"))
def q_rebuffer_ratio(spark, sf_dir):
    r = SE.rebuffer_ratio(_events(spark, sf_dir))
    return r.withColumn("rebuffer_ratio", F.round(F.col("rebuffer_ratio").cast("decimal(38,10)"), 8).cast("double"))


@register("weighted_bitrate", with_ctes(f"""
SELECT session_id, SUM(held_ms) AS held_ms, {rd('SUM(bitrate_kbps * held_ms) / SUM(held_ms)', 4)}
       AS weighted_bitrate_kbps
FROM (SELECT session_id, bitrate_kbps, (epoch_us(next_ts) - epoch_us("timestamp")) / 1000.0 AS held_ms
      FROM (SELECT session_id, "timestamp", bitrate_kbps,
                   lead("timestamp") OVER (PARTITION BY session_id ORDER BY "timestamp") AS next_ts
            FROM ev_dedup) a
      WHERE next_ts IS NOT NULL AND bitrate_kbps IS NOT NULL) t GROUP BY 1""", "ev_dedup"))
def q_weighted_bitrate(spark, sf_dir):
    w = SE.weighted_bitrate(_events(spark, sf_dir))
    return w.withColumn("weighted_bitrate_kbps",
                        F.round(F.col("weighted_bitrate_kbps").cast("decimal(38,10)"), 4).cast("double"))


@register("global_dedupe", with_ctes("""
SELECT event_id, "timestamp", event_type, cdn FROM player_events
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY "timestamp") = 1""", "player_events"))
def q_global_dedupe(spark, sf_dir):
    return SE.global_dedupe(tm.player_events(spark, sf_dir)).select("event_id", "timestamp", "event_type", "cdn")


@register("lateness_profile", with_ctes("""
WITH feed AS (
  SELECT user_id, k, CAST(event_id AS BIGINT) * 4 AS "offset", date_trunc('millisecond', "timestamp") AS ts
  FROM pe_base WHERE k <> 13
  UNION ALL SELECT user_id, k, CAST(event_id AS BIGINT) * 4 + 1, date_trunc('millisecond', "timestamp")
  FROM pe_base WHERE k >= 95
  UNION ALL SELECT user_id, k, CAST(event_id AS BIGINT) * 4 + 2, date_trunc('millisecond', "timestamp" + INTERVAL 3 SECOND)
  FROM pe_base WHERE k >= 90 AND k < 95),
l AS (SELECT CAST(user_id AS BIGINT) % 8 AS "partition", ts,
             MAX(ts) OVER (PARTITION BY CAST(user_id AS BIGINT) % 8 ORDER BY "offset"
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max FROM feed)
SELECT "partition", COUNT(*) AS records,
       CAST(SUM(CASE WHEN prev_max > ts THEN 1 ELSE 0 END) AS BIGINT) AS late_records,
       MAX(COALESCE(GREATEST(0.0, (epoch_us(prev_max) - epoch_us(ts)) / 1000000.0), 0.0)) AS max_lateness_s
FROM l GROUP BY 1""", "pe_base"))
def q_lateness_profile(spark, sf_dir):
    raw = tm.raw_player_events(spark, sf_dir)
    event_ts = F.try_to_timestamp(F.get_json_object(F.col("value").cast("string"), "$.timestamp"))
    # one-row generator: the payload expression stays below it during planning
    parsed = raw.select("partition", "offset", F.inline(F.array(F.struct(event_ts.alias("event_ts"))))) \
        .where(F.col("event_ts").isNotNull())
    lp = SE.lateness_profile(parsed, "event_ts", "offset", "partition", rows_per_bucket=4000)
    return lp.groupBy("partition").agg(F.count(F.lit(1)).alias("records"),
                                       F.sum((F.col("lateness_s") > 0).cast("long")).alias("late_records"),
                                       F.max("lateness_s").alias("max_lateness_s"))


@register("slo_freshness", with_ctes("""
SELECT COUNT(*) AS rows, CAST(SUM(CASE WHEN lag <= 120 THEN 1 ELSE 0 END) AS BIGINT) AS within,
       MAX(lag) AS max_lag_s, CAST(SUM(CASE WHEN lag <= 120 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS share,
       'freshness' AS slo, CAST(SUM(CASE WHEN lag <= 120 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) >= 0.999 AS met
FROM (SELECT (epoch_us("timestamp" + (k % 5) * INTERVAL 1 SECOND)
              - epoch_us(date_trunc('millisecond', "timestamp"))) / 1000000.0 AS lag
      FROM pe_feed WHERE k NOT IN (13, 17)) t""", "pe_feed"))
def q_slo_freshness(spark, sf_dir):
    return SL.slo_freshness(parsed_events(spark, sf_dir), "timestamp", "ingest_ts", 120)


@register("slo_uniqueness", with_ctes("""
SELECT COUNT(DISTINCT a.event_id) AS duplicated_ids, 'uniqueness' AS slo, COUNT(DISTINCT a.event_id) = 0 AS met
FROM (SELECT event_id, "timestamp" AS t, row_number() OVER () AS r FROM player_events) a
JOIN (SELECT event_id, "timestamp" AS t, row_number() OVER () AS r FROM player_events) b
  ON a.event_id = b.event_id AND a.r <> b.r AND b.t BETWEEN a.t AND a.t + INTERVAL 15 SECOND""", "player_events"))
def q_slo_uniqueness(spark, sf_dir):
    return SL.slo_uniqueness(tm.player_events(spark, sf_dir), 15)


@register("slo_match_rate", with_ctes(f"""
SELECT COUNT(*) AS ad_events, COUNT(*) FILTER (WHERE hit) AS matched,
       CAST(COUNT(*) FILTER (WHERE hit) AS DOUBLE) / COUNT(*) AS match_rate,
       CAST(COUNT(*) FILTER (WHERE hit) AS DOUBLE) / COUNT(*) >= 0.98 AS met
FROM (SELECT EXISTS (SELECT 1 FROM markers m WHERE m.channel = e.content_id AND e."timestamp" >= m.wallclock
                     AND e."timestamp" <= m.wallclock + {SPAN_SQL}) AS hit
      FROM ev_dedup e WHERE e.event_type IN ('ad_start', 'ad_end')) t""", "ev_dedup", "markers"))
def q_slo_match_rate(spark, sf_dir):
    return SL.slo_match_rate(dedupe_events(tm.player_events(spark, sf_dir)), tm.markers(spark, sf_dir), SPAN)


@register("decision_match_rate", with_ctes("""
SELECT COUNT(*) AS decisions, COUNT(m.mid) AS matched, CAST(COUNT(m.mid) AS DOUBLE) / COUNT(*) AS match_rate,
       CAST(COUNT(m.mid) AS DOUBLE) / COUNT(*) >= 0.98 AS met
FROM ads_dedup a LEFT JOIN (SELECT DISTINCT trim(marker_id) AS mid FROM markers) m ON trim(a.marker_id) = m.mid""",
                                           "ads_dedup", "markers"))
def q_decision_match_rate(spark, sf_dir):
    return SL.decision_match_rate(dedupe_decisions(tm.ad_decisions(spark, sf_dir)), tm.markers(spark, sf_dir))


@register("slo_revenue", with_ctes("""
SELECT MIN(r) AS min_ad_revenue, COUNT(*) AS ads, COALESCE(MIN(r) >= 0, TRUE) AS met
FROM (SELECT MAX(total_revenue_brl) AS r FROM gold WHERE advertiser_name IS NOT NULL
      GROUP BY advertiser_name, content_title, marker_id) t""", "gold"))
def q_slo_revenue(spark, sf_dir):
    return SL.slo_revenue(gold_table(spark, sf_dir))


@register("slo_gold_timeliness", with_ctes(f"""
SELECT MAX(window_start) + {WINDOW_SQL} AS newest_window_end,
       (epoch_us(TIMESTAMP '{PUBLISH_TS}') - epoch_us(MAX(window_start) + {WINDOW_SQL})) / 60000000.0 AS lag_min,
       (epoch_us(TIMESTAMP '{PUBLISH_TS}') - epoch_us(MAX(window_start) + {WINDOW_SQL})) / 60000000.0 <= 30 AS met
FROM gold""", "gold"))
def q_slo_gold_timeliness(spark, sf_dir):
    return SL.slo_gold_timeliness(gold_table(spark, sf_dir), PUBLISH_TS, WINDOW, 30)


@register("cdn_alert", with_ctes("SELECT * FROM cdn_series WHERE error_rate > 0.05", "cdn_series"))
def q_cdn_alert(spark, sf_dir):
    return SL.cdn_alert(silver_table(spark, sf_dir), 0.05)


@register("burn_rate", with_ctes(f"""
SELECT window_start, cdn, errors, events,
       {rd(f"CAST(SUM(errors) OVER wf AS DOUBLE) / SUM(events) OVER wf / CAST({BUDGET!r} AS DOUBLE)", 6)} AS burn_fast,
       {rd(f"CAST(SUM(errors) OVER ws AS DOUBLE) / SUM(events) OVER ws / CAST({BUDGET!r} AS DOUBLE)", 6)} AS burn_slow
FROM (SELECT window_start, cdn, CAST(SUM(error_count) AS BIGINT) AS errors, CAST(SUM(event_count) AS BIGINT) AS events
      FROM silver GROUP BY 1, 2) t
WINDOW wf AS (PARTITION BY cdn ORDER BY window_start RANGE BETWEEN INTERVAL 5 HOUR PRECEDING AND CURRENT ROW),
       ws AS (PARTITION BY cdn ORDER BY window_start RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW)""",
                                 "silver"))
def q_burn_rate(spark, sf_dir):
    return SL.burn_rate(silver_table(spark, sf_dir), 0.95, "6 hours", "24 hours", WINDOW)


@register("degradation_uplift", with_ctes(f"""
SELECT cdn, {rd('AVG(CASE WHEN iw THEN error_rate END)', 4)} AS error_rate_in,
       {rd('AVG(CASE WHEN NOT iw THEN error_rate END)', 4)} AS error_rate_out,
       {rd('AVG(CASE WHEN iw THEN avg_buffer_length_ms END)', 2)} AS buffer_ms_in,
       {rd('AVG(CASE WHEN NOT iw THEN avg_buffer_length_ms END)', 2)} AS buffer_ms_out,
       {rd('AVG(CASE WHEN iw THEN error_rate END) / NULLIF(AVG(CASE WHEN NOT iw THEN error_rate END), 0)', 4)}
         AS error_uplift,
       {rd('AVG(CASE WHEN iw THEN avg_buffer_length_ms END) / NULLIF(AVG(CASE WHEN NOT iw THEN avg_buffer_length_ms END), 0)', 4)}
         AS buffer_uplift
FROM (SELECT *, (epoch_us(window_start) - epoch_us(TIMESTAMP '{BROADCAST_START}')) / 60000000.0 >= {DEGRADED[0]}
                AND (epoch_us(window_start) - epoch_us(TIMESTAMP '{BROADCAST_START}')) / 60000000.0 < {DEGRADED[1]} AS iw
      FROM silver) t GROUP BY 1""", "silver"))
def q_degradation_uplift(spark, sf_dir):
    return SL.degradation_uplift(silver_table(spark, sf_dir), BROADCAST_START, *DEGRADED)


@register("zscore_anomaly", with_ctes(f"""
SELECT window_start, cdn, errors, events, error_rate,
       {rd('CASE WHEN sd > 0 THEN (error_rate - mu) / sd END', 4)} AS zscore,
       COALESCE(abs({rd('CASE WHEN sd > 0 THEN (error_rate - mu) / sd END', 4)}) > 3.0, FALSE) AS anomaly
FROM (SELECT *, AVG(error_rate) OVER w AS mu, STDDEV_SAMP(error_rate) OVER w AS sd
      FROM (SELECT window_start, cdn, CAST(SUM(error_count) AS BIGINT) AS errors,
                   CAST(SUM(event_count) AS BIGINT) AS events,
                   CAST(SUM(error_count) AS DOUBLE) / SUM(event_count) AS error_rate
            FROM silver GROUP BY 1, 2) s
      WINDOW w AS (PARTITION BY cdn ORDER BY window_start ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)) t""",
                                      "silver"))
def q_zscore_anomaly(spark, sf_dir):
    return SL.zscore_anomaly(cdn_error_weighted(silver_table(spark, sf_dir)), "error_rate", 10)


@register("clock_skew", with_ctes("""
SELECT session_id, MIN(CASE WHEN rn = CAST(ceil(n / 2.0) AS BIGINT) THEN lag_ms END) AS offset_ms,
       MAX(n) AS events
FROM (SELECT session_id, lag_ms, row_number() OVER (PARTITION BY session_id ORDER BY lag_ms) AS rn,
             COUNT(*) OVER (PARTITION BY session_id) AS n
      FROM (SELECT session_id, (epoch_us("timestamp" + (k % 5) * INTERVAL 1 SECOND)
                                - epoch_us(date_trunc('millisecond', "timestamp"))) / 1000.0 AS lag_ms
            FROM pe_feed WHERE k NOT IN (13, 17)) a) t
GROUP BY 1""", "pe_feed"))
def q_clock_skew(spark, sf_dir):
    """Median arrival offset per session from Kafka ingest time (§7.6)."""
    return SE.clock_skew(parsed_events(spark, sf_dir))
