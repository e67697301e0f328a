"""Registered Silver-layer queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from crowdpulse.operators import joins, silver
from crowdpulse.plans.oracle import SPAN_SQL, WINDOW_SQL, with_ctes
from crowdpulse.plans.registry import SPAN, WINDOW, register
from crowdpulse.sources import testmap as tm


def silver_table(spark, sf_dir, **kw):
    """Silver on the mapping (hour windows, 2 h span, exact CCV)."""
    return silver.silver_qoe(tm.player_events(spark, sf_dir), tm.markers(spark, sf_dir), WINDOW, SPAN, **kw)


@register("silver_qoe", with_ctes("SELECT * FROM silver", "silver"))
def q_silver_qoe(spark, sf_dir):
    return silver_table(spark, sf_dir)


@register("ccv_approx")  # HLL++: rows-only check, relative error tested in tests/
def q_ccv_approx(spark, sf_dir):
    ev = silver.dedupe_events(tm.player_events(spark, sf_dir))
    return silver.ccv_approx(ev, WINDOW, dims=("cdn",))


@register("ccv_exact", with_ctes(f"""
SELECT time_bucket({WINDOW_SQL}, "timestamp") AS window_start, cdn,
       CAST(COUNT(DISTINCT session_id) AS BIGINT) AS ccv
FROM ev_dedup GROUP BY 1, 2""", "ev_dedup"))
def q_ccv_exact(spark, sf_dir):
    ev = silver.dedupe_events(tm.player_events(spark, sf_dir))
    return silver.ccv_exact(ev, WINDOW, dims=("cdn",))


@register("dedupe_events", with_ctes("""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT event_id) AS n_ids FROM ev_dedup""", "ev_dedup"))
def q_dedupe_events(spark, sf_dir):
    ev = silver.dedupe_events(tm.player_events(spark, sf_dir))
    return ev.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_ids"))


@register("ad_interval_join", with_ctes("""
SELECT marker_key AS marker_id, COUNT(*) AS n_events, COUNT(DISTINCT event_id) AS n_ids,
       MIN("timestamp") AS first_ts, MAX("timestamp") AS last_ts
FROM ev_marked GROUP BY 1""", "ev_marked"))
def q_ad_interval_join(spark, sf_dir):
    ev = joins.with_previous(silver.dedupe_events(tm.player_events(spark, sf_dir)))
    j = joins.ad_interval_join(ev, joins.marker_places(tm.markers(spark, sf_dir)), SPAN)
    return joins.count_per_marker(joins.label_ad_marker(j))


@register("ad_break_join", with_ctes("""
SELECT COALESCE(m.marker_id, 'conteudo_regular') AS marker_id, COUNT(*) AS n_events,
       MAX(e."timestamp") AS last_ts
FROM ev_dedup e LEFT JOIN markers m
  ON e.content_id = m.channel AND m.break_type = 'commercial'
 AND e."timestamp" >= m.wallclock AND e."timestamp" < m.wallclock + m.duration_s * INTERVAL 1 SECOND
GROUP BY 1""", "ev_dedup", "markers"))
def q_ad_break_join(spark, sf_dir):
    ev = silver.dedupe_events(tm.player_events(spark, sf_dir))
    j = joins.label_ad_marker(joins.ad_break_join(ev, tm.markers(spark, sf_dir), bucket="15 minutes"))
    return j.groupBy("marker_id").agg(F.count(F.lit(1)).alias("n_events"), F.max("timestamp").alias("last_ts"))


@register("asof_marker_join", with_ctes(f"""
SELECT marker_id, COUNT(*) AS n_events, COUNT(DISTINCT event_id) AS n_ids FROM (
  SELECT e.event_id, COALESCE(arg_max(m.marker_id, (m.wallclock, m.marker_id)), 'conteudo_regular') AS marker_id
  FROM (SELECT *, row_number() OVER () AS rid FROM ev_dedup) e LEFT JOIN markers m
    ON e.content_id = m.channel AND e."timestamp" >= m.wallclock AND e."timestamp" <= m.wallclock + {SPAN_SQL}
  GROUP BY e.rid, e.event_id) t
GROUP BY marker_id""", "ev_dedup", "markers"))
def q_asof_marker_join(spark, sf_dir):
    ev = silver.dedupe_events(tm.player_events(spark, sf_dir))
    j = joins.label_ad_marker(joins.asof_marker_join(ev, tm.markers(spark, sf_dir), SPAN))
    return j.groupBy("marker_id").agg(F.count(F.lit(1)).alias("n_events"),
                                      F.count_distinct("event_id").alias("n_ids"))


@register("silver_qoe_asof", with_ctes(f"""
SELECT time_bucket({WINDOW_SQL}, "timestamp") AS window_start,
       time_bucket({WINDOW_SQL}, "timestamp") + {WINDOW_SQL} AS window_end,
       region, device, cdn, marker_id,
       CAST(COUNT(DISTINCT session_id) AS BIGINT) AS ccv,
       CAST(ROUND(CAST(AVG(bitrate_kbps) AS DECIMAL(38,10)), 4) AS DOUBLE) AS avg_bitrate_kbps,
       CAST(ROUND(CAST(AVG(buffer_length_ms) AS DECIMAL(38,10)), 4) AS DOUBLE) AS avg_buffer_length_ms,
       CAST(SUM(CASE WHEN error_code IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS error_rate,
       CAST(SUM(CASE WHEN event_type = 'buffer_start' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS rebuffering_ratio,
       CAST(COUNT(*) AS BIGINT) AS event_count,
       CAST(SUM(CASE WHEN error_code IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS error_count
FROM (
  SELECT e.*, COALESCE(m.marker_id, 'conteudo_regular') AS marker_id
  FROM ev_dedup e LEFT JOIN markers m
    ON e.content_id = m.channel AND e."timestamp" >= m.wallclock AND e."timestamp" <= m.wallclock + {SPAN_SQL}
  QUALIFY rank() OVER (PARTITION BY e.event_id, e."timestamp"
                       ORDER BY m.wallclock DESC NULLS LAST, m.marker_id DESC NULLS LAST) = 1) t
GROUP BY 1, 2, 3, 4, 5, 6""", "ev_dedup", "markers"))
def q_silver_qoe_asof(spark, sf_dir):
    return silver_table(spark, sf_dir, asof=True)


@register("rebuffer_rolling5", with_ctes("""
SELECT ws AS window_start, ws + INTERVAL 5 HOUR AS window_end, cdn,
       CAST(COUNT(*) AS BIGINT) AS event_count,
       CAST(SUM(CASE WHEN event_type = 'buffer_start' THEN 1 ELSE 0 END) AS BIGINT) AS rebuffer_count,
       CAST(SUM(CASE WHEN event_type = 'buffer_start' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS rebuffer_ratio
FROM (SELECT e.*, time_bucket(INTERVAL 1 HOUR, "timestamp") - s.i * INTERVAL 1 HOUR AS ws
      FROM ev_dedup e CROSS JOIN (SELECT unnest(range(5)) AS i) s) t
GROUP BY 1, 2, 3""", "ev_dedup"))
def q_rebuffer_rolling5(spark, sf_dir):
    ev = silver.dedupe_events(tm.player_events(spark, sf_dir))
    return silver.rebuffer_rolling5(ev, "5 hours", "1 hour")


@register("ccv_sketch_rollup")  # HLL sketch union: rows-only check
def q_ccv_sketch_rollup(spark, sf_dir):
    ev = silver.dedupe_events(tm.player_events(spark, sf_dir))
    return silver.rollup_sketches(silver.ccv_sketches(ev, WINDOW))
