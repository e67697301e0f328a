"""Registered Gold and serving queries (SURVEY §2.4 J5-J10, §2.5 A7-A23,
§2.6 W4/W6, §2.8) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from crowdpulse.operators import gold as G
from crowdpulse.operators import serving as V
from crowdpulse.operators import silver as S
from crowdpulse.plans.oracle import CTES, SPAN_SQL, WINDOW_SQL, with_ctes
from crowdpulse.plans.registry import ORACLES, SPAN, WINDOW, register
from crowdpulse.plans.silver_queries import silver_table
from crowdpulse.session import freed_shuffles, scratch_path
from crowdpulse.sources import testmap as tm


def rd(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


CTES.update({
    "ads_dedup": (("ad_decisions",), """
SELECT * FROM ad_decisions QUALIFY row_number() OVER (PARTITION BY decision_id ORDER BY served_ts) = 1"""),
    "ads_agg": (("ads_dedup",), """
SELECT trim(marker_id) AS marker_id, trim(channel) AS channel,
       arg_min(advertiser_name, (slot_index, decision_id)) AS advertiser_name,
       SUM(price_cpm_brl / 1000) AS revenue_brl, COUNT(*) AS impressions
FROM ads_dedup GROUP BY 1, 2"""),
    "ads_enriched": (("ads_agg", "content_metadata"), """
SELECT a.marker_id, a.advertiser_name, a.revenue_brl, c.title AS content_title, c.genre
FROM ads_agg a LEFT JOIN content_metadata c ON trim(a.channel) = trim(c.content_id)"""),
    "gold": (("silver", "ads_enriched"), f"""
SELECT s.window_start, s.marker_id, ae.content_title, ae.genre, ae.advertiser_name, s.region, s.device, s.cdn,
       s.ccv, {rd('ae.revenue_brl', 2)} AS total_revenue_brl, {rd('s.avg_bitrate_kbps', 2)} AS avg_bitrate_kbps,
       {rd('s.error_rate', 4)} AS error_rate
FROM silver s LEFT JOIN ads_enriched ae ON trim(s.marker_id) = ae.marker_id
WHERE s.marker_id <> 'conteudo_regular'"""),
    "sponsor_rev": (("gold",), f"""
SELECT advertiser_name AS sponsor, content_title AS program, {rd('SUM(ad_revenue)', 2)} AS total_revenue_brl,
       CAST(SUM(ad_ccv) AS BIGINT) AS impacted_viewers
FROM (SELECT advertiser_name, content_title, marker_id, MAX(total_revenue_brl) AS ad_revenue, CAST(SUM(ccv) AS BIGINT) AS ad_ccv
      FROM gold WHERE advertiser_name IS NOT NULL GROUP BY 1, 2, 3) t
GROUP BY 1, 2"""),
    "cdn_series": (("silver",), f"""
SELECT window_start, cdn, {rd('AVG(error_rate)', 4)} AS error_rate FROM silver GROUP BY 1, 2"""),
})


def gold_table(spark, sf_dir, filtered: bool = False):
    """``filtered``: decisions for markers that never came are dropped before they are shuffled; the same rows, for less disk and,
    on small tables, more time."""
    return G.gold_reconciliation(silver_table(spark, sf_dir), tm.ad_decisions(spark, sf_dir),
                                 tm.content(spark, sf_dir), cues=tm.markers(spark, sf_dir) if filtered else None)


def _events(spark, sf_dir):
    return S.dedupe_events(tm.player_events(spark, sf_dir))


@register("gold_reconciliation", with_ctes("SELECT * FROM gold", "gold"))
def q_gold(spark, sf_dir):
    return gold_table(spark, sf_dir)


@register("ad_revenue_by_marker", with_ctes(f"""
SELECT marker_id, channel, advertiser_name, {rd('revenue_brl', 2)} AS revenue_brl, impressions FROM ads_agg""",
                                            "ads_agg"))
def q_ad_revenue_by_marker(spark, sf_dir):
    return G.ad_revenue_by_marker(tm.ad_decisions(spark, sf_dir)).withColumn(
        "revenue_brl", F.round(F.col("revenue_brl").cast("decimal(38,10)"), 2).cast("double"))


@register("ad_revenue_by_advertiser", with_ctes(f"""
SELECT advertiser_id, advertiser_name, {rd('SUM(price_cpm_brl / 1000)', 2)} AS revenue_brl,
       COUNT(*) AS impressions, COUNT(DISTINCT marker_id) AS markers
FROM ads_dedup GROUP BY 1, 2""", "ads_dedup"))
def q_ad_revenue_by_advertiser(spark, sf_dir):
    return G.ad_revenue_by_advertiser(tm.ad_decisions(spark, sf_dir))


@register("ads_content_join", with_ctes(f"""
SELECT marker_id, advertiser_name, {rd('revenue_brl', 2)} AS revenue_brl, content_title, genre
FROM ads_enriched""", "ads_enriched"))
def q_ads_content_join(spark, sf_dir):
    out = G.ads_content_join(G.ad_revenue_by_marker(tm.ad_decisions(spark, sf_dir)), tm.content(spark, sf_dir))
    return out.withColumn("revenue_brl", F.round(F.col("revenue_brl").cast("decimal(38,10)"), 2).cast("double"))


@register("ad_break_rows", with_ctes("""
SELECT window_start, marker_id, region, device, cdn, ccv, event_count FROM silver
WHERE marker_id <> 'conteudo_regular'""", "silver"))
def q_ad_break_rows(spark, sf_dir):
    return G.ad_break_rows(silver_table(spark, sf_dir)).select(
        "window_start", "marker_id", "region", "device", "cdn", "ccv", "event_count")


@register("sponsor_revenue", with_ctes("SELECT * FROM sponsor_rev", "sponsor_rev"))
def q_sponsor_revenue(spark, sf_dir):
    return V.sponsor_revenue(gold_table(spark, sf_dir))


@register("sponsor_rollup", with_ctes(f"""
SELECT COALESCE(sponsor, 'Sem patrocinador') AS sponsor, {rd('SUM(total_revenue_brl)', 2)} AS total_revenue_brl,
       COUNT(DISTINCT COALESCE(program, 'Sem programa')) AS programs
FROM sponsor_rev GROUP BY 1""", "sponsor_rev"))
def q_sponsor_rollup(spark, sf_dir):
    return V.sponsor_rollup(V.sponsor_revenue(gold_table(spark, sf_dir)))


@register("total_revenue", with_ctes(f"""
SELECT {rd('COALESCE(SUM(total_revenue_brl), 0)', 2)} AS total_revenue_brl FROM sponsor_rev""", "sponsor_rev"))
def q_total_revenue(spark, sf_dir):
    return V.total_revenue(V.sponsor_revenue(gold_table(spark, sf_dir)))


@register("ad_delivery", with_ctes(f"""
SELECT advertiser_name AS sponsor, region, device, CAST(SUM(ccv) AS BIGINT) AS views, {rd('AVG(error_rate)', 4)} AS ad_failure_rate
FROM gold WHERE advertiser_name IS NOT NULL GROUP BY 1, 2, 3""", "gold"))
def q_ad_delivery(spark, sf_dir):
    return V.ad_delivery(gold_table(spark, sf_dir))


@register("cdn_degradation_top", with_ctes(f"""
SELECT window_start, cdn, {rd('AVG(error_rate)', 4)} AS mean_error_rate,
       {rd('AVG(avg_buffer_length_ms)', 2)} AS mean_buffer_ms, CAST(SUM(ccv) AS BIGINT) AS affected_viewers
FROM silver GROUP BY 1, 2 ORDER BY mean_error_rate DESC, window_start, cdn LIMIT 15""", "silver"))
def q_cdn_degradation_top(spark, sf_dir):
    return V.cdn_degradation_top(silver_table(spark, sf_dir), 15)


@register("peak_ccv_top5", with_ctes("""
SELECT window_start, CAST(SUM(ccv) AS BIGINT) AS peak_ccv FROM silver GROUP BY 1 ORDER BY peak_ccv DESC, window_start LIMIT 5""",
                                     "silver"))
def q_peak_ccv_top5(spark, sf_dir):
    return V.peak_ccv_top5(silver_table(spark, sf_dir))


@register("peak_ccv", with_ctes("""
SELECT window_start, CAST(SUM(ccv) AS BIGINT) AS peak_ccv FROM silver GROUP BY 1 ORDER BY peak_ccv DESC, window_start LIMIT 1""",
                                "silver"))
def q_peak_ccv(spark, sf_dir):
    return V.peak_ccv(silver_table(spark, sf_dir), 1)


@register("peak_ccv_exact", with_ctes(f"""
SELECT time_bucket({WINDOW_SQL}, "timestamp") AS window_start, COUNT(DISTINCT session_id) AS peak_ccv
FROM ev_dedup GROUP BY 1 ORDER BY peak_ccv DESC, window_start LIMIT 5""", "ev_dedup"))
def q_peak_ccv_exact(spark, sf_dir):
    return V.peak_ccv_exact(_events(spark, sf_dir), WINDOW, 5)


@register("cdn_error_series", with_ctes("SELECT * FROM cdn_series", "cdn_series"))
def q_cdn_error_series(spark, sf_dir):
    return V.cdn_error_series(silver_table(spark, sf_dir))


@register("cdn_error_weighted", with_ctes("""
SELECT window_start, cdn, CAST(SUM(error_count) AS BIGINT) AS errors, CAST(SUM(event_count) AS BIGINT) AS events,
       CAST(SUM(error_count) AS DOUBLE) / SUM(event_count) AS error_rate
FROM silver GROUP BY 1, 2""", "silver"))
def q_cdn_error_weighted(spark, sf_dir):
    return V.cdn_error_weighted(silver_table(spark, sf_dir))


@register("cdn_peak_error", with_ctes("""
SELECT COALESCE(MAX(CASE WHEN lower(cdn) = 'cdn-b' THEN error_rate END), 0.0) AS peak_error_rate
FROM cdn_series""", "cdn_series"))
def q_cdn_peak_error(spark, sf_dir):
    return V.cdn_peak_error(silver_table(spark, sf_dir), "cdn-b")


@register("ccv_by_region", with_ctes(f"""
SELECT time_bucket({WINDOW_SQL}, "timestamp") AS window_start, region, COUNT(DISTINCT session_id) AS ccv
FROM ev_dedup GROUP BY 1, 2""", "ev_dedup"))
def q_ccv_by_region(spark, sf_dir):
    return V.ccv_by_region(_events(spark, sf_dir), WINDOW)


@register("ccv_grouping_sets", with_ctes(f"""
SELECT window_start, region, device, cdn,
       CASE WHEN grouping(region) = 0 THEN 'region' WHEN grouping(device) = 0 THEN 'device'
            WHEN grouping(cdn) = 0 THEN 'cdn' ELSE 'total' END AS level,
       COUNT(DISTINCT session_id) AS ccv
FROM (SELECT time_bucket({WINDOW_SQL}, "timestamp") AS window_start, region, device, cdn, session_id FROM ev_dedup) t
GROUP BY GROUPING SETS ((window_start, region), (window_start, device), (window_start, cdn), (window_start))""",
                                        "ev_dedup"))
def q_ccv_grouping_sets(spark, sf_dir):
    return V.ccv_grouping_sets(_events(spark, sf_dir), WINDOW)


@register("ccv_grouping_sets_cells", ORACLES["ccv_grouping_sets"])
def q_ccv_grouping_sets_cells(spark, sf_dir):
    """The same figures from stored bitmap cells (A3, A21, A22): exact, with the cells alone."""
    root = scratch_path(spark, "ccv-cells")
    events = _events(spark, sf_dir)
    V.ccv_cells(events, V.session_dictionary(events, f"{root}/sessions"), WINDOW).write.parquet(f"{root}/cells")
    return V.ccv_grouping_sets_from_cells(spark.read.parquet(f"{root}/cells"))


@register("ccv_by_region_cells", ORACLES["ccv_by_region"])
def q_ccv_by_region_cells(spark, sf_dir):
    """Sessions per (window, region) rolled up from cells of finer grain."""
    root = scratch_path(spark, "ccv-cells")
    events = _events(spark, sf_dir)
    V.ccv_cells(events, V.session_dictionary(events, f"{root}/sessions"), WINDOW).write.parquet(f"{root}/cells")
    return V.roll_up_cells(spark.read.parquet(f"{root}/cells"), ["window_start", "region"])


@register("marker_impact", with_ctes(f"""
WITH pw AS (SELECT window_start, CAST(SUM(ccv) AS BIGINT) AS ccv_all FROM silver GROUP BY 1),
d AS (SELECT marker_id, MIN(window_start) AS first_window, MAX(window_start) AS last_window,
             CAST(SUM(ccv) AS BIGINT) AS ccv_during, CAST(SUM(error_count) AS BIGINT) AS errors_during, CAST(SUM(event_count) AS BIGINT) AS events_during
      FROM silver WHERE marker_id <> 'conteudo_regular' GROUP BY 1),
rev AS (SELECT marker_id, MAX(total_revenue_brl) AS revenue_brl FROM gold GROUP BY 1)
SELECT d.marker_id, d.first_window, d.last_window, COALESCE(b.ccv_all, 0) AS ccv_before, d.ccv_during,
       COALESCE(a.ccv_all, 0) AS ccv_after,
       CAST(d.errors_during AS DOUBLE) / d.events_during AS error_rate_during, rev.revenue_brl
FROM d LEFT JOIN pw b ON b.window_start = d.first_window - {WINDOW_SQL}
       LEFT JOIN pw a ON a.window_start = d.last_window + {WINDOW_SQL}
       LEFT JOIN rev ON rev.marker_id = d.marker_id""", "gold"))
def q_marker_impact(spark, sf_dir):
    """Reads stored Silver several times and the events once."""
    path = scratch_path(spark, "impact") + "/silver"
    silver_table(spark, sf_dir).write.parquet(path)
    s = spark.read.parquet(path)
    g = G.gold_reconciliation(s, tm.ad_decisions(spark, sf_dir), tm.content(spark, sf_dir))
    return V.marker_impact(s, g, WINDOW)


@register("cdn_rank_per_minute", with_ctes("""
SELECT window_start, cdn, error_rate,
       rank() OVER (PARTITION BY window_start ORDER BY error_rate DESC) AS error_rank,
       dense_rank() OVER (PARTITION BY window_start ORDER BY error_rate DESC) AS error_dense_rank
FROM cdn_series""", "cdn_series"))
def q_cdn_rank_per_minute(spark, sf_dir):
    return V.cdn_rank_per_minute(silver_table(spark, sf_dir))


@register("revenue_running", with_ctes(f"""
SELECT advertiser_name, window_start, {rd('revenue_brl', 2)} AS revenue_brl,
       {rd('SUM(revenue_brl) OVER (PARTITION BY advertiser_name ORDER BY window_start '
           'ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 2)} AS running_revenue_brl
FROM (SELECT advertiser_name, window_start, SUM(revenue_brl) AS revenue_brl
      FROM (SELECT advertiser_name, marker_id, MIN(window_start) AS window_start,
                   MAX(total_revenue_brl) AS revenue_brl
            FROM gold WHERE advertiser_name IS NOT NULL GROUP BY 1, 2) m GROUP BY 1, 2) t""", "gold"))
def q_revenue_running(spark, sf_dir):
    return V.revenue_running(gold_table(spark, sf_dir))


@register("ad_impressions_3way", with_ctes(f"""
WITH played AS (
  SELECT m.marker_id, COUNT(*) AS ad_starts, COUNT(DISTINCT e.session_id) AS viewers
  FROM ev_dedup e JOIN markers m
    ON e.content_id = m.channel AND e."timestamp" >= m.wallclock AND e."timestamp" <= m.wallclock + {SPAN_SQL}
  WHERE e.event_type = 'ad_start' GROUP BY 1)
SELECT p.marker_id, p.ad_starts, p.viewers, a.impressions, {rd('a.revenue_brl', 2)} AS revenue_brl
FROM played p JOIN ads_agg a ON a.marker_id = p.marker_id""", "ev_dedup", "markers", "ads_agg"))
def q_ad_impressions_3way(spark, sf_dir):
    return G.ad_impressions_3way(_events(spark, sf_dir), tm.markers(spark, sf_dir), tm.ad_decisions(spark, sf_dir),
                                 SPAN)


@register("scd2_content_join", with_ctes("""
WITH v AS (SELECT trim(content_id) AS cid, title, genre, updated_at AS valid_from,
                  lead(updated_at) OVER (PARTITION BY trim(content_id) ORDER BY updated_at) AS valid_to
           FROM content_versions)
SELECT v.title AS content_title, COUNT(*) AS n_events, COUNT(DISTINCT e.session_id) AS sessions
FROM ev_dedup e LEFT JOIN v ON e.content_id = v.cid AND e."timestamp" >= v.valid_from
     AND (v.valid_to IS NULL OR e."timestamp" < v.valid_to)
GROUP BY 1""", "ev_dedup", "content_versions"))
def q_scd2_content_join(spark, sf_dir):
    j = G.scd2_content_join(_events(spark, sf_dir), tm.content_versions(spark, sf_dir))
    return j.groupBy("content_title").agg(F.count(F.lit(1)).alias("n_events"),
                                          F.count_distinct("session_id").alias("sessions"))


@register("unmatched_ads", with_ctes("""
SELECT COUNT(*) AS unmatched_decisions, COUNT(DISTINCT marker_id) AS unmatched_markers
FROM ad_decisions a WHERE NOT EXISTS (SELECT 1 FROM markers m WHERE trim(m.marker_id) = trim(a.marker_id))""",
                                     "ad_decisions", "markers"))
def q_unmatched_ads(spark, sf_dir):
    u = G.unmatched_ads(tm.ad_decisions(spark, sf_dir), tm.markers(spark, sf_dir))
    return u.agg(F.count(F.lit(1)).alias("unmatched_decisions"),
                 F.count_distinct("marker_id").alias("unmatched_markers"))


@register("sessions_with_ads", with_ctes(f"""
SELECT DISTINCT e.session_id FROM ev_dedup e
WHERE EXISTS (SELECT 1 FROM markers m WHERE e.content_id = m.channel AND e."timestamp" >= m.wallclock
              AND e."timestamp" <= m.wallclock + {SPAN_SQL})""", "ev_dedup", "markers"))
def q_sessions_with_ads(spark, sf_dir):
    return G.sessions_with_ads(_events(spark, sf_dir), tm.markers(spark, sf_dir), SPAN)


@register("matched_markers", with_ctes("""
SELECT trim(marker_id) AS marker_id FROM ad_decisions INTERSECT SELECT trim(marker_id) FROM markers""",
                                       "ad_decisions", "markers"))
def q_matched_markers(spark, sf_dir):
    return G.matched_markers(tm.ad_decisions(spark, sf_dir), tm.markers(spark, sf_dir))


@register("rights_check", with_ctes("""
SELECT e.content_id, COUNT(*) AS n_events,
       CAST(SUM(CASE WHEN COALESCE(list_contains(c.rights_territories, e.region), FALSE) THEN 1 ELSE 0 END) AS BIGINT)
         AS in_territory,
       CAST(SUM(CASE WHEN COALESCE(e."timestamp" BETWEEN c.rights_window_start AND c.rights_window_end, FALSE)
                THEN 1 ELSE 0 END) AS BIGINT) AS in_window,
       CAST(SUM(CASE WHEN COALESCE(list_contains(c.rights_territories, e.region), FALSE)
                 AND COALESCE(e."timestamp" BETWEEN c.rights_window_start AND c.rights_window_end, FALSE)
                THEN 1 ELSE 0 END) AS BIGINT) AS rights_ok
FROM ev_dedup e LEFT JOIN content_metadata c ON e.content_id = trim(c.content_id)
GROUP BY 1""", "ev_dedup", "content_metadata"))
def q_rights_check(spark, sf_dir):
    r = G.rights_check(_events(spark, sf_dir), tm.content(spark, sf_dir))
    return r.groupBy("content_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(F.col("in_territory").cast("long")).alias("in_territory"),
        F.sum(F.col("in_window").cast("long")).alias("in_window"),
        F.sum(F.col("rights_ok").cast("long")).alias("rights_ok"))


@register("stream_batch_reconcile", with_ctes("""
SELECT COUNT(*) AS differing_rows FROM silver s FULL OUTER JOIN (
  SELECT * FROM silver WHERE NOT (cdn = 'cdn-a' AND region = 'ASIA')) b
  ON s.window_start = b.window_start AND s.region = b.region AND s.device = b.device AND s.cdn = b.cdn
 AND s.marker_id = b.marker_id
WHERE s.ccv IS NULL OR b.ccv IS NULL OR s.ccv <> b.ccv OR s.event_count <> b.event_count
   OR s.error_count <> b.error_count""", "silver"))
def q_stream_batch_reconcile(spark, sf_dir):
    """Reconcile Silver with a recompute that lost one (cdn, region) slice."""
    s = silver_table(spark, sf_dir)
    lossy = s.where(~((F.col("cdn") == "cdn-a") & (F.col("region") == "ASIA")))
    return G.stream_batch_reconcile(s, lossy).agg(F.count(F.lit(1)).alias("differing_rows"))


@register("idempotence_diff", with_ctes("""
SELECT (SELECT COUNT(*) FROM (SELECT * FROM gold EXCEPT ALL SELECT * FROM gold) a) AS only_a,
       (SELECT COUNT(*) FROM (SELECT * FROM gold EXCEPT ALL SELECT * FROM gold) b) AS only_b""", "gold"))
def q_idempotence_diff(spark, sf_dir):
    """Two written runs of Gold must not differ (U4): the second from input in another order, every event and ad decision
    delivered twice."""
    root = scratch_path(spark, "idempotence")
    with freed_shuffles(spark):
        gold_table(spark, sf_dir, filtered=True).write.parquet(f"{root}/first")
    twice = lambda df: df.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    events = twice(tm.player_events(spark, sf_dir).repartition(7, "session_id"))     # a row is sent once and doubled behind
    sold, cues = tm.ad_decisions(spark, sf_dir), tm.markers(spark, sf_dir)
    ads = twice(sold.repartition(5, "creative_id"))
    with freed_shuffles(spark):
        gold = G.gold_reconciliation(S.silver_qoe(events, cues, WINDOW, SPAN), ads, tm.content(spark, sf_dir), cues=cues, listed=sold)
        gold.write.parquet(f"{root}/second")
    d = G.idempotence_diff(spark.read.parquet(f"{root}/first"), spark.read.parquet(f"{root}/second"))
    return d.agg(F.coalesce(F.sum(F.when(F.col("side") == "only_a", F.col("copies"))), F.lit(0)).alias("only_a"),
                 F.coalesce(F.sum(F.when(F.col("side") == "only_b", F.col("copies"))), F.lit(0)).alias("only_b"))


@register("idempotence_digest", with_ctes("""
WITH m AS (SELECT MIN(marker_id) AS id FROM gold),
c AS (SELECT COUNT(*) AS n FROM gold, m WHERE marker_id = m.id)
SELECT side, CAST(n AS BIGINT) AS copies FROM c, (SELECT unnest(['only_a', 'only_b']) AS side) s""", "gold"))
def q_idempotence_digest(spark, sf_dir):
    """Two runs of Gold, the second with one marker's revenue changed (U4, J10, SK8): the digests name the dates, and the
    comparison of those finds exactly its rows."""
    root = scratch_path(spark, "digests")
    gold_table(spark, sf_dir).write.parquet(f"{root}/first")
    first = spark.read.parquet(f"{root}/first")
    changed = F.col("marker_id") == F.lit(first.agg(F.min("marker_id")).first()[0])
    raised = F.when(changed, F.coalesce("total_revenue_brl", F.lit(0.0)) + 1).otherwise(F.col("total_revenue_brl"))
    first.withColumn("total_revenue_brl", raised).repartition(5, "region").write.parquet(f"{root}/second")
    return G.digest_diff(first, spark.read.parquet(f"{root}/second")).groupBy("side").agg(F.sum("copies").alias("copies"))


@register("check_ad_revenue", with_ctes("""
SELECT 'ad_revenue_positive' AS "check", COUNT(*) FILTER (WHERE bad) = 0 AS passed, COUNT(*) FILTER (WHERE bad) AS failed_rows
FROM (SELECT advertiser_name IS NOT NULL AND NOT COALESCE(total_revenue_brl > 0, FALSE) AS bad FROM gold) t""", "gold"))
def q_check_ad_revenue(spark, sf_dir):
    """Gold rows with an advertiser earn something (DQ7)."""
    from crowdpulse.operators.quality import check_ad_revenue
    return check_ad_revenue(gold_table(spark, sf_dir)).select("check", "passed", "failed_rows")


@register("union_versions", with_ctes("""
SELECT COALESCE(schema_version, 'v1') AS schema_version, COALESCE(network_type, 'unknown') AS network_type,
       COUNT(*) AS n_events
FROM ev_dedup GROUP BY 1, 2""", "ev_dedup"))
def q_union_versions(spark, sf_dir):
    ev = _events(spark, sf_dir)
    v1 = ev.where(F.col("schema_version").isNull()).drop("schema_version", "network_type")
    v2 = ev.where(F.col("schema_version").isNotNull())
    u = G.union_versions(v1, v2)
    return u.groupBy(F.coalesce("schema_version", F.lit("v1")).alias("schema_version"),
                     F.coalesce("network_type", F.lit("unknown")).alias("network_type")).agg(
        F.count(F.lit(1)).alias("n_events"))


@register("union_broadcasts", with_ctes("""
SELECT content_id, COUNT(*) AS n_events FROM ev_dedup GROUP BY 1""", "ev_dedup"))
def q_union_broadcasts(spark, sf_dir):
    """Per-channel feeds concatenated back into one."""
    ev = _events(spark, sf_dir)
    parts = [ev.where(F.col("cdn") == c) for c in tm.CDNS]
    return G.union_broadcasts(*parts).groupBy("content_id").agg(F.count(F.lit(1)).alias("n_events"))
