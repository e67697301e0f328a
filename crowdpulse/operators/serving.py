"""Serving: the business queries and dashboard figures over Silver and Gold
(SURVEY §2.5 A10-A23, §2.6 W4/W6, §2.7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.functions.columns import REGULAR_CONTENT, ratio, round_dec

# Fixed labels for missing sponsor / program on the dashboard.
NO_SPONSOR = "Sem patrocinador"
NO_PROGRAM = "Sem programa"


def sponsor_revenue(gold: DataFrame) -> DataFrame:
    """Fan-out-safe revenue per (sponsor, program) (A10): revenue is the MAX
    per (advertiser, title, marker) because each marker's revenue is repeated
    on all of its Silver rows; then summed and rounded; CCV summed."""
    per_ad = gold.where(F.col("advertiser_name").isNotNull()).groupBy(
        "advertiser_name", "content_title", "marker_id").agg(
        F.max("total_revenue_brl").alias("ad_revenue"), F.sum("ccv").alias("ad_ccv"))
    return per_ad.groupBy("advertiser_name", "content_title").agg(
        round_dec(F.sum("ad_revenue"), 2).alias("total_revenue_brl"),
        F.sum("ad_ccv").alias("impacted_viewers"),
    ).select(F.col("advertiser_name").alias("sponsor"), F.col("content_title").alias("program"),
             "total_revenue_brl", "impacted_viewers").orderBy(
        F.col("total_revenue_brl").desc(), "sponsor", "program")


def sponsor_rollup(sponsor_rev: DataFrame) -> DataFrame:
    """Revenue per sponsor with the number of distinct programs."""
    s = F.coalesce(F.col("sponsor"), F.lit(NO_SPONSOR))
    p = F.coalesce(F.col("program"), F.lit(NO_PROGRAM))
    return sponsor_rev.groupBy(s.alias("sponsor")).agg(
        round_dec(F.sum("total_revenue_brl"), 2).alias("total_revenue_brl"),
        F.count_distinct(p).alias("programs"),
    ).orderBy(F.col("total_revenue_brl").desc(), "sponsor")


def total_revenue(sponsor_rev: DataFrame) -> DataFrame:
    """Grand total revenue; 0 on empty input."""
    return sponsor_rev.agg(round_dec(F.coalesce(F.sum("total_revenue_brl"), F.lit(0.0)), 2).alias("total_revenue_brl"))


def cdn_degradation_top(silver: DataFrame, k: int = 15) -> DataFrame:
    """Per (window, CDN): mean error rate, mean buffer, summed CCV; worst ``k``
    by error rate, ties broken by window and CDN (A11, T2)."""
    agg = silver.groupBy("window_start", "cdn").agg(
        round_dec(F.avg("error_rate"), 4).alias("mean_error_rate"),
        round_dec(F.avg("avg_buffer_length_ms"), 2).alias("mean_buffer_ms"),
        F.sum("ccv").alias("affected_viewers"))
    return agg.orderBy(F.col("mean_error_rate").desc(), "window_start", "cdn").limit(k)


def peak_ccv(silver: DataFrame, k: int = 1) -> DataFrame:
    """Windows with the largest summed CCV (A12). The sum over cells counts a
    session once per cell, an upper bound (D6); see ``peak_ccv_exact``."""
    return silver.groupBy("window_start").agg(F.sum("ccv").alias("peak_ccv")).orderBy(
        F.col("peak_ccv").desc(), "window_start").limit(k)


def peak_ccv_top5(silver: DataFrame) -> DataFrame:
    return peak_ccv(silver, 5)


def peak_ccv_exact(events: DataFrame, window: str = "1 minute", k: int = 5) -> DataFrame:
    """Exact distinct sessions per window, top ``k`` (fix for D6)."""
    agg = events.groupBy(F.window("timestamp", window).alias("w")).agg(
        F.count_distinct("session_id").alias("peak_ccv"))
    return agg.select(F.col("w.start").alias("window_start"), "peak_ccv").orderBy(
        F.col("peak_ccv").desc(), "window_start").limit(k)


def ad_delivery(gold: DataFrame) -> DataFrame:
    """Ad delivery by sponsor, region, device."""
    return gold.where(F.col("advertiser_name").isNotNull()).groupBy(
        F.col("advertiser_name").alias("sponsor"), "region", "device").agg(
        F.sum("ccv").alias("views"), round_dec(F.avg("error_rate"), 4).alias("ad_failure_rate")).orderBy(
        F.col("views").desc(), "sponsor", "region", "device")


def cdn_error_series(silver: DataFrame) -> DataFrame:
    """Mean error rate per (window, CDN), time ordered."""
    return silver.groupBy("window_start", "cdn").agg(round_dec(F.avg("error_rate"), 4).alias("error_rate")) \
        .orderBy("window_start", "cdn")


def cdn_error_weighted(silver: DataFrame) -> DataFrame:
    """Count-weighted error rate per (window, CDN): errors / events instead of
    a mean of cell ratios (A20, D7)."""
    return silver.groupBy("window_start", "cdn").agg(
        F.sum("error_count").alias("errors"), F.sum("event_count").alias("events")).select(
        "window_start", "cdn", "errors", "events", ratio("errors", "events").alias("error_rate"))


def cdn_peak_error(silver: DataFrame, cdn: str = "cdn-b") -> DataFrame:
    """Highest per-window mean error rate of one CDN (case-insensitive), 0 if
    none (A17, P9)."""
    series = cdn_error_series(silver)
    return series.agg(F.coalesce(F.max(F.when(F.lower("cdn") == cdn.lower(), F.col("error_rate"))),
                                 F.lit(0.0)).alias("peak_error_rate"))


def ccv_by_region(events: DataFrame, window: str = "1 minute") -> DataFrame:
    """Exact distinct sessions per (window, region)."""
    agg = events.groupBy(F.window("timestamp", window).alias("w"), "region").agg(
        F.count_distinct("session_id").alias("ccv"))
    return agg.select(F.col("w.start").alias("window_start"), "region", "ccv")


def ccv_grouping_sets(events: DataFrame, window: str = "1 minute") -> DataFrame:
    """Distinct sessions per window at region / device / cdn / total grain in
    one pass (A22); ``level`` names the grain."""
    base = events.select(F.window("timestamp", window).start.alias("window_start"), "region", "device", "cdn",
                         "session_id")
    sets = [["window_start", "region"], ["window_start", "device"], ["window_start", "cdn"], ["window_start"]]
    level = (F.when(F.grouping("region") == 0, "region").when(F.grouping("device") == 0, "device")
             .when(F.grouping("cdn") == 0, "cdn").otherwise("total"))
    return base.groupingSets(sets, "window_start", "region", "device", "cdn").agg(
        level.alias("level"), F.count_distinct("session_id").alias("ccv"))


def session_dictionary(events: DataFrame, path: str, session: str = "session_id") -> DataFrame:
    """Numbers for sessions, written to ``path``: dense within each partition, so that a bitmap's bits are used. A later run
    reads the table instead of numbering again."""
    spark = events.sparkSession
    named = events.where(F.col(session).isNotNull()).select(F.col(session).alias("session")).distinct()
    named.select("session", F.monotonically_increasing_id().alias("number")).write.parquet(path)
    return spark.read.parquet(path)


def ccv_cells(events: DataFrame, dictionary: DataFrame, window: str = "1 minute", dims=("region", "device", "cdn"),
              session: str = "session_id") -> DataFrame:
    """Sessions of each (window, dims) cell as bitmaps over their numbers, a row for each 32,768 numbers that occur (A3).
    Events are reduced to distinct (cell, session) before they meet the dictionary, so a session's repeats don't travel."""
    seen = events.select(F.window("timestamp", window).start.alias("window_start"), *dims, F.col(session).alias("session")).distinct()
    numbered = seen.join(dictionary, "session", "left")
    return numbered.groupBy("window_start", *dims, F.bitmap_bucket_number("number").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("sessions"))


def roll_up_cells(cells: DataFrame, by) -> DataFrame:
    """Exact distinct sessions at a coarser grain, from the cells alone: bitmaps are united, never counts added."""
    united = cells.groupBy(*by, "part").agg(F.bitmap_or_agg("sessions").alias("sessions"))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("sessions")).alias("ccv"))


def ccv_grouping_sets_from_cells(cells: DataFrame) -> DataFrame:
    """``ccv_grouping_sets`` from stored cells (A21, A22): what is copied for the four grains is cells, not events."""
    dims = ("region", "device", "cdn")
    sets = [["window_start", "part", d] for d in dims] + [["window_start", "part"]]
    level = (F.when(F.grouping("region") == 0, "region").when(F.grouping("device") == 0, "device")
             .when(F.grouping("cdn") == 0, "cdn").otherwise("total"))
    united = cells.groupingSets(sets, "window_start", "part", *dims).agg(level.alias("level"), F.bitmap_or_agg("sessions").alias("sessions"))
    return united.groupBy("window_start", *dims, "level").agg(F.sum(F.bitmap_count("sessions")).alias("ccv"))


def marker_impact(silver: DataFrame, gold: DataFrame, window: str = "1 minute",
                  label: str = REGULAR_CONTENT) -> DataFrame:
    """Commercial impact per marker (A23): audience and errors during the
    break, total audience in the window before and the window after (0 when
    that window has no data), revenue."""
    step = F.expr(f"INTERVAL {window}")
    breaks = silver.where(F.col("marker_id") != F.lit(label))
    during = breaks.groupBy("marker_id").agg(
        F.min("window_start").alias("first_window"), F.max("window_start").alias("last_window"),
        F.sum("ccv").alias("ccv_during"), F.sum("error_count").alias("errors_during"),
        F.sum("event_count").alias("events_during"))
    per_window = silver.groupBy("window_start").agg(F.sum("ccv").alias("ccv_all"))
    before = per_window.select(F.col("window_start").alias("_bw"), F.col("ccv_all").alias("ccv_before"))
    after = per_window.select(F.col("window_start").alias("_aw"), F.col("ccv_all").alias("ccv_after"))
    d = (during.join(before, F.col("_bw") == F.col("first_window") - step, "left")
         .join(after, F.col("_aw") == F.col("last_window") + step, "left"))
    rev = gold.groupBy("marker_id").agg(F.max("total_revenue_brl").alias("revenue_brl"))
    return d.join(rev, "marker_id", "left").select(
        "marker_id", "first_window", "last_window", F.coalesce("ccv_before", F.lit(0)).alias("ccv_before"),
        "ccv_during", F.coalesce("ccv_after", F.lit(0)).alias("ccv_after"),
        ratio("errors_during", "events_during").alias("error_rate_during"), "revenue_brl")


def cdn_rank_per_minute(silver: DataFrame) -> DataFrame:
    """Rank CDNs inside each window by mean error rate."""
    series = cdn_error_series(silver)
    w = Window.partitionBy("window_start").orderBy(F.col("error_rate").desc())
    return series.select("window_start", "cdn", "error_rate", F.rank().over(w).alias("error_rank"),
                         F.dense_rank().over(w).alias("error_dense_rank"))


def revenue_running(gold: DataFrame) -> DataFrame:
    """Cumulative revenue per advertiser over time (W6); each marker's revenue
    counted once, at its first window."""
    per_marker = gold.where(F.col("advertiser_name").isNotNull()).groupBy("advertiser_name", "marker_id").agg(
        F.min("window_start").alias("window_start"), F.max("total_revenue_brl").alias("revenue_brl"))
    per_window = per_marker.groupBy("advertiser_name", "window_start").agg(F.sum("revenue_brl").alias("revenue_brl"))
    w = Window.partitionBy("advertiser_name").orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    return per_window.select("advertiser_name", "window_start", round_dec("revenue_brl", 2).alias("revenue_brl"),
                             round_dec(F.sum("revenue_brl").over(w), 2).alias("running_revenue_brl"))
