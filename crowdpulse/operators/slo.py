"""Service levels, alerts and anomaly checks (SURVEY §2.11 SL1-SL8, AN1;
§2.6 W5). Each returns a small DataFrame; thresholds are parameters with the
reference's values as defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.functions.columns import in_window, interval_seconds, minutes_since, ratio, round_dec
from crowdpulse.functions.columns import trimmed
from crowdpulse.operators.joins import ad_interval_join
from crowdpulse.operators.serving import cdn_error_series


def _slo(agg: DataFrame, name: str, met) -> DataFrame:
    return agg.withColumn("slo", F.lit(name)).withColumn("met", met)


def slo_freshness(df: DataFrame, event_col: str, emitted_col: str, max_s: float = 120,
                  target: float = 0.999) -> DataFrame:
    """Share of rows emitted within ``max_s`` of their event time (SL1)."""
    lag = (F.unix_micros(emitted_col) - F.unix_micros(event_col)) / F.lit(1_000_000.0)
    agg = df.agg(F.count(F.lit(1)).alias("rows"), F.sum((lag <= max_s).cast("long")).alias("within"),
                 F.max(lag).alias("max_lag_s"))
    return _slo(agg.withColumn("share", ratio("within", "rows")), "freshness", F.col("share") >= target)


def slo_uniqueness(events: DataFrame, delay_s: int = 15, ts: str = "timestamp", key: str = "event_id") -> DataFrame:
    """Event ids seen again within the watermark delay of an earlier copy; the
    target is zero (SL2). The gap to the copy before decides, so no window edge
    can part two copies. Copies at one instant are counted before the shuffle
    and are near at once, so that a hot id is as many rows as it has times."""
    times = events.groupBy(key, ts).agg((F.count(F.lit(1)) > 1).alias("again"))
    earlier = F.lag(ts).over(Window.partitionBy(key).orderBy(ts))
    near = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) <= int(delay_s * 1_000_000)
    per = times.withColumn("near", (F.col("again") & F.col(ts).isNotNull()) | F.coalesce(near, F.lit(False))).groupBy(key).agg(F.max("near").alias("near"))
    agg = per.agg(F.coalesce(F.sum(F.col("near").cast("long")), F.lit(0)).alias("duplicated_ids"))
    return _slo(agg, "uniqueness", F.col("duplicated_ids") == 0)


def slo_contract(validated: DataFrame, max_share: float = 0.001) -> DataFrame:
    """Dead-letter share of the feed below ``max_share`` (SL3)."""
    agg = validated.agg(F.count(F.lit(1)).alias("n_rows"), F.sum((~F.col("valid")).cast("long")).alias("dlq_rows"))
    agg = agg.withColumn("dlq_share", ratio("dlq_rows", "n_rows"))
    return agg.withColumn("met", F.col("dlq_share") <= max_share).select("n_rows", "dlq_rows", "dlq_share", "met")


def slo_match_rate(events: DataFrame, markers: DataFrame, span: str = "2 minutes", target: float = 0.98,
                   ad_types=("ad_start", "ad_end")) -> DataFrame:
    """Share of the player's ad events that fall into the span of a marker of
    their channel (SL4); an event under several markers counts once."""
    ads = events.where(F.col("event_type").isin(list(ad_types)))
    joined = ad_interval_join(ads.select("event_id", "timestamp", "content_id"), markers.select("marker_id", "channel", "wallclock"), span)
    per = joined.groupBy("event_id", "timestamp").agg(F.max(F.col("marker_id").isNotNull()).alias("hit"))
    agg = per.agg(F.count(F.lit(1)).alias("ad_events"), F.coalesce(F.sum(F.col("hit").cast("long")), F.lit(0)).alias("matched"))
    agg = agg.withColumn("match_rate", ratio("matched", "ad_events"))
    return agg.withColumn("met", F.col("match_rate") >= target)


def decision_match_rate(ads: DataFrame, markers: DataFrame, target: float = 0.98) -> DataFrame:
    """Share of ad decisions whose marker exists in the cue stream."""
    known = markers.select(trimmed("marker_id").alias("_m")).distinct()
    j = ads.join(known, trimmed(ads["marker_id"]) == F.col("_m"), "left")
    agg = j.agg(F.count(F.lit(1)).alias("decisions"), F.count("_m").alias("matched"))
    agg = agg.withColumn("match_rate", ratio("matched", "decisions"))
    return agg.withColumn("met", F.col("match_rate") >= target)


def slo_revenue(gold: DataFrame) -> DataFrame:
    """Revenue per ad (the per-marker max of A10) is never negative (SL5)."""
    per_ad = gold.where(F.col("advertiser_name").isNotNull()).groupBy(
        "advertiser_name", "content_title", "marker_id").agg(F.max("total_revenue_brl").alias("r"))
    agg = per_ad.agg(F.min("r").alias("min_ad_revenue"), F.count(F.lit(1)).alias("ads"))
    return agg.withColumn("met", F.coalesce(F.col("min_ad_revenue") >= 0, F.lit(True)))


def slo_gold_timeliness(gold: DataFrame, publish_ts: str, window: str = "1 minute",
                        max_min: float = 30) -> DataFrame:
    """Minutes from the end of the newest Gold window to ``publish_ts``
    (SL8); ``publish_ts`` is passed in, never read from the clock."""
    end = F.max("window_start") + F.expr(f"INTERVAL {window}")
    agg = gold.agg(end.alias("newest_window_end"))
    lag = (F.unix_micros(F.lit(publish_ts).cast("timestamp")) - F.unix_micros("newest_window_end")) / F.lit(6e7)
    return agg.withColumn("lag_min", lag).withColumn("met", F.col("lag_min") <= max_min)


def cdn_alert(silver: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Windows where a CDN's mean error rate is above ``threshold`` (SL6)."""
    return cdn_error_series(silver).where(F.col("error_rate") > threshold)


def burn_rate(silver: DataFrame, target: float = 0.95, fast: str = "1 hour", slow: str = "6 hours",
              window: str = "1 minute") -> DataFrame:
    """Error-budget burn per CDN over a fast and a slow trailing range
    (SL7): (errors / events in range) / (1 - target). Runs on the
    per-window series, one row per (window, CDN)."""
    per = silver.groupBy("window_start", "cdn").agg(F.sum("error_count").alias("errors"),
                                                   F.sum("event_count").alias("events"))
    step = interval_seconds(window)
    t = F.unix_seconds("window_start")
    budget = 1.0 - target
    out = per
    for name, rng in (("fast", fast), ("slow", slow)):
        w = Window.partitionBy("cdn").orderBy(t).rangeBetween(-(interval_seconds(rng) - step), 0)
        out = out.withColumn(f"burn_{name}", round_dec(
            F.sum("errors").over(w).cast("double") / F.sum("events").over(w) / F.lit(budget), 6))
    return out


def degradation_window_flag(df: DataFrame, start, ts: str = "window_start", lo: float = 60,
                            hi: float = 75) -> DataFrame:
    """Minute of broadcast and the half-open ``[lo, hi)`` flag."""
    start_col = F.lit(start).cast("timestamp") if isinstance(start, str) else start
    return df.withColumn("minute", minutes_since(F.col(ts), start_col)).withColumn(
        "in_window", in_window(F.col("minute"), lo, hi))


def degradation_uplift(silver: DataFrame, start, lo: float = 60, hi: float = 75) -> DataFrame:
    """Per CDN: mean error rate and buffer inside vs outside the window, and
    the uplift ratios (AN1)."""
    f = degradation_window_flag(silver, start, "window_start", lo, hi)
    agg = f.groupBy("cdn").agg(
        F.avg(F.when(F.col("in_window"), F.col("error_rate"))).alias("_ein"),
        F.avg(F.when(~F.col("in_window"), F.col("error_rate"))).alias("_eout"),
        F.avg(F.when(F.col("in_window"), F.col("avg_buffer_length_ms"))).alias("_bin"),
        F.avg(F.when(~F.col("in_window"), F.col("avg_buffer_length_ms"))).alias("_bout"))
    return agg.select(
        "cdn", round_dec("_ein", 4).alias("error_rate_in"), round_dec("_eout", 4).alias("error_rate_out"),
        round_dec("_bin", 2).alias("buffer_ms_in"), round_dec("_bout", 2).alias("buffer_ms_out"),
        round_dec(F.when(F.col("_eout") > 0, F.col("_ein") / F.col("_eout")), 4).alias("error_uplift"),
        round_dec(F.when(F.col("_bout") > 0, F.col("_bin") / F.col("_bout")), 4).alias("buffer_uplift"))


def zscore_anomaly(series: DataFrame, value: str, n: int = 10, order: str = "window_start", by=("cdn",),
                   threshold: float = 3.0) -> DataFrame:
    """Rolling z-score of ``value`` against the previous ``n`` points of the
    same series (W5); ``anomaly`` when |z| > threshold."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-n, -1)
    mean, sd = F.avg(value).over(w), F.stddev_samp(value).over(w)
    z = F.when(sd > 0, (F.col(value) - mean) / sd)
    return series.withColumn("zscore", round_dec(z, 4)).withColumn(
        "anomaly", F.coalesce(F.abs(F.col("zscore")) > threshold, F.lit(False)))
