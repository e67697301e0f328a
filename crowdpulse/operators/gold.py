"""Gold: ad revenue reconciliation against Silver audience (SURVEY §2.4 J5-J10,
§2.5 A7-A9, §2.8 U2-U5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.functions.columns import REGULAR_CONTENT, interval_seconds, round_dec, trimmed
from crowdpulse.operators.broadcast import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_small, key_bits, maybe_among
from crowdpulse.operators.joins import MAX_SPAN_S, ad_interval_join, span_left_join, span_us

AD_KEY = ("marker_id", "channel")


def dedupe_decisions(ads: DataFrame) -> DataFrame:
    """Replayed ad decisions are counted once (D22): of copies that differ, the one served first, then the one whose
    other columns sort first, so a rerun keeps the same copy. Rows without an id are no replays of each other, and all
    of them count, alike or not."""
    if "decision_id" not in ads.columns:
        return ads
    first = [c for c in ("served_ts", "slot_index") if c in ads.columns]
    row = F.struct(*first, *[c for c in ads.columns if c not in (*first, "decision_id")])
    named = ads.where(F.col("decision_id").isNotNull()).groupBy("decision_id").agg(F.min(row).alias("_row")).select("decision_id", "_row.*").select(*ads.columns)
    return named.unionByName(ads.where(F.col("decision_id").isNull()))


def decisions_of(ads: DataFrame, cues: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """``ads`` without most of the decisions of which no copy is for a marker of ``cues``: those that are, and some others, stay
    whole, all copies of them, so that each is deduplicated as among all rows. Rows without an id stay. ``ads`` are read twice,
    first for ids and markers; these may be ``listed`` where that is cheaper (any copies in any order, but none missing)."""
    if "decision_id" not in ads.columns:
        return ads
    sold = maybe_among((ads if listed is None else listed).select("decision_id", "marker_id"), trimmed("marker_id"), key_bits(cues, trimmed("marker_id")))
    named = maybe_among(ads.where("decision_id IS NOT NULL"), F.col("decision_id"), key_bits(sold, F.col("decision_id")))
    return named.unionByName(ads.where("decision_id IS NULL"))


def ad_revenue_by_marker(ads: DataFrame) -> DataFrame:
    """Revenue per (marker, channel) = sum(cpm / 1000) (A7), keys trimmed before grouping. The representative
    advertiser is the one of the first slot of the pod, a deterministic pick
    instead of ``first`` (A8, D5)."""
    order = F.struct(F.col("slot_index"), F.col("decision_id"))
    return dedupe_decisions(ads).groupBy(*[trimmed(k).alias(k) for k in AD_KEY]).agg(
        F.min_by("advertiser_name", order).alias("advertiser_name"),
        F.sum(F.col("price_cpm_brl") / 1000).alias("revenue_brl"),
        F.count(F.lit(1)).alias("impressions"),
    )


def ad_revenue_by_advertiser(ads: DataFrame) -> DataFrame:
    """Revenue and impressions per advertiser, each pod slot to its own
    advertiser (A9)."""
    return dedupe_decisions(ads).groupBy("advertiser_id", "advertiser_name").agg(
        round_dec(F.sum(F.col("price_cpm_brl") / 1000), 2).alias("revenue_brl"),
        F.count(F.lit(1)).alias("impressions"),
        F.count_distinct("marker_id").alias("markers"),
    )


def one_per_content(content: DataFrame) -> DataFrame:
    """One catalogue row per trimmed id: the latest update, then the title that sorts last."""
    order = F.struct(*[c for c in ("updated_at", "title", "genre") if c in content.columns])
    return content.groupBy(trimmed("content_id").alias("_cid")).agg(
        F.max_by(F.struct(F.col("title").alias("content_title"), "genre"), order).alias("_c")).select("_cid", "_c.*")


def ads_content_join(ads_agg: DataFrame, content: DataFrame,
                     max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Ads x catalogue on space-trimmed keys, left (J5); a repeated catalogue id doesn't multiply the ads."""
    cat = broadcast_if_small(one_per_content(content), max_broadcast_rows)
    a = ads_agg.withColumn("_ch", trimmed("channel"))
    return a.join(cat, a["_ch"] == cat["_cid"], "left").select(
        "marker_id", "advertiser_name", "revenue_brl", "content_title", "genre")


def one_per_marker(enriched: DataFrame) -> DataFrame:
    """One enriched row per trimmed marker (``_mk``): a marker sold on several channels adds up their revenue and takes
    the other columns of the row that sorts first."""
    order = F.struct("content_title", "advertiser_name", "genre")
    return enriched.groupBy(trimmed("marker_id").alias("_mk")).agg(
        F.sum("revenue_brl").alias("revenue_brl"), F.min_by(order, order).alias("_e")).select("_mk", "revenue_brl", "_e.*")


def ad_break_rows(silver: DataFrame, label: str = REGULAR_CONTENT) -> DataFrame:
    """Silver rows inside an ad marker (P5). ``<>`` also drops a null marker."""
    return silver.where(F.col("marker_id") != F.lit(label))


def gold_reconciliation(silver: DataFrame, ads: DataFrame, content: DataFrame, *, label: str = REGULAR_CONTENT,
                        max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS, cues: DataFrame | None = None,
                        listed: DataFrame | None = None) -> DataFrame:
    """Ad rows of Silver x enriched ad revenue on trimmed marker, left.

    Regular content, the hottest key in Silver, is filtered out before the join. Each Silver row gives one Gold row.
    The enriched ads are broadcast when proven small, else AQE decides. With ``cues`` (the markers that Silver was made of),
    decisions for other markers, which meet no Silver row, are mostly left out before they are shuffled (``decisions_of``).
    """
    if cues is not None:
        ads = decisions_of(ads, cues, listed)
    enriched = one_per_marker(ads_content_join(ad_revenue_by_marker(ads), content, max_broadcast_rows))
    enriched = broadcast_if_small(enriched, max_broadcast_rows)
    s = ad_break_rows(silver, label).select("window_start", "marker_id", "region", "device", "cdn", "ccv", "avg_bitrate_kbps",
                                            "error_rate")
    joined = s.join(enriched, trimmed(s["marker_id"]) == enriched["_mk"], "left")
    return joined.select(
        "window_start", "marker_id", "content_title", "genre", "advertiser_name", "region", "device", "cdn",
        F.col("ccv"), round_dec("revenue_brl", 2).alias("total_revenue_brl"),
        round_dec("avg_bitrate_kbps", 2).alias("avg_bitrate_kbps"), round_dec("error_rate", 4).alias("error_rate"))


def ad_impressions_3way(events: DataFrame, markers: DataFrame, ads: DataFrame, span: str = "2 minutes",
                        max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Observed ad plays x markers x decisions (J7): ``ad_start`` events inside
    a marker span, per marker, against the pod's decisions and revenue."""
    starts = events.where(F.col("event_type") == "ad_start")
    played = ad_interval_join(starts, markers.select("marker_id", "channel", "wallclock"), span,
                              max_broadcast_rows=max_broadcast_rows).where(F.col("marker_id").isNotNull())
    per_marker = played.groupBy(trimmed("marker_id").alias("marker_id")).agg(
        F.count(F.lit(1)).alias("ad_starts"), F.count_distinct("session_id").alias("viewers"))
    pods = ad_revenue_by_marker(ads).groupBy("marker_id").agg(
        F.sum("revenue_brl").alias("revenue_brl"), F.sum("impressions").alias("impressions"))
    return per_marker.join(pods, "marker_id", "inner").select(
        "marker_id", "ad_starts", "viewers", "impressions", round_dec("revenue_brl", 2).alias("revenue_brl"))


def scd2_content_join(facts: DataFrame, versions: DataFrame, *, ts: str = "timestamp", key: str = "content_id",
                      bucket: str = "1 day", max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Attach the catalogue version valid at each fact's time (J8): version i is valid on [updated_at_i, updated_at_{i+1}),
    the last one without end. Versions are looked up by (content, time), so a content with many of them costs no more."""
    from pyspark.sql import Window
    w = Window.partitionBy("_cid").orderBy("updated_at")
    v = versions.select(trimmed("content_id").alias("_cid"), F.col("title").alias("content_title"), "genre", "updated_at") \
        .withColumn("_valid_to", F.lead("updated_at").over(w))
    start = F.unix_micros("updated_at")
    end = F.coalesce(F.unix_micros("_valid_to"), start + span_us(F.lit(MAX_SPAN_S)))
    joined = span_left_join(facts, v, start, end, ts=ts, key=trimmed(key), span_key=F.col("_cid"), bucket_s=interval_seconds(bucket),
                            max_broadcast_rows=max_broadcast_rows)
    return joined.select(*facts.columns, *[F.col(f"_span.{c}").alias(c) for c in ("content_title", "genre")])


def unmatched_ads(ads: DataFrame, markers: DataFrame) -> DataFrame:
    """Ad decisions whose marker never appeared in the cue stream (J9, anti)."""
    return ads.join(markers.select(trimmed("marker_id").alias("_m")).distinct(),
                    trimmed(ads["marker_id"]) == F.col("_m"), "left_anti")


def sessions_with_ads(events: DataFrame, markers: DataFrame, span: str = "2 minutes") -> DataFrame:
    """Sessions with at least one event inside an ad marker span (J9, semi)."""
    inside = ad_interval_join(events.select("session_id", "timestamp", "content_id"),
                              markers.select("marker_id", "channel", "wallclock"), span)
    hits = inside.where(F.col("marker_id").isNotNull()).select("session_id").distinct()
    return events.select("session_id").distinct().join(hits, "session_id", "left_semi")


def matched_markers(ads: DataFrame, markers: DataFrame) -> DataFrame:
    """Markers present both in decisions and in the cue stream."""
    return ads.select(trimmed("marker_id").alias("marker_id")).intersect(
        markers.select(trimmed("marker_id").alias("marker_id")))


def rights_check(events: DataFrame, content: DataFrame, *, ts: str = "timestamp",
                 max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Flag each event against the content's rights: region in territories and
    time inside the rights window (F16)."""
    cat = broadcast_if_small(content.select(
        trimmed("content_id").alias("_cid"), "rights_territories", "rights_window_start", "rights_window_end"),
        max_broadcast_rows)
    j = events.join(cat, events["content_id"] == cat["_cid"], "left")
    return j.withColumn("in_territory", F.coalesce(F.array_contains("rights_territories", F.col("region")),
                                                   F.lit(False))) \
        .withColumn("in_window", F.coalesce(F.col(ts).between(F.col("rights_window_start"),
                                                              F.col("rights_window_end")), F.lit(False))) \
        .withColumn("rights_ok", F.col("in_territory") & F.col("in_window")) \
        .drop("_cid", "rights_territories", "rights_window_start", "rights_window_end")


def stream_batch_reconcile(stream_silver: DataFrame, batch_silver: DataFrame, keys=("window_start", "region",
                           "device", "cdn", "marker_id"), measures=("ccv", "event_count", "error_count"),
                           tol: float = 0.0) -> DataFrame:
    """Full outer join of two Silver computations on the key; rows where a
    side is missing or a measure differs by more than ``tol`` (J10)."""
    a = stream_silver.select(*keys, *[F.col(m).alias(f"stream_{m}") for m in measures])
    b = batch_silver.select(*keys, *[F.col(m).alias(f"batch_{m}") for m in measures])
    j = a.join(b, list(keys), "full_outer")
    diff = None
    for m in measures:
        d = (F.col(f"stream_{m}").isNull() | F.col(f"batch_{m}").isNull()
             | (F.abs(F.col(f"stream_{m}") - F.col(f"batch_{m}")) > F.lit(tol)))
        diff = d if diff is None else (diff | d)
    return j.where(diff)


def idempotence_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one run but not the other, with multiplicity (U4): the
    ``exceptAll`` both ways, as one signed count per distinct row. Empty
    when the two runs are identical; ``copies`` rows of ``side`` otherwise."""
    cols = list(a.columns)
    signed = a.withColumn("_n", F.lit(1)).unionByName(b.select(*cols).withColumn("_n", F.lit(-1)))
    net = signed.groupBy(*cols).agg(F.sum("_n").alias("_net")).where(F.col("_net") != 0)
    return net.select(*cols, F.when(F.col("_net") > 0, "only_a").otherwise("only_b").alias("side"),
                      F.abs("_net").alias("copies"))


def date_digests(df: DataFrame, date: str) -> DataFrame:
    """An order-free digest of each date's rows (U4): their count, and the sum and the exclusive or of two row hashes."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return df.groupBy(F.to_date(date).alias("date")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit("digest"), *cols)).alias("mixed"))


def differing_dates(a: DataFrame, b: DataFrame, date: str) -> DataFrame:
    """Dates whose rows differ between two runs; only digests are shuffled."""
    x, y = (date_digests(df.select(*a.columns), date).select("date", F.struct("rows", "total", "mixed").alias(n)) for df, n in ((a, "x"), (b, "y")))
    both = x.join(y, x["date"].eqNullSafe(y["date"]), "full_outer")
    return both.where(~F.col("x").eqNullSafe(F.col("y"))).select(F.coalesce(x["date"], y["date"]).alias("date"))


def digest_diff(a: DataFrame, b: DataFrame, date: str = "window_start") -> DataFrame:
    """``idempotence_diff`` over the dates whose digests differ. The dates (a row a day) pass through the driver, so that both
    scans can skip the others. Runs that are alike cost two scans and a few digests."""
    dates = [r.date for r in differing_dates(a, b, date).collect()]
    day = F.to_date(date)
    bounds = [d for d in dates if d is not None]
    pick = day.isin(bounds) if bounds else F.lit(False)
    if bounds:   # a plain range on the column itself reaches the scan
        pick = pick & (F.col(date) >= F.lit(min(bounds)).cast("timestamp")) & (F.col(date) < F.date_add(F.lit(max(bounds)), 1).cast("timestamp"))
    pick = pick | F.col(date).isNull() if None in dates else pick
    return idempotence_diff(a.where(pick), b.where(pick))


def union_broadcasts(*dfs: DataFrame) -> DataFrame:
    """Concatenate several broadcasts / runs by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def union_versions(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Union v1 and v2 rows; columns missing on one side become null."""
    return v1.unionByName(v2, allowMissingColumns=True)
