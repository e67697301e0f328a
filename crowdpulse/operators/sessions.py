"""Session analytics.

Ordered per-session work runs per (session, hour bucket) with carries
(``crowdpulse.operators.running``), so one long or bot session does not
become one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.functions.columns import interval_seconds
from crowdpulse.operators.running import bucketed_lead, running_agg, time_bucket

CLOSING_EVENTS = ("video_end", "error")


def _ms(a, b):
    return (F.unix_micros(a) - F.unix_micros(b)) / F.lit(1000.0)


def sessionise(events: DataFrame, gap: str = "30 minutes", keys=("session_id",),
               ts: str = "timestamp", bucket: str = "1 hour") -> DataFrame:
    """Split each key's events into sessions separated by ``gap`` of
    inactivity (ST6); a session ends ``gap`` after its last event.

    Streams use ``session_window`` (after a watermark). Batch input avoids
    putting a whole key in one task and reads its input once: events are
    sessionised per (key, ``bucket``) into fragments, then the few fragments
    of each key are merged across buckets."""
    keys = list(keys)
    closing = F.col("event_type").isin(list(CLOSING_EVENTS))
    if events.isStreaming:
        agg = events.groupBy(*keys, F.session_window(ts, gap).alias("sw")).agg(
            F.count(F.lit(1)).alias("events"), F.max(closing).alias("closed"))
        return agg.select(*keys, F.col("sw.start").alias("session_start"), F.col("sw.end").alias("session_end"),
                          "events", "closed")
    gap_us = interval_seconds(gap) * 1_000_000

    def breaks(cur, prev):
        return (prev.isNull() | ((F.unix_micros(cur) - F.unix_micros(prev)) >= gap_us)).cast("int")

    # 1. Fragments: sessionise each (key, hour) on its own. One shuffle, and the
    #    fragment aggregate reuses the window's partitioning (no second one).
    b = events.select(*keys, ts, closing.alias("_c")).withColumn("_b", time_bucket(ts, interval_seconds(bucket)))
    w = Window.partitionBy(*keys, "_b").orderBy(ts)
    b = b.withColumn("_brk", breaks(F.col(ts), F.lag(ts).over(w)))
    b = b.withColumn("_ln", F.sum("_brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    frags = b.groupBy(*keys, "_b", "_ln").agg(
        F.min(ts).alias("_fs"), F.max(ts).alias("_fl"), F.count(F.lit(1)).alias("_n"), F.max("_c").alias("_closed"))
    # 2. Merge fragments per key: fragments are disjoint and time ordered, so a
    #    fragment continues the previous one when it starts less than ``gap``
    #    after that one's last event. A key holds one row per fragment here,
    #    not per event.
    wk = Window.partitionBy(*keys).orderBy("_fs")
    frags = frags.withColumn("_gb", breaks(F.col("_fs"), F.lag("_fl").over(wk)))
    frags = frags.withColumn("_sn", F.sum("_gb").over(wk.rowsBetween(Window.unboundedPreceding, 0)))
    agg = frags.groupBy(*keys, "_sn").agg(
        F.min("_fs").alias("session_start"), F.max("_fl").alias("_last"), F.sum("_n").alias("events"),
        F.max("_closed").alias("closed"))
    return agg.select(*keys, "session_start",
                      (F.col("_last") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_us / 1e6)))
                      .alias("session_end"), "events", "closed")


def session_summary(events: DataFrame, key: str = "session_id", ts: str = "timestamp") -> DataFrame:
    """Start, end, duration, events and whether the session closed with a
    ``video_end`` or ``error`` (SE1). Partial aggregation keeps a hot session
    cheap."""
    return events.groupBy(key).agg(
        F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"), F.count(F.lit(1)).alias("events"),
        F.bool_or(F.col("event_type").isin(list(CLOSING_EVENTS))).alias("closed"),
    ).withColumn("duration_s", (F.unix_micros("end_ts") - F.unix_micros("start_ts")) / F.lit(1_000_000.0))


def video_startup_time(events: DataFrame, key: str = "session_id", ts: str = "timestamp",
                       bucket: str = "1 hour") -> DataFrame:
    """Startup proxy (SE2): first event after the first ``video_start`` that is
    not a start, minus that start, in ms. No first-frame event exists.

    One pass over the events: each (session, hour) keeps its first start, its
    first other event, and its first other event at or after its own first
    start; the session's first start then picks among those few rows."""
    is_start = F.col("event_type") == "video_start"
    e = events.select(key, F.col(ts).alias("_t"), is_start.alias("_s"), time_bucket(ts, interval_seconds(bucket)).alias("_b"))
    began = F.min(F.when(F.col("_s"), F.col("_t"))).over(Window.partitionBy(key, "_b").orderBy("_t"))
    other = ~F.coalesce(F.col("_s"), F.lit(True))
    per = e.withColumn("_began", began).groupBy(key, "_b").agg(
        F.min(F.when(F.col("_s"), F.col("_t"))).alias("_start"), F.min(F.when(other, F.col("_t"))).alias("_any"),
        F.min(F.when(other & (F.col("_began") <= F.col("_t")), F.col("_t"))).alias("_after"))
    first = F.min("_start").over(Window.partitionBy(key))
    home = F.col("_start") == F.col("start_ts")
    later = F.col("_b") > time_bucket("start_ts", interval_seconds(bucket))
    picked = per.withColumn("start_ts", first).withColumn("_c", F.when(home, F.col("_after")).when(later, F.col("_any")))
    best = picked.groupBy(key, "start_ts").agg(F.min("_c").alias("first_ts")).where("start_ts is not null and first_ts is not null")
    return best.select(key, "start_ts", "first_ts", _ms(F.col("first_ts"), F.col("start_ts")).alias("startup_ms"))


def exit_before_start(events: DataFrame, key: str = "session_id") -> DataFrame:
    """Sessions with a ``video_start`` and no heartbeat (SE3 proxy)."""
    per = events.groupBy(key).agg(F.bool_or(F.col("event_type") == "video_start").alias("s"),
                                  F.bool_or(F.col("event_type") == "heartbeat").alias("h"))
    return per.agg(F.sum(F.col("s").cast("long")).alias("sessions_started"),
                   F.sum((F.col("s") & ~F.col("h")).cast("long")).alias("exits_before_start")).withColumn(
        "exit_share", F.col("exits_before_start").cast("double") / F.col("sessions_started"))


def with_next_event(events: DataFrame, key: str = "session_id", ts: str = "timestamp",
                    bucket: str = "1 hour", cols=("event_type",)) -> DataFrame:
    """Each event with the session's next event (time and ``cols``)."""
    return bucketed_lead(events, [key], ts, list(cols), time_bucket(ts, interval_seconds(bucket)))


def stall_intervals(events: DataFrame, key: str = "session_id", ts: str = "timestamp",
                    bucket: str = "1 hour") -> DataFrame:
    """A ``buffer_start`` whose next session event is a ``buffer_end`` is a
    stall; its length is the gap in ms (W2)."""
    nxt = with_next_event(events.select(key, ts, "event_type"), key, ts, bucket)
    return nxt.where((F.col("event_type") == "buffer_start") & (F.col("next_event_type") == "buffer_end")).select(
        key, F.col(ts).alias("stall_start"), F.col(f"next_{ts}").alias("stall_end"),
        _ms(F.col(f"next_{ts}"), F.col(ts)).alias("stall_ms"))


def rebuffer_ratio(events: DataFrame, key: str = "session_id", ts: str = "timestamp",
                   bucket: str = "1 hour") -> DataFrame:
    """Stall time over watch time per session (SE4), both from the same fragments: one pass over the events."""
    from crowdpulse.operators.fragments import session_fragments, session_qoe
    q = session_qoe(session_fragments(events, bucket, key, ts), key)
    watch = (F.unix_micros("end_ts") - F.unix_micros("start_ts")) / F.lit(1_000_000.0) * 1000
    return q.select(key, watch.alias("watch_ms"), "stall_ms").withColumn(
        "rebuffer_ratio", F.when(F.col("watch_ms") > 0, F.col("stall_ms") / F.col("watch_ms")))


def weighted_bitrate(events: DataFrame, key: str = "session_id", ts: str = "timestamp",
                     bucket: str = "1 hour") -> DataFrame:
    """Time-weighted bitrate per session (W3): each event's bitrate holds
    until the next event."""
    nxt = with_next_event(events.select(key, ts, "bitrate_kbps"), key, ts, bucket, cols=("bitrate_kbps",))
    held = nxt.where(F.col(f"next_{ts}").isNotNull() & F.col("bitrate_kbps").isNotNull()).withColumn(
        "held_ms", _ms(F.col(f"next_{ts}"), F.col(ts)))
    agg = held.groupBy(key).agg(F.sum(F.col("bitrate_kbps") * F.col("held_ms")).alias("_w"),
                                F.sum("held_ms").alias("held_ms"))
    return agg.select(key, "held_ms", F.when(F.col("held_ms") > 0, F.col("_w") / F.col("held_ms"))
                      .alias("weighted_bitrate_kbps"))


def global_dedupe(events: DataFrame, key: str = "event_id", order=("timestamp",)) -> DataFrame:
    """First copy per ``key`` by ``order`` then all columns (W1). A min-by
    aggregate, so copies of one hot id collapse map-side before the shuffle."""
    cols = list(events.columns)
    rest = [c for c in cols if c != key]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]),
                    F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order]))
    return events.groupBy(key).agg(best.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def ccv_sweep(sessions: DataFrame, key: str = "content_id", start: str = "session_start",
              end: str = "session_end", bucket: str = "1 hour") -> DataFrame:
    """True concurrency by sweep (W7): +1 at each start, -1 at each end, a
    running sum per ``key`` over time (ends before starts at one instant).
    The running sum runs per (key, hour) with a carried offset. Returns each
    change point with the concurrency after it."""
    # equal starts (or ends) at one instant are one row in the window, and come apart again behind it
    net = _deltas(sessions, key, start, end).groupBy(key, "t", "delta").agg(F.count(F.lit(1)).alias("n"))
    run = running_agg(net, [key], [F.col("t"), F.col("delta")], F.col("delta") * F.col("n"), time_bucket("t", interval_seconds(bucket)), "after")
    each = run.select(key, "t", "delta", "after", "n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i"))
    return each.select(key, "t", "delta", (F.col("after") - F.col("delta") * (F.col("n") - F.col("i"))).alias("concurrent"))


def _deltas(sessions: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """+1 at each start, -1 at each end, from one pass over ``sessions``."""
    return sessions.select(key, F.inline(F.array(
        F.struct(F.col(start).alias("t"), F.lit(1).alias("delta")),
        F.struct(F.col(end).alias("t"), F.lit(-1).alias("delta")))))


def peak_concurrency(sessions: DataFrame, key: str = "content_id", start: str = "session_start",
                     end: str = "session_end", bucket: str = "1 hour") -> DataFrame:
    """Peak of the sweep per ``key`` without materialising it. Starts and ends
    are first netted per (key, instant), which combines before the shuffle, so
    a kick-off of any size is a few rows; ends count before starts at one
    instant, so the net is the instant's peak. The running sum runs per (key,
    hour), and the key's peak is max(local peak + net change of all earlier
    hours)."""
    net = _deltas(sessions, key, start, end).groupBy(key, "t").agg(F.sum("delta").alias("delta"))
    d = net.withColumn("_b", time_bucket("t", interval_seconds(bucket)))
    w = Window.partitionBy(key, "_b").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    per = d.withColumn("_run", F.sum("delta").over(w)).groupBy(key, "_b").agg(
        F.max("_run").alias("_peak"), F.sum("delta").alias("_net"))
    wc = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_carry", F.coalesce(F.sum("_net").over(wc), F.lit(0)))
    return per.groupBy(key).agg(F.max(F.col("_peak") + F.col("_carry")).alias("peak_concurrent"))


def lateness_profile(raw: DataFrame, ts: str = "event_ts", seq: str = "offset", part: str = "partition",
                     rows_per_bucket: int = 100_000) -> DataFrame:
    """Arrival lateness per record (W8): the running max of event time over
    earlier arrivals in the same source partition minus the record's own
    event time (0 when in order). Runs per offset range with carries."""
    bucket = F.floor(F.col(seq) / F.lit(rows_per_bucket)).cast("long")
    r = running_agg(raw, [part], [F.col(seq)], F.unix_micros(F.col(ts)), bucket, "_maxprev", how="max",
                    exclusive=True)
    late = F.greatest(F.lit(0.0), (F.col("_maxprev") - F.unix_micros(F.col(ts))) / F.lit(1_000_000.0))
    return r.withColumn("lateness_s", F.coalesce(late, F.lit(0.0))).drop("_maxprev")


def clock_skew(events: DataFrame, key: str = "session_id", ts: str = "timestamp", ingest: str = "ingest_ts",
               bucket: str = "1 second") -> DataFrame:
    """Per-session clock offset estimate: the exact lower median
    of ingest time minus event time, in ms, at any size. Equal lags are counted
    before the shuffle; the counts per lag bucket tell which bucket holds a
    session's median, and only that bucket's lags are ranked. Null lags count
    as events but take no part in the median (null if there is no other);
    events without a session form one group."""
    lag = F.unix_micros(ingest) - F.unix_micros(ts)
    counts = (events.groupBy(F.col(key).alias("_k"), lag.alias("_lag")).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_b", F.floor(F.col("_lag") / F.lit(interval_seconds(bucket) * 1_000_000))))
    per = counts.groupBy("_k", "_b").agg(F.sum("_n").alias("_all"), F.sum(F.when(F.col("_lag").isNotNull(), F.col("_n"))
                                                                          .otherwise(0)).alias("_timed"))
    whole = Window.partitionBy("_k")
    upto = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    per = per.select(F.col("_k").alias("_s"), F.col("_b").alias("_at"), (F.sum("_timed").over(upto) - F.col("_timed")).alias("_before"),
                     "_timed", F.ceil(F.sum("_timed").over(whole) / 2).alias("_rank"), F.sum("_all").over(whole).alias("_events"))
    # one bucket a session; where no lag is known, that of the nulls
    middle = per.where("_rank > _before and _rank <= _before + _timed or _rank = 0")
    held = counts.join(middle, F.col("_k").eqNullSafe(F.col("_s")) & F.col("_b").eqNullSafe(F.col("_at")))
    run = F.col("_before") + F.sum("_n").over(Window.partitionBy("_k").orderBy("_lag").rowsBetween(Window.unboundedPreceding, 0))
    return (held.withColumn("_run", run).groupBy(F.col("_k").alias(key))
            .agg((F.min(F.when(F.col("_run") >= F.col("_rank"), F.col("_lag"))) / F.lit(1000.0)).alias("offset_ms"),
                 F.first("_events").alias("events")))
