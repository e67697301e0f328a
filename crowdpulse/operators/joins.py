"""Event-to-marker joins.

Open-source Spark has no range-join strategy, so the interval predicate
``channel = content_id AND wallclock <= ts <= wallclock + span`` is run as an
equi-join on ``(channel, time bucket)`` with the range test as a residual:
each marker is exploded into the few buckets its span touches, each event
falls in exactly one bucket. A live broadcast is one hot channel; the bucket
splits it by time, so no single join key holds the whole broadcast, and AQE's
skew-join split handles a hot bucket. The marker side is broadcast only behind
a size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.functions.columns import REGULAR_CONTENT, interval_seconds
from crowdpulse.operators.broadcast import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_small

BKT = "_bkt"


def _bucket_of(ts: Column, bucket_s: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(bucket_s * 1_000_000)).cast("long")


def _seconds(x) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), x)


def _bucketed_left_join(events: DataFrame, markers: DataFrame, end: Column, bucket_s: int, *,
                        ts: str, key: str, end_inclusive: bool, max_broadcast_rows: int | None,
                        keep_bucket: bool = False, max_buckets: int = 2) -> DataFrame:
    """events LEFT JOIN markers ON key = channel AND wallclock <= ts <= / < end."""
    mcols = [c for c in markers.columns if c not in events.columns]
    src = markers.select("channel", *[c for c in mcols if c != "channel"])
    m = (src
         .withColumn("_end", end)
         .withColumn(BKT, F.explode(F.sequence(_bucket_of(F.col("wallclock"), bucket_s),
                                               _bucket_of(F.col("_end"), bucket_s))))
         .withColumnRenamed("channel", "_channel"))
    m = broadcast_if_small(m, max_broadcast_rows, size_of=src, expansion=max_buckets + 1)
    e = events.withColumn(BKT, _bucket_of(F.col(ts), bucket_s))
    upper = (e[ts] <= m["_end"]) if end_inclusive else (e[ts] < m["_end"])
    cond = (e[key] == m["_channel"]) & (e[BKT] == m[BKT]) & (e[ts] >= m["wallclock"]) & upper
    out = e.join(m, cond, "left")
    keep = [e[c] for c in events.columns]
    keep += [(m["_channel"].alias("channel") if c == "channel" else m[c]) for c in mcols]
    if keep_bucket:
        keep.append(e[BKT])
    return out.select(*keep)


def ad_interval_join(events: DataFrame, markers: DataFrame, span: str = "2 minutes", *,
                     ts: str = "timestamp", key: str = "content_id", bucket: str | None = None,
                     break_types: tuple[str, ...] | None = None,
                     max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
                     keep_bucket: bool = False) -> DataFrame:
    """Left-outer interval join, batch or stream-static (J1 predicate, J2).

    Both bounds are inclusive. Overlapping markers fan an event out into one
    row per marker (D3). ``break_types`` keeps only those markers (D4).
    """
    span_s = interval_seconds(span)
    if break_types is not None:
        markers = markers.where(F.col("break_type").isin(list(break_types)))
    end = F.col("wallclock") + _seconds(F.lit(span_s))
    bucket_s = interval_seconds(bucket) if bucket else max(span_s, 1)
    return _bucketed_left_join(events, markers, end, bucket_s, ts=ts, key=key, end_inclusive=True,
                               max_broadcast_rows=max_broadcast_rows, keep_bucket=keep_bucket,
                               max_buckets=span_s // bucket_s + 1)


def with_previous(events: DataFrame, *, ts: str = "timestamp", key: str = "content_id") -> DataFrame:
    """``events`` with ``_before``: the time at which the same event id came before on its channel (a re-send, D13)."""
    alone = F.when(F.col("event_id").isNull(), F.col(ts))      # rows without an id are no group
    return events.withColumn("_before", F.lag(ts).over(Window.partitionBy("event_id", key, alone).orderBy(ts)))


def marker_places(markers: DataFrame, label: str = REGULAR_CONTENT) -> DataFrame:
    """Markers by place: ``_copies`` of a row delivered repeatedly, and ``_one``, whether its id stands nowhere else and isn't
    ``label``, to which rows without an id fall."""
    places = markers.groupBy("marker_id", "channel", "wallclock").agg(F.count(F.lit(1)).alias("_copies"))
    same = Window.partitionBy("marker_id", F.when(F.col("marker_id").isNull(), F.col("wallclock")))
    one = (F.count(F.lit(1)).over(same) == 1) & F.coalesce(F.col("marker_id") != F.lit(label), F.lit(False))
    return places.withColumn("_one", one)


def count_per_marker(joined: DataFrame, *, ts: str = "timestamp") -> DataFrame:
    """Events, distinct event ids, first and last time of each marker, over the labelled join of ``with_previous`` events and
    ``marker_places``. An id counts for a marker at one place where it comes first in the span, so that these pairs are added
    up before the shuffle; only ids of markers at several places, and of events without a marker, are told apart behind it."""
    one = F.coalesce(F.col("_one"), F.lit(False))
    first = one & F.col("event_id").isNotNull() & F.coalesce(F.col("_before") < F.col("wallclock"), F.lit(True))
    return joined.groupBy("marker_id").agg(
        F.sum(F.coalesce("_copies", F.lit(1).cast("long"))).alias("n_events"),
        (F.sum(first.cast("long")) + F.count_distinct(F.when(~one, F.col("event_id")))).alias("n_ids"),
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


#: A node of one level has 2^BITS nodes of the level below; so many levels cover all timestamps in buckets of a second.
BITS, LEVELS = 4, 11
#: Longest span that is told from an endless one, in seconds (126,000 years).
MAX_SPAN_S = 4 * 10 ** 12


def span_pieces(start: str, end: str) -> Column:
    """array<struct<level, node>> of the aligned intervals that make up the buckets ``start`` to ``end`` (names of long columns,
    both included): node n of level l is buckets n * 16^l to (n + 1) * 16^l - 1, as in dyadic intervals, but sixteenfold. At
    most 30 a level and 11 levels, whatever the length; a span of a few buckets is just these. Empty if end < start."""
    def low(l: str) -> str:
        return f"-shiftright(-`{start}`, {BITS} * ({l}))"

    def high(l: str) -> str:
        return f"shiftright(`{end}` + 1, {BITS} * ({l}))"

    none, up, top = "CAST(array() AS array<bigint>)", f"({low('l + 1')}) * {1 << BITS}", f"({high('l + 1')}) * {1 << BITS}"
    nodes = f"""CASE WHEN {low('l')} >= {high('l')} THEN {none} WHEN {low('l + 1')} >= {high('l + 1')} THEN sequence({low('l')}, {high('l')} - 1)
        ELSE concat(CASE WHEN {low('l')} < {up} THEN sequence({low('l')}, {up} - 1) ELSE {none} END,
                    CASE WHEN {top} < {high('l')} THEN sequence({top}, {high('l')} - 1) ELSE {none} END) END"""
    return F.expr(f"flatten(transform(sequence(0, {LEVELS - 1}), l -> transform({nodes}, n -> struct(l AS level, n AS node))))")


def span_left_join(events: DataFrame, spans: DataFrame, start: Column, end: Column, *, ts: str, key: Column, span_key: Column,
                   bucket_s: int, max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """events LEFT JOIN spans ON key = span_key AND start <= ts < end (``start`` and ``end`` in microseconds), for spans of any
    length. The columns of ``spans`` come in a struct ``_span``, null where nothing matches.

    A span is cut into aligned intervals of buckets (``span_pieces``), at most 30 on each of 11 levels whatever its length; the
    spans of a (key, interval) are one row. An event looks its bucket up once on each level that occurs among the spans
    (the levels are read first), so it is never copied before it matches; short spans need one level."""
    us = bucket_s * 1_000_000
    s = spans.select(span_key.alias("_sk"), start.cast("long").alias("_s"), end.cast("long").alias("_e"), F.struct(*spans.columns).alias("_row"))
    s = s.where("_s < _e AND _sk IS NOT NULL").withColumns({"_a": F.expr(f"(_s - pmod(_s, {us})) div {us}"), "_z": F.expr(f"(_e - 1 - pmod(_e - 1, {us})) div {us}")})
    cells = s.select("_sk", F.struct("_s", "_e", "_row").alias("_m"), F.inline(span_pieces("_a", "_z"))).groupBy("_sk", "level", "node").agg(
        F.collect_list("_m").alias("_in"))
    levels = sorted(r[0] for r in cells.select("level").distinct().collect())
    t = F.unix_micros(ts)
    out = events.withColumns({"_k": key, "_t": t}).withColumn("_b", F.expr(f"(_t - pmod(_t, {us})) div {us}"))
    found = []
    for n in levels:
        side = cells.where(F.col("level") == n).select(F.col("_sk").alias(f"_k{n}"), F.col("node").alias(f"_n{n}"), F.col("_in").alias(f"_in{n}"))
        side = broadcast_if_small(side, max_broadcast_rows, size_of=spans, expansion=30 * len(levels))
        out = out.join(side, (F.col("_k") == F.col(f"_k{n}")) & (F.shiftright("_b", BITS * n) == F.col(f"_n{n}")), "left")
        found.append(F.coalesce(f"_in{n}", F.array().cast(cells.schema["_in"].dataType)))
    if not levels:
        return events.withColumn("_span", F.lit(None).cast(s.schema["_row"].dataType))
    held = F.filter(F.concat(*found), lambda m: (m["_s"] <= F.col("_t")) & (F.col("_t") < m["_e"]))
    return out.select(*[F.col(f"`{c}`") for c in events.columns], F.explode_outer(held).alias("_m")).select(
        *[F.col(f"`{c}`") for c in events.columns], F.col("_m._row").alias("_span"))


def span_us(seconds: Column) -> Column:
    """A duration in microseconds: null and negative ones are empty, those beyond ``MAX_SPAN_S`` are cut to it."""
    whole = F.least(F.greatest(F.coalesce(seconds.cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(float(MAX_SPAN_S)))
    return F.round(whole * 1_000_000).cast("long")


def ad_break_join(events: DataFrame, markers: DataFrame, *, ts: str = "timestamp", key: str = "content_id",
                  bucket: str = "5 minutes", break_types: tuple[str, ...] | None = ("commercial",),
                  max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Interval bounded by each marker's own break length (J3): ``wallclock <= ts < wallclock + duration_s``, whatever the
    length. A null, negative or zero duration matches nothing, one of over 126,000 years counts as that. Only ``break_types``
    markers count (default commercial, D4). Markers are a batch table."""
    if break_types is not None:
        markers = markers.where(F.col("break_type").isin(list(break_types)))
    start = F.unix_micros("wallclock")
    joined = span_left_join(events, markers, start, start + span_us(F.col("duration_s")), ts=ts, key=F.col(key), span_key=F.col("channel"),
                            bucket_s=interval_seconds(bucket), max_broadcast_rows=max_broadcast_rows)
    added = ["channel", *[c for c in markers.columns if c not in events.columns and c != "channel"]]
    return joined.select(*events.columns, *[F.col(f"_span.`{c}`").alias(c) for c in added])


def asof_marker_join(events: DataFrame, markers: DataFrame, span: str = "2 minutes", *,
                     ts: str = "timestamp", key: str = "content_id", bucket: str | None = None,
                     max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """As-of join (J4): each event row gets the latest marker at or before it,
    within ``span`` (ties on wallclock go to the greatest marker_id). Overlap
    no longer fans out (D3); exact duplicate input rows stay duplicated.

    Overlap is resolved on the marker side, which is small: of markers at one
    instant the greatest id stays, and a span ends where the channel's next
    marker begins (times are whole microseconds, so an inclusive end is an
    exclusive one a microsecond later). Events are only joined, never sorted
    or ranked.
    """
    span_s = interval_seconds(span)
    bucket_s = interval_seconds(bucket) if bucket else max(span_s, 1)
    one = markers.groupBy("channel", "wallclock").agg(F.max("marker_id").alias("marker_id"))
    following = F.lead("wallclock").over(Window.partitionBy("channel").orderBy("wallclock"))
    full = F.col("wallclock") + _seconds(F.lit(span_s)) + F.expr("INTERVAL 1 MICROSECOND")
    spans = one.withColumn("_until", F.least(full, F.coalesce(following, full)))
    joined = _bucketed_left_join(events, spans, F.col("_until"), bucket_s, ts=ts, key=key, end_inclusive=False,
                                 max_broadcast_rows=max_broadcast_rows, max_buckets=span_s // bucket_s + 2)
    return joined.drop("_until")


def label_ad_marker(joined: DataFrame, default: str = REGULAR_CONTENT, col: str = "marker_id",
                    out: str = "marker_id") -> DataFrame:
    """Null marker becomes the regular-content label."""
    return joined.withColumn(out, F.coalesce(F.col(col), F.lit(default)))
