"""Silver: dedupe, marker join, per-minute QoE cube.

Every function is DataFrame -> DataFrame and works on batch and streaming
input alike (the streaming wrappers in ``crowdpulse.streaming`` add
watermarks and sinks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdpulse.functions.columns import REGULAR_CONTENT, interval_seconds, ratio, round_dec
from crowdpulse.operators.broadcast import DEFAULT_MAX_BROADCAST_ROWS
from crowdpulse.operators.joins import ad_interval_join, asof_marker_join, label_ad_marker, marker_places
from crowdpulse.operators.sweep import event_lists, marker_lists, salted_event_lists, sweep_lists

UNKNOWN = "unknown"
SILVER_DIMS = ("region", "device", "cdn", "marker_id")


def dedupe_events(events: DataFrame, keys=("event_id", "timestamp")) -> DataFrame:
    """Distinct by key (U1). The reference key is (event_id, timestamp), so a
    re-send under the same id with a new timestamp survives (D13)."""
    return events.dropDuplicates(list(keys))


def _first_copies(events: DataFrame, keys, columns) -> DataFrame:
    """``dedupe_events`` for a batch that is read several times: of copies that differ, the one that sorts first stays, so every
    reading keeps the same. Only ``columns`` are carried."""
    rest = [c for c in columns if c not in keys]
    return events.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")


def _window_cols(ts: str, window: str, slide: str | None = None) -> Column:
    return F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)


def qoe_metrics(rebuffer_types=("buffer_start",), exact: bool = True, rsd: float = 0.05,
                session: str = "session_id") -> list[Column]:
    """The Silver measures (A2-A6). ``event_count``/``error_count`` keep the
    ratios re-weightable (A20)."""
    ccv = F.count_distinct(F.col(session)) if exact else F.approx_count_distinct(F.col(session), rsd)
    is_err = F.col("error_code").isNotNull()
    is_rebuf = F.col("event_type").isin(list(rebuffer_types))
    return [
        ccv.alias("ccv"),
        F.avg("bitrate_kbps").alias("_avg_bitrate"),
        F.avg("buffer_length_ms").alias("_avg_buffer"),
        F.count(F.lit(1)).alias("event_count"),
        F.sum(is_err.cast("long")).alias("error_count"),
        F.sum(is_rebuf.cast("long")).alias("_rebuffer_count"),
    ]


def _finish(agg: DataFrame, dims) -> DataFrame:
    return agg.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *dims,
        F.col("ccv").cast("long").alias("ccv"),
        round_dec("_avg_bitrate", 4).alias("avg_bitrate_kbps"),
        round_dec("_avg_buffer", 4).alias("avg_buffer_length_ms"),
        ratio("error_count", "event_count").alias("error_rate"),
        ratio("_rebuffer_count", "event_count").alias("rebuffering_ratio"),
        "event_count", "error_count",
    )


def _with_known_dims(labelled: DataFrame, dims) -> DataFrame:
    keyed = labelled
    for d in ("region", "device"):
        if d in dims:
            keyed = keyed.withColumn(d, F.coalesce(F.col(d), F.lit(UNKNOWN)))
    return keyed


def aggregate_qoe_salted(labelled: DataFrame, window: str = "1 minute", salt: str = "salt", *, ts: str = "timestamp",
                         dims=SILVER_DIMS, lg_k: int = 12, rebuffer_types=("buffer_start",)) -> DataFrame:
    """The QoE cube in two chained aggregates (ST4): a cell is first counted per salt, its sessions in an HLL sketch, and the
    few partial cells are then merged. On a stream no hot cell is one state row that every event updates; CCV is the merged
    sketch's estimate (standard error about 0.8 / sqrt(2^lg_k), 1.3 % at 12)."""
    is_rebuf = F.coalesce(F.col("event_type").isin(list(rebuffer_types)), F.lit(False))
    cells = _with_known_dims(labelled, dims).groupBy(F.window(ts, window).alias("cell"), *dims, salt).agg(
        F.hll_sketch_agg("session_id", lg_k).alias("sketch"), F.count(F.lit(1)).alias("n"), F.count("error_code").alias("e"),
        F.sum(is_rebuf.cast("long")).alias("r"),
        *[x for c, a in (("bitrate_kbps", "b"), ("buffer_length_ms", "l")) for x in (F.sum(c).alias(f"{a}s"), F.count(c).alias(f"{a}n"))])
    agg = cells.groupBy(F.window("cell", window).alias("window"), *dims).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("ccv"),
        ratio(F.sum("bs"), F.sum("bn")).alias("_avg_bitrate"), ratio(F.sum("ls"), F.sum("ln")).alias("_avg_buffer"),
        F.sum("n").alias("event_count"), F.sum("e").alias("error_count"), F.sum("r").alias("_rebuffer_count"))
    return _finish(agg, dims)


def aggregate_qoe(labelled: DataFrame, window: str = "1 minute", *, ts: str = "timestamp",
                  dims=SILVER_DIMS, exact: bool = True, rsd: float = 0.05,
                  rebuffer_types=("buffer_start",), slide: str | None = None) -> DataFrame:
    """Group by (event-time window, dims) and compute the QoE cube (A1).
    Null region/device become ``unknown`` so they can sit in a key (D15)."""
    agg = _with_known_dims(labelled, dims).groupBy(_window_cols(ts, window, slide).alias("window"), *dims).agg(
        *qoe_metrics(rebuffer_types, exact, rsd))
    return _finish(agg, dims)


def can_sweep(events: DataFrame, markers: DataFrame, window: str, span: str) -> bool:
    """``marker_cells`` adds and subtracts whole numbers on an axis of instants: the averaged columns must be integers, times
    timestamps, and window and span plain durations of at least a second."""
    try:
        if min(interval_seconds(window), interval_seconds(span)) < 1:
            return False
    except (KeyError, ValueError):
        return False
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    return (all(isinstance(events.schema[c].dataType, whole) for c in ("bitrate_kbps", "buffer_length_ms"))
            and all(isinstance(t, T.TimestampType) for t in (events.schema["timestamp"].dataType, markers.schema["wallclock"].dataType)))


#: Parts that a channel's window is dealt to, by region, device and CDN, so that a kick-off isn't one task.
SPREAD = 2


def marker_cells(events: DataFrame, markers: DataFrame, window: str, span: str, *, rebuffer_types=("buffer_start",),
                 bucket: str | None = None, label: str = REGULAR_CONTENT,
                 max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """The exact cube of ``ad_interval_join`` and ``aggregate_qoe`` without the joined rows, which grow with the square of a
    channel's traffic where spans overlap; work here grows with events, markers and the rows returned.

    All spans are equally long, so an event at t belongs to just the markers at [t - span, t], and these stand in a row once
    the markers of a (channel, window) are numbered by time. Per (channel, window, region, device, cdn) the events are steps
    up and down along these numbers; running sums give what holds from one step to the next, and only then is a row made for
    each marker there. A session counts once: its event at t, the one before at p, counts only for markers after p.

    Markers repeated exactly are counted with their number. Ids that stand at several places, and rows without an id (they
    fall to ``label``), share cells: events in their spans are joined pair by pair. Events in no span are aggregated as ``label``.

    Events and markers meet in one exchange, which all parts read: its columns are the same whatever the caller drops. A marker
    is sent to each window that its span reaches, ``SPREAD`` times, not to each cell; the markers whose spans reach a window of
    a channel are one array."""
    size, reach = interval_seconds(window) * 1_000_000, interval_seconds(span) * 1_000_000
    dims = ["region", "device", "cdn"]
    group = ["_win", "_channel", "_part"]     # never null: a join on them would ask that of some parts, and these would no longer share
    cell = [*group, *dims]
    # of the event's type and error code only what is counted: is it a rebuffer (null: no type), is there an error
    carried = ["session_id", "_rebuf", "bitrate_kbps", "buffer_length_ms", "_err"]
    places = marker_places(markers.where("channel IS NOT NULL AND wallclock IS NOT NULL"), label).withColumn("_w", F.unix_micros("wallclock"))

    # events, and markers (``_m`` copies of them; 0 where ids are shared) in each window that their span reaches
    spots = places.select("channel", "_w", F.when(F.col("_one"), F.col("marker_id").cast("string")).alias("_id"),
                          F.when(F.col("_one"), F.col("_copies")).otherwise(0).alias("_m"))
    wins = F.expr(f"sequence(_w - pmod(_w, {size}), _w + {reach} - pmod(_w + {reach}, {size}), {size}L)")
    channel = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("")).alias("_channel")
    spots = spots.select(F.explode(wins).alias("_win"), channel("channel"), "_w", "_id", "_m")
    spots = spots.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    ev = _with_known_dims(events.where(F.col("timestamp").isNotNull()), dims).withColumns({
        "_t": F.unix_micros("timestamp"), "_rebuf": F.col("event_type").isin(list(rebuffer_types)), "_err": F.col("error_code").isNotNull()})
    ev = ev.select(F.expr(f"coalesce(_t - pmod(_t, {size}), 0L)").alias("_win"), channel("content_id"),
                   F.coalesce(F.pmod(F.xxhash64(*dims), F.lit(SPREAD)).cast("int"), F.lit(0)).alias("_part"), "_t", F.struct(*dims, *carried).alias("_row"), F.lit(None).cast("string").alias("_id"), F.lit(None).cast("long").alias("_m"))
    axis = ev.unionByName(spots.select(*group, F.col("_w").alias("_t"), F.lit(None).cast(ev.schema["_row"].dataType).alias("_row"), "_id", "_m"))
    axis = axis.repartition(*group)

    # numbers of the first marker of an event's span and of the first behind it; the same for places of shared ids
    along = Window.partitionBy(*group).orderBy("_t")
    upto, past = along.rangeBetween(Window.unboundedPreceding, Window.currentRow), along.rangeBetween(Window.unboundedPreceding, -reach - 1)
    one, many = F.count(F.when(F.col("_m") > 0, 1)), F.count(F.when(F.col("_m") == 0, 1))
    placed = axis.withColumns({"_hi": one.over(upto), "_lo": one.over(past), "_many": many.over(upto) - many.over(past)})
    # these filters name ``_row`` and ``_id`` whole, so that no part prunes its exchange otherwise than the others
    near = placed.where("_m IS NULL AND _id IS NULL AND _row IS NOT NULL").select(*group, "_t", "_hi", "_lo", "_many", "_row.*")
    marks = placed.where("_m > 0 AND _row IS NULL").groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct("_hi", "_id", "_m"))).alias("_marks"))

    # the rest of the cube, as joined rows
    rows = [*dims, "timestamp", "session_id", "event_type", "bitrate_kbps", "buffer_length_ms", "error_code"]
    timed = near.withColumns({"timestamp": F.timestamp_micros("_t"), "event_type": F.col("_rebuf").cast("string"), "error_code": F.when(F.col("_err"), "E")})
    plain = timed.where("_hi = _lo AND _many = 0").select(*rows, F.lit(label).alias("marker_id"))
    copies = places.where("NOT _one").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(
        *[F.col(c).alias(c, metadata={}) for c in ("marker_id", "channel", "wallclock")])   # new columns: events met these before
    both = timed.where("_many > 0").select(*rows, F.expr("CASE WHEN _many > 0 THEN substring(_channel, 2) END").alias("content_id"))
    pairs = ad_interval_join(both, copies, span, bucket=bucket, max_broadcast_rows=max_broadcast_rows).where("channel IS NOT NULL")
    rest = plain.unionByName(pairs.select(*rows, F.coalesce("marker_id", F.lit(label)).alias("marker_id")))

    # steps of events along the markers' numbers, and what holds between them
    sums = {"n": F.lit(1), "e": F.col("_err").cast("long"), "r": F.coalesce(F.col("_rebuf").cast("long"), F.lit(0)),
            "rn": F.col("_rebuf").isNotNull().cast("long"), "bs": F.coalesce("bitrate_kbps", F.lit(0)), "bn": F.col("bitrate_kbps").isNotNull().cast("long"),
            "ls": F.coalesce("buffer_length_ms", F.lit(0)), "ln": F.col("buffer_length_ms").isNotNull().cast("long")}
    before = F.lag("_hi").over(Window.partitionBy(*cell, "session_id").orderBy("_t"))
    new = F.when(F.col("session_id").isNull(), F.col("_hi")).otherwise(F.greatest("_lo", F.coalesce(before, "_lo")))
    moves = near.withColumn("_new", new).where("_lo < _hi")
    step = lambda at, sign, ccv: F.struct(F.col(at).alias("_at"), F.lit(sign).cast("long").alias("_sign"), ccv.cast("long").alias("ccv"))
    counts = (F.col("_new") < F.col("_hi")).cast("long")
    steps = F.array(step("_lo", 1, F.when(F.col("_new") == F.col("_lo"), counts).otherwise(0)), step("_hi", -1, -counts),
                    F.when((F.col("_new") > F.col("_lo")) & (F.col("_new") < F.col("_hi")), step("_new", 0, F.lit(1))))
    up = moves.select(*cell, *[c.cast("long").alias(k) for k, c in sums.items()], F.explode(F.filter(steps, lambda s: s.isNotNull())).alias("_s"))
    up = up.select(*cell, "_s._at", "_s.ccv", *[(F.col("_s._sign") * F.col(k)).alias(k) for k in sums])
    order = Window.partitionBy(*cell).orderBy("_at")
    total = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = up.select(*cell, "_at", F.lead("_at").over(order).alias("_next"), *[F.sum(k).over(total).alias(k) for k in ("ccv", *sums)])
    held = held.where("n > 0 AND _next > _at").join(marks.hint("shuffle_hash"), group)
    each = held.withColumn("_i", F.explode(F.sequence("_at", F.col("_next") - 1))).withColumn("_mark", F.get("_marks", F.col("_i").cast("int")))
    read = each.where("_mark._m > 0").select("_win", *dims, F.col("_mark._id").alias("marker_id"), F.col("_mark._m").alias("_m"), "ccv", *sums)
    marked = read.select(
        F.struct(F.timestamp_micros("_win").alias("start"), F.timestamp_micros(F.col("_win") + size).alias("end")).alias("window"), *dims, "marker_id", "ccv",
        ratio("bs", "bn").alias("_avg_bitrate"), ratio("ls", "ln").alias("_avg_buffer"), (F.col("n") * F.col("_m")).alias("event_count"),
        (F.col("e") * F.col("_m")).alias("error_count"), F.when(F.col("rn") > 0, F.col("r") * F.col("_m")).alias("_rebuffer_count"))
    return aggregate_qoe(rest, window, rebuffer_types=("true",)).unionByName(_finish(marked, SILVER_DIMS))


def list_cells(events: DataFrame, markers: DataFrame, window: str, span: str, delay: str | None = None, *,
               rebuffer_types=("buffer_start",), label: str = REGULAR_CONTENT, salts: int | None = None) -> DataFrame:
    """``marker_cells`` for streams, in append mode: events and markers are collected per window as the watermark passes it,
    joined by window, and counted from these lists (``operators.sweep``). ``events`` carry a watermark; ``delay`` is that of a
    stream of markers (None: a batch table).

    With ``salts``, events carry one as ``salt``: they are collected per salt first, and a window's cells are dealt to as many
    parts of the join, each of which has the window's markers."""
    size = interval_seconds(window) * 1_000_000
    known, marks, on = _with_known_dims(events, SILVER_DIMS), marker_lists(markers, window, span, delay), ["window"]
    if salts is None:
        lists = event_lists(known, window, rebuffer_types=rebuffer_types)
    else:
        lists = salted_event_lists(known, window, rebuffer_types=rebuffer_types).withColumn("salted", F.pmod(F.xxhash64("region", "device", "cdn"), F.lit(salts)).cast("int"))
        marks = marks.withColumn("salted", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = ["window", "salted"]
    read = sweep_lists(lists, marks, window, span, label, on)
    agg = read.select(
        F.struct(F.timestamp_micros("_win").alias("start"), F.timestamp_micros(F.col("_win") + size).alias("end")).alias("window"), *SILVER_DIMS, "ccv",
        ratio("bs", "bn").alias("_avg_bitrate"), ratio("ls", "ln").alias("_avg_buffer"), F.col("n").alias("event_count"),
        F.col("e").alias("error_count"), F.when(F.col("rn") > 0, F.col("r")).alias("_rebuffer_count"))
    return _finish(agg, SILVER_DIMS)


def silver_qoe(events: DataFrame, markers: DataFrame, window: str = "1 minute", span: str = "2 minutes", *,
               exact: bool = True, rsd: float = 0.05, rebuffer_types=("buffer_start",),
               dedupe_keys=("event_id", "timestamp"), break_types=None, asof: bool = False,
               bucket: str | None = None, label: str = REGULAR_CONTENT,
               max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Flagship per-minute cube (A1): dedupe -> left interval join to markers ->
    label -> windowed aggregate.

    Defaults follow the reference (2 min inclusive span, fan-out on overlap,
    exact-duplicate dedupe) except CCV, which is exact by default (A3);
    ``exact=False`` gives the HLL++ estimate (A2). ``asof=True`` assigns each
    event only its latest marker (J4); ``break_types`` filters markers (D4).
    The exact cube comes from ``marker_cells``, which counts the join's rows
    without making them.
    """
    columns = ("event_id", "session_id", "timestamp", "event_type", "content_id", "region", "device",
               "cdn", "bitrate_kbps", "buffer_length_ms", "error_code")
    if dedupe_keys and not events.isStreaming:
        ev = _first_copies(events, dedupe_keys, columns).select(*columns)
    else:
        ev = (dedupe_events(events, dedupe_keys) if dedupe_keys else events).select(*columns)
    mk = markers.select("marker_id", "channel", "wallclock", "break_type")
    if break_types is not None:
        mk = mk.where(F.col("break_type").isin(list(break_types)))
    mk = mk.drop("break_type")
    if asof:
        joined = asof_marker_join(ev, mk, span, bucket=bucket, max_broadcast_rows=max_broadcast_rows)
    elif exact and can_sweep(ev, mk, window, span):
        return marker_cells(ev, mk, window, span, rebuffer_types=rebuffer_types, bucket=bucket, label=label,
                            max_broadcast_rows=max_broadcast_rows)
    else:
        joined = ad_interval_join(ev, mk, span, bucket=bucket, max_broadcast_rows=max_broadcast_rows)
    labelled = label_ad_marker(joined, label)
    return aggregate_qoe(labelled, window, exact=exact, rsd=rsd, rebuffer_types=rebuffer_types)


def ccv_exact(events: DataFrame, window: str = "1 minute", dims=(), ts: str = "timestamp",
              session: str = "session_id") -> DataFrame:
    """Exact distinct sessions per window (A3)."""
    return events.groupBy(F.window(ts, window).alias("w"), *dims).agg(
        F.count_distinct(session).alias("ccv")).select(
        F.col("w.start").alias("window_start"), *dims, "ccv")


def ccv_approx(events: DataFrame, window: str = "1 minute", dims=(), rsd: float = 0.05,
               ts: str = "timestamp", session: str = "session_id") -> DataFrame:
    """HLL++ distinct sessions per window (A2)."""
    return events.groupBy(F.window(ts, window).alias("w"), *dims).agg(
        F.approx_count_distinct(session, rsd).alias("ccv")).select(
        F.col("w.start").alias("window_start"), *dims, "ccv")


def ccv_sketches(events: DataFrame, window: str = "1 minute", dims=("region", "device", "cdn"),
                 ts: str = "timestamp", session: str = "session_id", lg_k: int = 12) -> DataFrame:
    """Per-cell HLL sketches, so CCV can be rolled up to any coarser grain
    without the double counting of summed cells (D6)."""
    return events.groupBy(F.window(ts, window).alias("w"), *dims).agg(
        F.hll_sketch_agg(session, lg_k).alias("ccv_sketch")).select(
        F.col("w.start").alias("window_start"), *dims, "ccv_sketch")


def rollup_sketches(sketches: DataFrame, by=("window_start",)) -> DataFrame:
    """Union cell sketches to a coarser grain and estimate distinct sessions."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("ccv_sketch")).alias("ccv"))


def rebuffer_rolling5(events: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                      rebuffer_types=("buffer_start",), ts: str = "timestamp") -> DataFrame:
    """Sliding rebuffer share per CDN (ST5), in batch and (behind a watermark, append mode) on streams.

    Events are counted once, into panes as long as the slide; only the panes, a row per slide and CDN, are copied into
    the windows over them. ``window`` must be a multiple of ``slide``."""
    if interval_seconds(window) % interval_seconds(slide):
        raise ValueError(f"{window} is not a multiple of {slide}")
    is_rebuf = F.coalesce(F.col("event_type").isin(list(rebuffer_types)), F.lit(False))
    panes = events.groupBy(F.window(ts, slide).alias("pane"), "cdn").agg(
        F.count(F.lit(1)).alias("n"), F.sum(is_rebuf.cast("long")).alias("r"))
    agg = panes.groupBy(F.window("pane", window, slide).alias("w"), "cdn").agg(
        F.sum("n").alias("event_count"), F.sum("r").alias("rebuffer_count"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cdn",
                      "event_count", "rebuffer_count",
                      ratio("rebuffer_count", "event_count").alias("rebuffer_ratio"))
