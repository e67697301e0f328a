"""Session quality from fragments, in batch and on streams.

A fragment is what one session did in one time bucket. It keeps a few figures that merge: first and last event, the stalls
that begin and end inside it, its runs between gaps, and what start-up needs. On a stream, a windowed aggregate holds the
times and types of a fragment's events until the watermark closes the bucket, so that state is bounded by a bucket of a
session and a session that never ends (or a bot) is spread over many keys. Merging looks at one row a fragment.

Events at one instant are ordered by type, as in ``sessions.stall_intervals``; a null time belongs to no fragment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.functions.columns import interval_seconds
from crowdpulse.operators.sessions import CLOSING_EVENTS

FRAGMENT_KEYS = ("fragment_start", "events", "first_ts", "first_type", "last_ts", "last_type", "stall_ms", "stalls", "closed", "started",
                 "heartbeat", "start_ts", "any_ts", "after_ts", "runs")


def _ms(a: Column, b: Column) -> Column:
    return (F.unix_micros(a) - F.unix_micros(b)) / F.lit(1000.0)


def session_fragments(events: DataFrame, bucket: str = "5 minutes", key: str | tuple[str, ...] = "session_id", ts: str = "timestamp",
                      gap: str = "30 minutes") -> DataFrame:
    """One row a (key, bucket). A stream needs a watermark; append mode emits a fragment once, when its bucket is closed."""
    keys = [key] if isinstance(key, str) else list(key)
    one = F.struct(F.col(ts).alias("t"), F.coalesce(F.col("event_type"), F.lit("")).alias("e"))
    held = events.groupBy(*keys, F.window(ts, bucket).alias("w")).agg(F.sort_array(F.collect_list(one)).alias("a"))
    a = F.col("a")
    gap_us = interval_seconds(gap) * 1_000_000
    stalled = F.filter(F.zip_with(a, F.slice(a, 2, F.size(a)), lambda x, y: F.struct(x.alias("x"), y.alias("y"))),
                       lambda p: (p["x"]["e"] == "buffer_start") & (p["y"]["e"] == "buffer_end"))
    starts = F.array_min(F.transform(F.filter(a, lambda x: x["e"] == "video_start"), lambda x: x["t"]))
    others = F.transform(F.filter(a, lambda x: (x["e"] != "video_start") & (x["e"] != "")), lambda x: x["t"])
    # places at which a run begins: the first event, and every one a gap or more behind the one before it
    begins = F.filter(F.sequence(F.lit(1), F.size(a)), lambda i: (i == 1) | (
        F.unix_micros(F.element_at(a, i)["t"]) - F.unix_micros(F.element_at(a, F.greatest(i - 1, F.lit(1)))["t"]) >= gap_us))
    ends = F.concat(F.slice(F.col("b"), 2, F.size("b")), F.array(F.size(a) + 1))

    def run(i: Column, j: Column) -> Column:
        own = F.slice(a, i, j - i)
        return F.struct(F.element_at(own, 1)["t"].alias("first"), F.element_at(own, -1)["t"].alias("last"), (j - i).cast("long").alias("events"),
                        F.exists(own, lambda x: x["e"].isin(*CLOSING_EVENTS)).alias("closed"))

    def any_of(*kinds: str) -> Column:
        return F.exists(a, lambda x: x["e"].isin(*kinds))

    first, last = F.element_at(a, 1), F.element_at(a, -1)
    stall_ms = F.aggregate(F.col("s"), F.lit(0.0), lambda acc, p: acc + _ms(p["y"]["t"], p["x"]["t"]))
    return (held.withColumns({"s": stalled, "b": begins, "start_ts": starts, "o": others})
            .select(*keys, F.col("w.start").alias("fragment_start"), F.size(a).cast("long").alias("events"),
                    first["t"].alias("first_ts"), first["e"].alias("first_type"), last["t"].alias("last_ts"), last["e"].alias("last_type"),
                    stall_ms.alias("stall_ms"), F.size("s").cast("long").alias("stalls"), any_of(*CLOSING_EVENTS).alias("closed"),
                    any_of("video_start").alias("started"), any_of("heartbeat").alias("heartbeat"), "start_ts",
                    F.array_min("o").alias("any_ts"), F.array_min(F.filter("o", lambda t: t >= F.col("start_ts"))).alias("after_ts"),
                    F.zip_with("b", ends, run).alias("runs")))


def session_qoe(fragments: DataFrame, key: str = "session_id") -> DataFrame:
    """Sessions from their fragments (SE1-SE4, W2): start, end, events, closed, watch_ms, stalls, stall_ms, rebuffer_ratio,
    startup_ms and exit_before_start. A stall over a bucket's end is found between neighbours: the one ends with a
    ``buffer_start`` and the next begins with a ``buffer_end``."""
    w = Window.partitionBy(key).orderBy("fragment_start")
    next_ts, next_type = F.lead("first_ts").over(w), F.lead("first_type").over(w)
    began = F.min("start_ts").over(Window.partitionBy(key))
    f = fragments.withColumns({"_nt": next_ts, "_ne": next_type, "_began": began})
    over = (F.col("last_type") == "buffer_start") & F.coalesce(F.col("_ne") == "buffer_end", F.lit(False))
    reply = F.when(F.col("start_ts") == F.col("_began"), F.col("after_ts")).when(F.col("fragment_start") > F.col("_began"), F.col("any_ts"))
    agg = f.groupBy(key).agg(
        F.min("first_ts").alias("start_ts"), F.max("last_ts").alias("end_ts"), F.sum("events").alias("events"), F.bool_or("closed").alias("closed"),
        F.sum(F.col("stalls") + over.cast("long")).alias("stalls"),
        F.sum(F.col("stall_ms") + F.when(over, _ms(F.col("_nt"), F.col("last_ts"))).otherwise(0.0)).alias("stall_ms"),
        F.min(reply).alias("_reply"), F.min("start_ts").alias("_start"),
        (F.bool_or("started") & ~F.bool_or("heartbeat")).alias("exit_before_start"))
    watch = _ms(F.col("end_ts"), F.col("start_ts"))
    return agg.select(key, "start_ts", "end_ts", "events", "closed", watch.alias("watch_ms"), "stalls", "stall_ms",
                      F.when(watch > 0, F.col("stall_ms") / watch).alias("rebuffer_ratio"),
                      _ms(F.col("_reply"), F.col("_start")).alias("startup_ms"), "exit_before_start")


def sessions_from_fragments(fragments: DataFrame, gap: str = "30 minutes", keys=("session_id",)) -> DataFrame:
    """Sessions split at ``gap``s, from the fragments' runs (ST6): a run goes on with the next one if that begins within the gap."""
    keys, gap_us = list(keys), interval_seconds(gap) * 1_000_000
    runs = fragments.select(*keys, F.inline("runs"))
    w = Window.partitionBy(*keys).orderBy("first")
    before = F.lag("last").over(w)
    new = (before.isNull() | (F.unix_micros("first") - F.unix_micros(before) >= gap_us)).cast("int")
    numbered = runs.withColumn("_new", new).withColumn("_n", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    end = F.max("last") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_us / 1e6))
    return numbered.groupBy(*keys, "_n").agg(F.min("first").alias("session_start"), end.alias("session_end"), F.sum("events").alias("events"),
                                             F.bool_or("closed").alias("closed")).drop("_n")
