"""Panes, salted Silver, fresh markers and session fragments: streams against plain batch results."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from media_rows import EVENT_DDL, MARKER_DDL, ev, mk, ts
from crowdpulse.operators import sessions as SE
from crowdpulse.operators.fragments import session_fragments, session_qoe, sessions_from_fragments
from crowdpulse.operators.silver import aggregate_qoe_salted, rebuffer_rolling5, silver_qoe
from crowdpulse.session import scratch_path
from crowdpulse.streaming.markers import silver_with_fresh_markers
from crowdpulse.streaming.pipeline import dedupe_stream, silver_stream_salted, start_to_parquet


def _put(spark, rows, ddl, path):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)


def _types(seed, n, span=7200, sessions=4):
    rnd = random.Random(seed)
    kinds = ["heartbeat", "buffer_start", "buffer_end", "video_start", "video_end", "error", None]
    rows = [ev(f"e{i}", rnd.uniform(0, span), rnd.choice(kinds), f"s{rnd.randint(0, sessions - 1)}", cdn=rnd.choice(["cdn-a", "cdn-b"])) for i in range(n)]
    # ties: several events of a session at one instant, some on the edge of a bucket
    return rows + [ev(f"t{i}", 600.0 * (i % 5), rnd.choice(kinds[:-1]), "s0") for i in range(20)]


def test_rolling_share_over_panes_equals_sliding_windows(spark):
    df = spark.createDataFrame(_types(1, 300), EVENT_DDL)
    got = rebuffer_rolling5(df, "5 minutes", "1 minute")
    want = df.groupBy(F.window("timestamp", "5 minutes", "1 minute").alias("w"), "cdn").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("event_type") == "buffer_start").cast("long")), F.lit(0)).alias("r"))
    assert sorted(got.select("window_start", "cdn", "event_count", "rebuffer_count").collect()) == sorted(
        want.select("w.start", "cdn", "n", "r").collect())
    with pytest.raises(ValueError):
        rebuffer_rolling5(df, "5 minutes", "2 minutes")


def test_events_are_not_copied_into_sliding_windows(spark):
    """The five copies are made of panes, above the first aggregate; nothing between the scan and it multiplies rows."""
    plan = rebuffer_rolling5(spark.createDataFrame(_types(1, 10), EVENT_DDL))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    expand = [i for i, line in enumerate(plan) if "Expand" in line or "Generate" in line]
    first = max(i for i, line in enumerate(plan) if "Aggregate" in line)
    assert expand and all(i < first for i in expand)


def test_rolling_stream_equals_batch(spark):
    root, rows = scratch_path(spark, "t-rolling"), _types(2, 200)
    for part in (rows[::2], rows[1::2] + rows[:5], [ev("zz", 10 ** 6)]):
        _put(spark, part, EVENT_DDL, f"{root}/in")
    stream = dedupe_stream(spark.readStream.schema(EVENT_DDL).parquet(f"{root}/in"))
    start_to_parquet(rebuffer_rolling5(stream), f"{root}/out", f"{root}/ck").awaitTermination()
    got = spark.read.parquet(f"{root}/out").where(F.col("window_start") < F.lit(ts(9000)))
    assert sorted(got.collect()) == sorted(rebuffer_rolling5(spark.createDataFrame(rows, EVENT_DDL)).collect())


def test_salted_stream_equals_batch_and_spreads_the_hot_channel(spark):
    root = scratch_path(spark, "t-salted")
    rows = [ev(f"e{i}", (i % 240) * 1.5, session=f"s{i % 97}", err="E1" if i % 9 == 0 else None, bitrate=i % 7 if i % 5 else None) for i in range(900)]
    rows += [ev("n1", 5.0, content=None), ev("n2", 5.0, session=None, region=None)]
    for part in (rows, rows[:40], [ev("zz", 10 ** 6, content="ch-9")]):
        _put(spark, part, EVENT_DDL, f"{root}/ev")
    markers = [mk("m1", 30), mk("m2", 100), mk("m3", 10, channel="ch-2"), mk("m4", 3, channel=None)]
    _put(spark, markers + [mk("zz", 10 ** 6, channel="ch-9")], MARKER_DDL, f"{root}/mk")
    es, ms = (spark.readStream.schema(d).parquet(f"{root}/{p}") for d, p in ((EVENT_DDL, "ev"), (MARKER_DDL, "mk")))
    out = silver_stream_salted(es, ms, salts=8)
    start_to_parquet(out, f"{root}/out", f"{root}/ck").awaitTermination()
    got = spark.read.parquet(f"{root}/out").where(F.col("window_start") < F.lit(ts(9000)))
    want = silver_qoe(spark.createDataFrame(rows, EVENT_DDL), spark.createDataFrame(markers, MARKER_DDL))
    assert sorted(got.drop("ccv").collect(), key=str) == sorted(want.drop("ccv").collect(), key=str)
    exact = {tuple(r[:6]): r.ccv for r in want.collect()}
    assert all(abs(r.ccv - exact[tuple(r[:6])]) <= max(1, 0.06 * exact[tuple(r[:6])]) for r in got.collect())
    # the plan joins by the salted channel, and counts partial cells by salt before it merges them
    plan = silver_stream_salted(*(spark.read.schema(d).parquet(f"{root}/{p}") for d, p in ((EVENT_DDL, "ev"), (MARKER_DDL, "mk"))), salts=8) \
        ._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "salted" in join and sum("Aggregate [" in line and "salt#" in line and "sketch" in line for line in plan.splitlines()) == 1


def test_salted_cells_with_no_values(spark):
    df = spark.createDataFrame([ev("a", 1, bitrate=None, buf=None, session=None)], EVENT_DDL).withColumn("salt", F.lit(0)).withColumn("marker_id", F.lit("x"))
    r = aggregate_qoe_salted(df).first()
    assert (r.ccv, r.avg_bitrate_kbps, r.avg_buffer_length_ms, r.event_count) == (0, None, None, 1)


def test_markers_that_arrive_while_the_stream_runs(spark):
    root = scratch_path(spark, "t-fresh")
    rows = [ev(f"e{i}", i * 10.0, session=f"s{i % 5}") for i in range(90)]
    _put(spark, [], MARKER_DDL, f"{root}/mk")
    _put(spark, rows[:20], EVENT_DDL, f"{root}/in")
    stream = dedupe_stream(spark.readStream.schema(EVENT_DDL).parquet(f"{root}/in"))

    def start(trigger):
        return silver_with_fresh_markers(stream, lambda: spark.read.schema(MARKER_DDL).parquet(f"{root}/mk"), f"{root}/out", f"{root}/held", f"{root}/ck",
                                         hold="3 minutes", trigger=trigger)

    query = start({"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
        _put(spark, [mk("m1", 30)], MARKER_DDL, f"{root}/mk")             # after the events it covers, within the hold
        _put(spark, rows[20:50] + rows[15:20], EVENT_DDL, f"{root}/in")   # some events again
        query.processAllAvailable()
        _put(spark, [mk("m2", 300)], MARKER_DDL, f"{root}/mk")
    finally:
        query.stop()
    _put(spark, rows[50:], EVENT_DDL, f"{root}/in")                       # a restart goes on with the events that wait
    start(None).awaitTermination()
    _put(spark, [ev("zz", 10 ** 6, cdn="zz")], EVENT_DDL, f"{root}/in")
    start(None).awaitTermination()
    got = spark.read.parquet(f"{root}/out").drop("batch_id").where("cdn <> 'zz'")
    want = silver_qoe(spark.createDataFrame(rows, EVENT_DDL), spark.createDataFrame([mk("m1", 30), mk("m2", 300)], MARKER_DDL))
    assert sorted(got.collect()) == sorted(want.collect())
    assert {"m1", "m2"} <= {r.marker_id for r in got.collect()}


def _qoe_by_plain_windows(spark, df):
    w = Window.partitionBy("session_id").orderBy("timestamp", F.coalesce("event_type", F.lit("")))
    n = df.withColumn("nt", F.lead("timestamp").over(w)).withColumn("ne", F.lead("event_type").over(w))
    return {r.session_id: (r.stalls, round(r.ms, 6)) for r in n.groupBy("session_id").agg(
        F.sum(F.when((F.col("event_type") == "buffer_start") & (F.col("ne") == "buffer_end"), 1).otherwise(0)).alias("stalls"),
        F.sum(F.when((F.col("event_type") == "buffer_start") & (F.col("ne") == "buffer_end"),
                     (F.unix_micros("nt") - F.unix_micros("timestamp")) / 1000.0).otherwise(0.0)).alias("ms")).collect()}


@pytest.mark.parametrize("bucket", ["1 minute", "10 minutes", "1 day"])
def test_fragments_merge_into_the_batch_figures(spark, bucket):
    df = spark.createDataFrame(_types(4, 250), EVENT_DDL)
    qoe = {r.session_id: r for r in session_qoe(session_fragments(df, bucket)).collect()}
    assert {s: (r.stalls, round(r.stall_ms, 6)) for s, r in qoe.items()} == _qoe_by_plain_windows(spark, df)
    for r in SE.session_summary(df).collect():
        own = qoe[r.session_id]
        assert (own.start_ts, own.end_ts, own.events, own.closed) == (r.start_ts, r.end_ts, r.events, bool(r.closed))
    assert {r.session_id: r.startup_ms for r in SE.video_startup_time(df).collect()} == {s: r.startup_ms for s, r in qoe.items() if r.startup_ms is not None}
    share = SE.exit_before_start(df).first()
    assert sum(bool(r.exit_before_start) for r in qoe.values()) == share.exits_before_start
    got = sessions_from_fragments(session_fragments(df, bucket, gap="4 minutes"), "4 minutes")
    assert sorted(got.collect()) == sorted(SE.sessionise(df.fillna("", ["event_type"]), "4 minutes").collect())


def test_fragment_stream_with_late_and_repeated_events(spark):
    root, rows = scratch_path(spark, "t-fragments"), sorted(_types(6, 200), key=lambda r: r[2])
    late = ev("late", 1.0, "buffer_start", "s1")
    for part in (rows[:120], rows[100:] + [late], [ev("zz", 10 ** 6, session="zz")]):
        _put(spark, part, EVENT_DDL, f"{root}/in")
        stream = dedupe_stream(spark.readStream.schema(EVENT_DDL).parquet(f"{root}/in"))
        start_to_parquet(session_fragments(stream, "5 minutes"), f"{root}/out", f"{root}/ck").awaitTermination()
    got = session_qoe(spark.read.parquet(f"{root}/out").where("session_id <> 'zz'"))
    want = session_qoe(session_fragments(spark.createDataFrame(rows, EVENT_DDL), "1 hour"))  # the late event is not in it
    assert sorted(got.collect()) == sorted(want.collect())


def test_no_events(spark):
    none = spark.createDataFrame([], EVENT_DDL)
    assert session_qoe(session_fragments(none)).count() == 0 and sessions_from_fragments(session_fragments(none)).count() == 0
    assert rebuffer_rolling5(none).count() == 0
