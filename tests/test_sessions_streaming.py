import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from media_rows import EVENT_DDL, MARKER_DDL, ev, mk, ts
from crowdpulse.operators import sessions as SE
from crowdpulse.operators.running import running_agg, time_bucket
from crowdpulse.session import scratch_path
from crowdpulse.streaming.pipeline import backfill, dedupe_stream, late_rows, silver_stream, start_to_parquet
from crowdpulse.operators.silver import silver_qoe


def test_session_closing_rules(spark):
    rows = [ev("1", 0, "video_start", "a"), ev("2", 10, "video_end", "a"),
            ev("3", 0, "video_start", "b"), ev("4", 10, "error", "b", err="E"),
            ev("5", 0, "video_start", "c"), ev("6", 10, "heartbeat", "c")]
    got = {r.session_id: r.closed for r in SE.session_summary(spark.createDataFrame(rows, EVENT_DDL)).collect()}
    assert got == {"a": True, "b": True, "c": False}


def test_stalls_across_bucket_boundaries_match_plain_lead(spark):
    rnd = random.Random(3)
    types = ["heartbeat", "buffer_start", "buffer_end"]
    rows = [ev(f"e{i}", rnd.uniform(0, 7200), rnd.choice(types), f"s{rnd.randint(0, 3)}") for i in range(400)]
    df = spark.createDataFrame(rows, EVENT_DDL)
    got = sorted((r.session_id, r.stall_start, r.stall_ms) for r in SE.stall_intervals(df, bucket="5 minutes").collect())
    w = Window.partitionBy("session_id").orderBy("timestamp", "event_type")
    plain = df.withColumn("nt", F.lead("timestamp").over(w)).withColumn("ny", F.lead("event_type").over(w)) \
        .where((F.col("event_type") == "buffer_start") & (F.col("ny") == "buffer_end"))
    want = sorted((r.session_id, r.timestamp, (r.nt - r.timestamp).total_seconds() * 1000) for r in plain.collect())
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert all(abs(x[2] - y[2]) < 1e-6 for x, y in zip(got, want))


def test_running_agg_with_carry_equals_single_partition(spark):
    rnd = random.Random(5)
    rows = [(f"k{rnd.randint(0, 2)}", ts(rnd.uniform(0, 10000)), rnd.randint(-3, 5)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int").dropDuplicates(["k", "t"])
    got = running_agg(df, ["k"], [F.col("t")], "v", time_bucket("t", 600), "run")
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("run", F.sum("v").over(w))
    assert sorted(got.collect()) == sorted(want.collect())
    gmax = running_agg(df, ["k"], [F.col("t")], "v", time_bucket("t", 600), "m", how="max", exclusive=True)
    wmax = df.withColumn("m", F.max("v").over(Window.partitionBy("k").orderBy("t").rowsBetween(
        Window.unboundedPreceding, -1)))
    assert sorted(gmax.collect()) == sorted(wmax.collect())


def test_ccv_sweep_true_concurrency(spark):
    s = spark.createDataFrame([("c", ts(0), ts(100)), ("c", ts(50), ts(150)), ("c", ts(100), ts(200))],
                              "content_id string, session_start timestamp, session_end timestamp")
    assert SE.peak_concurrency(s).first().peak_concurrent == 2   # the end at 100 is applied before the start


def test_peak_concurrency_with_carries_equals_plain_sweep(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(300):  # one hot channel over many hour buckets, and a cold one
        start = rnd.uniform(0, 40000)
        rows.append((rnd.choice(["hot"] * 9 + ["cold"]), ts(start), ts(start + rnd.uniform(0, 9000))))
    s = spark.createDataFrame(rows, "content_id string, session_start timestamp, session_end timestamp")
    got = {r.content_id: r.peak_concurrent for r in SE.peak_concurrency(s, bucket="1 hour").collect()}
    d = s.select("content_id", F.col("session_start").alias("t"), F.lit(1).alias("delta")).unionByName(
        s.select("content_id", F.col("session_end").alias("t"), F.lit(-1).alias("delta")))
    w = Window.partitionBy("content_id").orderBy("t", "delta").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.content_id: r.p for r in d.withColumn("c", F.sum("delta").over(w)).groupBy("content_id")
            .agg(F.max("c").alias("p")).collect()}
    assert got == want
    per_row = SE.ccv_sweep(s, bucket="1 hour").groupBy("content_id").agg(F.max("concurrent").alias("p"))
    assert {r.content_id: r.p for r in per_row.collect()} == want


def test_global_dedupe_keeps_first_copy(spark):
    rows = [ev("a", 13, bitrate=2), ev("a", 10, bitrate=1), ev("b", 5)]
    got = {r.event_id: r.bitrate_kbps for r in SE.global_dedupe(spark.createDataFrame(rows, EVENT_DDL)).collect()}
    assert got == {"a": 1, "b": 1000}


def _write(spark, rows, ddl, path):
    spark.createDataFrame(rows, ddl).write.mode("append").parquet(path)


def test_stream_equals_batch(spark):
    root = scratch_path(spark, "t-stream")
    rows = [ev(f"e{i}", i * 7.0, session=f"s{i % 5}", content="ch-1") for i in range(60)]
    rows += [ev("e3", 21.0, session="s3")]                   # exact duplicate
    markers = [mk("m1", 30), mk("m2", 200)]
    _write(spark, rows[:30], EVENT_DDL, f"{root}/ev")
    _write(spark, rows[30:], EVENT_DDL, f"{root}/ev")
    _write(spark, markers, MARKER_DDL, f"{root}/mk")
    sentinel_e, sentinel_m = [ev("zz", 100000, content="ch-9")], [mk("zz", 100000, channel="ch-9")]
    _write(spark, sentinel_e, EVENT_DDL, f"{root}/ev")
    _write(spark, sentinel_m, MARKER_DDL, f"{root}/mk")
    es = spark.readStream.schema(EVENT_DDL).parquet(f"{root}/ev")
    ms = spark.readStream.schema(MARKER_DDL).parquet(f"{root}/mk")
    q = start_to_parquet(silver_stream(es, ms, "1 minute", "2 minutes"), f"{root}/out", f"{root}/ck")
    q.awaitTermination()
    got = spark.read.parquet(f"{root}/out").where(F.col("window_start") < F.lit(ts(90000))).drop("ccv")
    batch = silver_qoe(spark.createDataFrame(rows, EVENT_DDL), spark.createDataFrame(markers, MARKER_DDL),
                       "1 minute", "2 minutes").drop("ccv")
    assert sorted(got.collect()) == sorted(batch.collect())


def test_late_row_is_dropped_by_the_stream_and_found_in_bronze(spark):
    root = scratch_path(spark, "t-late")
    for batch in ([ev("a", 1000), ev("b", 1010)], [ev("c", 100), ev("d", 1020)]):   # c is ~15 min late
        _write(spark, batch, EVENT_DDL, f"{root}/in")
        src = spark.readStream.schema(EVENT_DDL).parquet(f"{root}/in")
        start_to_parquet(dedupe_stream(src), f"{root}/out", f"{root}/ck").awaitTermination()
    processed = spark.read.parquet(f"{root}/out")
    assert sorted(r.event_id for r in processed.collect()) == ["a", "b", "d"]
    assert [r.event_id for r in late_rows(spark.read.parquet(f"{root}/in"), processed).collect()] == ["c"]


def test_silver_stream_goes_on_after_a_restart(spark):
    root = scratch_path(spark, "t-restart")
    rows = [ev(f"e{i}", i * 7.0, session=f"s{i % 5}", content="ch-1") for i in range(60)]
    _write(spark, [mk("m1", 30)], MARKER_DDL, f"{root}/mk")
    markers = spark.read.schema(MARKER_DDL).parquet(f"{root}/mk")
    for part in (rows[:30], rows[25:] + [ev("zz", 100000, content="ch-9")]):    # the restart is handed some rows again
        _write(spark, part, EVENT_DDL, f"{root}/ev")
        es = spark.readStream.schema(EVENT_DDL).parquet(f"{root}/ev")
        start_to_parquet(silver_stream(es, markers, "1 minute", "2 minutes", static_markers=True), f"{root}/out", f"{root}/ck").awaitTermination()
    got = spark.read.parquet(f"{root}/out").where(F.col("window_start") < F.lit(ts(90000))).drop("ccv")
    want = silver_qoe(spark.createDataFrame(rows, EVENT_DDL), markers, "1 minute", "2 minutes").drop("ccv")
    # rows 25-29 come back behind the watermark or as duplicates: neither may count twice
    assert sorted(got.collect()) == sorted(want.collect())


def test_backfill_of_two_hours_keeps_the_day(spark):
    import json
    from datetime import timedelta

    root = scratch_path(spark, "t-backfill")

    def raw(eid, hour, ingest_s=0):
        t = ts(0).replace(hour=0) + timedelta(hours=hour)
        body = json.dumps({"event_id": eid, "session_id": "s", "timestamp": t.isoformat() + ".000Z", "event_type": "heartbeat",
                           "content_id": "ch-1", "cdn": "cdn-a"})
        return body.encode(), t + timedelta(seconds=ingest_s)

    rows = [raw("a", 1), raw("b", 10.5), raw("c", 11.5, 3 * 3600), raw("d", 10, -10), raw("e", 23)]
    bronze = spark.createDataFrame(rows, "value binary, timestamp timestamp")
    bronze.withColumn("event_date", F.to_date("timestamp")).write.partitionBy("event_date").parquet(f"{root}/bronze")
    markers = spark.createDataFrame([], MARKER_DDL)
    day = ts(0).date().isoformat()
    full = sorted(backfill(spark, f"{root}/bronze", f"{root}/silver", markers).collect())
    assert len(full) == 5
    part = backfill(spark, f"{root}/bronze", f"{root}/silver", markers, f"{day} 10:00:00", f"{day} 12:00:00")
    assert sorted(part.collect()) == full


def test_batch_sessionise_equals_session_window_on_hot_key(spark):
    rnd = random.Random(11)
    rows = [ev(f"e{i}", rnd.choice([rnd.uniform(0, 20000), float(rnd.randint(0, 50)) * 400]),
               rnd.choice(["heartbeat", "error"]), rnd.choice(["hot"] * 8 + ["s2", "s3"])) for i in range(600)]
    df = spark.createDataFrame(rows, EVENT_DDL)
    got = SE.sessionise(df, "10 minutes", bucket="20 minutes")
    sw = df.groupBy("session_id", F.session_window("timestamp", "10 minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.max(F.col("event_type").isin("video_end", "error")).alias("closed"))
    want = sw.select("session_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                     "events", "closed")
    assert sorted(got.collect()) == sorted(want.collect())


def test_clock_offset_is_the_exact_lower_median(spark):
    rnd = random.Random(9)
    lags = {"hot": [rnd.randint(-5_000_000, 5_000_000) for _ in range(3000)] + [7] * 1500,
            "even": [1, 2, 3_000_000, 4_000_000], "one": [-12], "ties": [5, 5, 5, 9], "none": [None, None], None: [1_000_000, None, 2_000_000]}
    rows = [(s, n) for s, values in lags.items() for n in values]
    df = spark.createDataFrame(rows, "session_id string, lag long").select(
        "session_id", F.timestamp_micros(F.lit(1_700_000_000_000_000)).alias("timestamp"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("lag")).alias("ingest_ts"))
    got = {r.session_id: (r.offset_ms, r.events) for r in SE.clock_skew(df).collect()}
    known = {s: sorted(n for n in values if n is not None) for s, values in lags.items()}
    assert got == {s: (v[(len(v) - 1) // 2] / 1000 if v else None, len(lags[s])) for s, v in known.items()}
    assert SE.clock_skew(df.limit(0)).count() == 0


def test_clock_offset_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "lags")
    spark.range(2000).select((F.col("id") % 7).cast("string").alias("session_id"), F.timestamp_micros("id").alias("timestamp"),
                             F.timestamp_micros(F.col("id") * 3).alias("ingest_ts")).write.parquet(path)
    skew = SE.clock_skew(spark.read.parquet(path))
    skew.collect()
    assert "percentile" not in skew._jdf.queryExecution().optimizedPlan().toString()
    assert "ReusedExchange" in skew._jdf.queryExecution().executedPlan().toString()
