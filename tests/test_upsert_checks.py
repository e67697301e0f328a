import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from media_rows import EVENT_DDL, MARKER_DDL, ev, mk, ts
from crowdpulse.operators.quality import COMPLETENESS_KEYS
from crowdpulse.operators.silver import silver_qoe
from crowdpulse.operators.slo import slo_freshness
from crowdpulse.session import scratch_path
from crowdpulse.sinks.writers import create_table, read_upserted, silver_upsert


def _silver(spark):
    events = spark.createDataFrame([ev(f"e{i}", i * 7.0, session=f"s{i % 5}") for i in range(30)], EVENT_DDL)
    return silver_qoe(events, spark.createDataFrame([mk("m1", 30)], MARKER_DDL), "1 minute", "2 minutes")


def test_default_checks_hold_on_silver_rows_and_stop_a_null_key(spark):
    root, keys = scratch_path(spark, "t-upsert-checks"), list(COMPLETENESS_KEYS)
    _silver(spark).write.parquet(f"{root}/in")
    stored = spark.read.parquet(f"{root}/in")

    def run():
        stream = spark.readStream.schema(stored.schema).parquet(f"{root}/in")
        silver_upsert(stream, f"{root}/t", f"{root}/ck", keys, trigger="availableNow").awaitTermination()

    run()
    held = sorted(read_upserted(spark, f"{root}/t").select(*stored.columns).collect())
    assert held == sorted(stored.collect()) and held
    rows = [{**r.asDict(), "region": None} for r in stored.limit(1).collect()]
    spark.createDataFrame(rows, stored.schema).write.mode("append").parquet(f"{root}/in")
    with pytest.raises(StreamingQueryException, match="silver_keys failed .1 rows"):
        run()
    assert sorted(read_upserted(spark, f"{root}/t").select(*stored.columns).collect()) == held


def test_streams_in_turn_versions_and_replays(spark):
    root = scratch_path(spark, "t-upsert")

    def deliver(feed, rows, **kw):
        spark.createDataFrame(rows, "key string, v int, note string").write.mode("append").parquet(f"{root}/{feed}")
        s = spark.readStream.schema("key string, v int, note string").parquet(f"{root}/{feed}")
        silver_upsert(s, f"{root}/t{len(kw)}", f"{root}/ck-{feed}-{len(kw)}", ["key"], rules={}, trigger=None, parts=4, **kw).awaitTermination()
        return {r.key: (r.v, r.note) for r in read_upserted(spark, f"{root}/t{len(kw)}").collect()}

    # two streams write one key in turn: the last written row stays, or the greatest version
    assert deliver("a", [("k", 1, "a")]) == {"k": (1, "a")}
    assert deliver("b", [("k", 2, "b"), ("j", 5, "b")]) == {"k": (2, "b"), "j": (5, "b")}
    assert deliver("a", [("k", 1, "again"), (None, 3, "null key")]) == {"k": (1, "again"), "j": (5, "b"), None: (3, "null key")}
    assert deliver("a", []) == {"k": (1, "again"), "j": (5, "b"), None: (3, "null key")}
    # by version: a new checkpoint replays both feeds, copies in a batch and an older row later change nothing
    want = {"k": (1, "again"), None: (3, "null key")}
    assert deliver("a", [], version=["v"]) == want
    assert deliver("b", [("k", 0, "late")], version=["v"]) == {"k": (2, "b"), "j": (5, "b"), None: (3, "null key")}


def test_a_table_before_its_first_batch_and_explicit_columns(spark):
    root = scratch_path(spark, "t-upsert-empty")
    spark.createDataFrame([], "key string, v int").write.parquet(f"{root}/in")
    s = spark.readStream.schema("key string, v int").parquet(f"{root}/in")
    silver_upsert(s, f"{root}/t", f"{root}/ck", ["key"], rules={}, trigger=None).awaitTermination()
    create_table(spark, f"{root}/u", "window_start timestamp, cdn string, ccv bigint")
    assert spark.read.parquet(f"{root}/u").dtypes == [("window_start", "timestamp"), ("cdn", "string"), ("ccv", "bigint")]
    spark.createDataFrame([(ts(0), "a", 1)], "window_start timestamp, cdn string, ccv bigint").write.mode("append").parquet(f"{root}/u")
    create_table(spark, f"{root}/u", "window_start timestamp, cdn string, ccv bigint")
    assert spark.read.parquet(f"{root}/u").count() == 1


def test_only_touched_partitions_are_rewritten(spark):
    root = scratch_path(spark, "t-upsert-parts")

    def deliver(rows):
        spark.createDataFrame(rows, "key int, v int").write.mode("append").parquet(f"{root}/in")
        s = spark.readStream.schema("key int, v int").parquet(f"{root}/in")
        silver_upsert(s, f"{root}/t", f"{root}/ck", ["key"], rules={}, trigger=None, parts=8).awaitTermination()
        return {r.f for r in spark.read.parquet(f"{root}/t").select(F.input_file_name().alias("f")).distinct().collect()}

    before = deliver([(i, 0) for i in range(100)])
    after = deliver([(3, 1)])
    assert len(before) == len(after) == 8 and len(before - after) == 1


def test_emission_is_stamped_where_it_is_written(spark):
    root, keys = scratch_path(spark, "t-stamp"), list(COMPLETENESS_KEYS)
    _silver(spark).write.parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    for name, clock, within in (("late", None, 0), ("soon", F.col("window_end") + F.expr("INTERVAL 90 SECONDS"), None)):
        s = spark.readStream.schema(schema).parquet(f"{root}/in")
        silver_upsert(s, f"{root}/{name}", f"{root}/ck-{name}", keys, trigger=None, stamp="emitted_at", clock=clock).awaitTermination()
        r = slo_freshness(read_upserted(spark, f"{root}/{name}"), "window_end", "emitted_at", 120).first()
        assert r.within == (r.rows if within is None else within) and r.met == (within is None)


def test_latest_row_is_carried_once(spark):
    """A key's row goes through the exchange once, not as value and as order."""
    from crowdpulse.sinks.writers import latest_per_key
    df = spark.createDataFrame([("a", 1, "x", None), ("a", 2, "b", 3), ("a", 2, "b", 4), ("b", 5, None, 1), ("b", None, "z", 9)], "k string, v int, w string, n int")
    for version, want in (((), [("a", 2, "b", 4), ("b", 5, None, 1)]), (("w",), [("a", 1, "x", None), ("b", None, "z", 9)])):
        got = latest_per_key(df, ["k"], list(version))
        assert got.columns == df.columns and sorted(tuple(r) for r in got.collect()) == want
        assert got._jdf.queryExecution().optimizedPlan().toString().count("struct(") == 1
