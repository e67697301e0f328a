from datetime import datetime

import pytest
from pyspark.sql import functions as F

from crowdpulse import schemas
from crowdpulse.operators.quality import QualityError
from crowdpulse.session import scratch_path
from crowdpulse.sinks.writers import copy_table, gold_publish, gold_write_partitioned, write_valid_and_dlq
from crowdpulse.sources.readers import jsonl_to_parquet, publish_jsonl, read_jdbc_table, read_jsonl
from crowdpulse.operators.quality import validate_contract
from crowdpulse.sources.contracts import MARKER_CONTRACT

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
GOLD_DDL = ("window_start timestamp, marker_id string, content_title string, genre string, advertiser_name string, "
            "region string, device string, cdn string, ccv long, total_revenue_brl double, avg_bitrate_kbps double, "
            "error_rate double")
STRS = ("marker_id VARCHAR(64), content_title VARCHAR(64), genre VARCHAR(64), advertiser_name VARCHAR(64), "
        "region VARCHAR(16), device VARCHAR(16), cdn VARCHAR(16)")


def _gold(spark, rev=1.0):
    rows = [(datetime(2024, 1, d, 12, 0), "m1", "T", "G", "A", "SE", "web", "cdn-a", 5, rev, 1000.0, 0.01)
            for d in (1, 2)]
    return spark.createDataFrame(rows, GOLD_DDL)


def test_jsonl_publish_and_parquet(spark):
    root = scratch_path(spark, "t-jsonl")
    lines = ['{"marker_id":"m1","channel":"ch-1","wallclock":"2024-01-01T00:00:05.000Z","duration_s":60,'
             '"break_type":"commercial","pts_time":450000}', "   ",
             '{"marker_id":"m2","channel":"ch-2","wallclock":"2024-01-01T00:01:00.000Z","duration_s":30,'
             '"break_type":"blackout","pts_time":5400000}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{root}/src")
    publish_jsonl(spark, f"{root}/src", "file", {"path": f"{root}/drop"})       # blank line skipped
    assert spark.read.text(f"{root}/drop").count() == 2
    jsonl_to_parquet(spark, f"{root}/drop", f"{root}/pq", schemas.SCTE35_MARKER)
    got = {r.marker_id: (r.wallclock, r.pts_time) for r in spark.read.parquet(f"{root}/pq").collect()}
    assert got["m1"] == (datetime(2024, 1, 1, 0, 0, 5), 450000)
    pruned = read_jsonl(spark, f"{root}/drop", "marker_id string, duration_s int")
    assert pruned.columns == ["marker_id", "duration_s"]


def test_gold_partitioned_rewrite_is_idempotent(spark):
    path = scratch_path(spark, "t-gold") + "/gold"
    gold_write_partitioned(_gold(spark), path)
    gold_write_partitioned(_gold(spark), path)
    gold_write_partitioned(_gold(spark).where(F.dayofmonth("window_start") == 2), path)  # only day 2 replaced
    df = spark.read.parquet(path)
    assert df.count() == 2 and df.select("event_date").distinct().count() == 2


def test_jdbc_publish_read_copy(spark):
    url = "jdbc:derby:memory:crowdpulse_t;create=true"
    gold_publish(_gold(spark), url, "GOLD", DERBY, string_columns=STRS)
    back = read_jdbc_table(spark, url, "GOLD", DERBY)
    assert back.count() == 2
    parts = read_jdbc_table(spark, url, "GOLD", DERBY,
                            {"column": "CCV", "lowerBound": 0, "upperBound": 10, "numPartitions": 2})
    assert parts.count() == 2
    copy_table(spark, {"url": url, "table": "GOLD", "properties": DERBY},
               {"url": url, "table": "GOLD_COPY", "properties": DERBY})
    assert read_jdbc_table(spark, url, "GOLD_COPY", DERBY).count() == 2
    with pytest.raises(QualityError):                       # gate: negative revenue is never published
        gold_publish(_gold(spark, rev=-1.0), url, "GOLD", DERBY, string_columns=STRS)
    assert read_jdbc_table(spark, url, "GOLD", DERBY).count() == 2


def test_dlq_stream_sink(spark):
    root = scratch_path(spark, "t-dlq")
    good = ('{"marker_id":"m1","channel":"c","splice_command":"s","event_id_scte":1,"out_of_network":true,'
            '"pts_time":1,"wallclock":"2024-01-01T00:00:00.000Z","duration_s":60,"break_type":"commercial"}')
    spark.createDataFrame([(good,), (good.replace('"duration_s":60', '"duration_s":"x"'),), ("{",)],
                          "value string").write.text(f"{root}/in")
    s = validate_contract(spark.readStream.text(f"{root}/in"), MARKER_CONTRACT)
    write_valid_and_dlq(s, f"{root}/valid", f"{root}/dlq", f"{root}/ck", trigger=None).awaitTermination()
    assert spark.read.parquet(f"{root}/valid").count() == 1
    reasons = sorted(r.reason for r in spark.read.parquet(f"{root}/dlq").collect())
    assert reasons == ["malformed_json", "type:duration_s"]


def test_malformed_time_does_not_stop_the_feed(spark):
    from crowdpulse.sources.parse import filter_required, parse_player_events
    body = '{"event_id":"%s","session_id":"s","timestamp":"%s","event_type":"heartbeat","content_id":"c","cdn":"a"}'
    raw = spark.createDataFrame([(body % ("a", "2024-01-01T10:00:00.000Z"),), (body % ("b", "yesterday"),)], "value string").selectExpr(
        "CAST(value AS BINARY) AS value", "current_timestamp() AS timestamp")
    assert [r.event_id for r in filter_required(parse_player_events(raw)).collect()] == ["a"]
