"""The Silver cube without joined rows equals the one over joined rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from crowdpulse.operators import joins, silver

T0 = dt.datetime(2024, 1, 1)
EVENT = ("event_id string, session_id string, timestamp timestamp, event_type string, content_id string, region string, device string, "
         "cdn string, bitrate_kbps int, buffer_length_ms int, error_code string")
MARKER = "marker_id string, channel string, wallclock timestamp, break_type string"


def rows(spark, seed):
    r = random.Random(seed)

    def at():     # coarse and fine times, so that bounds are met exactly
        return T0 + dt.timedelta(seconds=r.randrange(600)) + dt.timedelta(microseconds=r.choice([0, 0, 1, 999_999]))

    pick = lambda *v: r.choice(v)
    events = [(f"e{i}", pick("s1", "s2", "s3", "s4", None), pick(at(), at(), at(), at(), None), pick("buffer_start", "heartbeat", None), pick("a", "b", None),
               pick("N", None), pick("tv", None), pick("x", "y", None), pick(1, 7, None), pick(3, None), pick("E1", None, None)) for i in range(400)]
    events += events[:50]
    markers = [(f"m{i}", pick("a", "b", "c"), at(), "commercial") for i in range(25)]
    markers += markers[:5] + markers[:2]                                                   # exact replays
    markers += [("m7", "a", at(), "commercial"), ("m8", "b", at(), "commercial"), ("m8", "a", at(), "blackout")]   # an id at several places
    markers += [(None, "a", at(), "commercial"), ("conteudo_regular", "b", at(), "commercial"), ("m90", None, at(), None), ("m91", "a", None, None)]
    return spark.createDataFrame(events, EVENT), spark.createDataFrame(markers, MARKER)


def joined_cube(events, markers, window, span):
    pairs = joins.ad_interval_join(silver.dedupe_events(events), markers.drop("break_type"), span)
    return silver.aggregate_qoe(joins.label_ad_marker(pairs), window)


@pytest.mark.parametrize("seed, window, span", [(1, "1 minute", "2 minutes"), (2, "1 minute", "90 seconds"), (3, "5 minutes", "20 seconds")])
def test_cells_equal_the_joined_cube(spark, seed, window, span):
    events, markers = rows(spark, seed)
    assert silver.can_sweep(events, markers, window, span)
    want, got = joined_cube(events, markers, window, span), silver.silver_qoe(events, markers, window, span)
    assert got.columns == want.columns and got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_joined_rows_of_unique_markers(spark):
    """A dense channel: the only range join left gets markers that share cells, here none."""
    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 120)
    events = spark.range(3000).select(
        F.concat(F.lit("e"), "id").alias("event_id"), (F.col("id") % 7).cast("string").alias("session_id"), ts.alias("timestamp"),
        F.lit("heartbeat").alias("event_type"), F.lit("a").alias("content_id"), F.lit("N").alias("region"), F.lit("tv").alias("device"),
        F.lit("x").alias("cdn"), F.lit(1).alias("bitrate_kbps"), F.lit(2).alias("buffer_length_ms"), F.lit(None).cast("string").alias("error_code"))
    markers = spark.range(300).select(F.concat(F.lit("m"), "id").alias("marker_id"), F.lit("a").alias("channel"),
                                      F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 120).alias("wallclock"), F.lit(None).cast("string").alias("break_type"))
    seen = []
    kept = silver.ad_interval_join

    def counted(ev, mk, *a, **kw):
        seen.append(mk.count())
        return kept(ev, mk, *a, **kw)

    silver.ad_interval_join = counted
    try:
        cube = silver.silver_qoe(events, markers, "1 minute", "2 minutes")
    finally:
        silver.ad_interval_join = kept
    got = cube.agg(F.sum("event_count"), F.max("ccv")).first()
    want = joined_cube(events, markers, "1 minute", "2 minutes").agg(F.sum("event_count"), F.max("ccv")).first()
    assert got == want and seen == [0]


def test_the_cube_reads_one_exchange(spark, tmp_path):
    """The dedupe and the exchange by cell run once for all parts of the cube."""
    events, markers = rows(spark, 4)
    events.write.parquet(f"{tmp_path}/events")
    markers.write.parquet(f"{tmp_path}/markers")
    cube = silver.silver_qoe(spark.read.parquet(f"{tmp_path}/events"), spark.read.parquet(f"{tmp_path}/markers"), "1 minute", "2 minutes")
    cube.collect()
    plan = cube._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    made = [line for line in plan.splitlines() if "Exchange" in line and "Reused" not in line]
    assert sum("hashpartitioning(event_id" in line for line in made) == 1
    assert sum("hashpartitioning(_win" in line and "REPARTITION_BY_COL" in line for line in made) == 1


def made_exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "Exchange" in line and "Reused" not in line]


def test_a_cube_with_dropped_columns_reads_one_exchange(spark, tmp_path):
    """Whoever drops columns of the cube still makes its exchange and its dedupe once."""
    events, markers = rows(spark, 5)
    events.write.parquet(f"{tmp_path}/events")
    markers.write.parquet(f"{tmp_path}/markers")
    read = lambda: silver.silver_qoe(spark.read.parquet(f"{tmp_path}/events"), spark.read.parquet(f"{tmp_path}/markers"), "1 minute", "2 minutes")
    for some in (read().groupBy("window_start").agg(F.sum("ccv")), read().groupBy("window_start", "cdn").agg(F.avg("error_rate"))):
        made = made_exchanges(some)
        assert sum("hashpartitioning(event_id" in line for line in made) == 1
        assert sum("REPARTITION_BY_COL" in line for line in made) == 1


def test_markers_meet_events_once_a_window(spark):
    """Markers are not joined with the cells before the exchange: it takes them once a window and part, however many regions,
    devices and CDNs there are."""
    events, markers = rows(spark, 6)
    plan = silver.silver_qoe(events, markers, "1 minute", "2 minutes")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    found = 0
    for i, line in enumerate(plan):
        if "RepartitionByExpression" in line:
            found += 1
            below = plan[i + 1:i + 1 + next((n for n, x in enumerate(plan[i + 1:]) if depth(x) <= depth(line)), len(plan))]
            assert below and not [x for x in below if " Join " in x.replace("- Join", "- Join ") and "_win" in x]
    assert found
