"""Spans of any length, bitmap cells, date digests, nested drift, zone map, id-less decisions, swept points."""

import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from media_rows import EVENT_DDL, MARKER_DDL, ev, mk, ts
from crowdpulse.operators import gold as G
from crowdpulse.operators import serving as V
from crowdpulse.operators import sessions as SE
from crowdpulse.operators.joins import LEVELS, ad_break_join, span_pieces
from crowdpulse.operators.quality import nested_drift
from crowdpulse.operators.silver import ccv_approx, ccv_exact
from crowdpulse.operators.slo import slo_uniqueness
from crowdpulse.session import scratch_path
from crowdpulse.sources.readers import read_bronze
from crowdpulse.streaming.pipeline import backfill, dates_of, zone_map

LONG_MARKERS = "marker_id string, channel string, wallclock timestamp, duration_s long, break_type string"


@pytest.mark.parametrize("seed", [1, 2])
def test_pieces_cover_each_bucket_once(spark, seed):
    rnd = random.Random(seed)
    spans = [(i, a, a + rnd.choice([0, 1, 15, 16, 17, 300, 4097, 70_000])) for i, a in enumerate(rnd.randint(-5000, 5000) for _ in range(30))]
    rows = spark.createDataFrame(spans, "i int, a long, z long").select("i", "a", "z", F.inline(span_pieces("a", "z"))).collect()
    for i, a, z in spans:
        own = [(r.node << 4 * r.level, (r.node + 1 << 4 * r.level)) for r in rows if r.i == i]
        own.sort()
        assert own[0][0] == a and own[-1][1] == z + 1 and all(x[1] == y[0] for x, y in zip(own, own[1:]))
        assert len(own) <= 30 * LEVELS


def test_breaks_of_any_length(spark):
    rows = [mk("m1", 0, duration=45), mk("m2", 30, duration=10 ** 12), mk("m3", 10, duration=-5), mk("m4", 10, duration=None), mk("m5", 10, duration=0),
            mk("m6", 0, duration=2 * 10 ** 9), mk("m7", 5, channel="ch-2", duration=9 * 10 ** 18), mk("m8", 5, channel=None, duration=60), mk("m9", 5, duration=3, kind="blackout")]
    rows += [mk(f"r{i}", random.Random(i).uniform(0, 9000), duration=random.Random(i).choice([1, 600, 86_400])) for i in range(40)]
    markers = spark.createDataFrame(rows, LONG_MARKERS)
    events = [ev(f"e{i}", i * 37.0, content=["ch-1", "ch-2", None][i % 3]) for i in range(300)] + [ev("far", 10 ** 9)]
    got = ad_break_join(spark.createDataFrame(events, EVENT_DDL), markers)

    def inside(e, m):
        return (m[4] == "commercial" and e[4] is not None and e[4] == m[1] and (m[3] or 0) > 0
                and 0 <= (e[2] - m[2]).total_seconds() < m[3])

    want = sorted((e[0], m[0] if m else None) for e in events for m in ([m for m in rows if inside(e, m)] or [None]))
    assert sorted(((r.event_id, r.marker_id) for r in got.collect()), key=str) == sorted(want, key=str)
    assert got.columns == [c.split()[0] for c in EVENT_DDL.split(", ")] + ["channel", "marker_id", "wallclock", "duration_s", "break_type"]
    assert ad_break_join(spark.createDataFrame(events, EVENT_DDL), markers.limit(0)).count() == len(events)


def test_versions_without_end(spark):
    v = spark.createDataFrame([(" c ", "t1", "g", ts(0)), ("c", "t2", "g", ts(100)), ("c", "t3", "g", ts(10 ** 7))],
                              "content_id string, title string, genre string, updated_at timestamp")
    facts = spark.createDataFrame([("c", ts(-1)), ("c", ts(0)), ("c ", ts(99)), ("c", ts(100)), ("c", ts(10 ** 9)), ("x", ts(5)), (None, ts(5))], "content_id string, timestamp timestamp")
    got = G.scd2_content_join(facts, v)
    assert sorted(((r.content_id, r.timestamp, r.content_title) for r in got.collect()), key=str) == sorted(
        [("c", ts(-1), None), ("c", ts(0), "t1"), ("c ", ts(99), "t1"), ("c", ts(100), "t2"), ("c", ts(10 ** 9), "t3"), ("x", ts(5), None), (None, ts(5), None)], key=str)


def test_cells_count_sessions_exactly_at_every_grain(spark):
    rnd = random.Random(3)
    rows = [ev(f"e{i}", rnd.uniform(0, 300), session=rnd.choice([None] + [f"s{j}" for j in range(60)]), cdn=rnd.choice(["cdn-a", "cdn-b", None]),
               region=rnd.choice(["SE", None])) for i in range(500)]
    events = spark.createDataFrame(rows, EVENT_DDL).repartition(5)
    root = scratch_path(spark, "t-cells")
    V.ccv_cells(events, V.session_dictionary(events, f"{root}/sessions")).write.parquet(f"{root}/cells")
    cells = spark.read.parquet(f"{root}/cells")
    got = V.ccv_grouping_sets_from_cells(cells)
    want = V.ccv_grouping_sets(events)
    assert sorted(got.select(*want.columns).collect(), key=str) == sorted(want.collect(), key=str)
    by = V.roll_up_cells(cells, ["cdn"])
    assert sorted(by.collect(), key=str) == sorted(events.groupBy("cdn").agg(F.count_distinct("session_id").alias("ccv")).collect(), key=str)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "session_id" not in plan      # cells are copied for the grains, no events
    empty = events.limit(0)
    assert V.ccv_cells(empty, V.session_dictionary(empty, f"{root}/none")).count() == 0


def test_digests_find_one_changed_row(spark):
    rows = [(ts(3600.0 * (i % 120)), f"m{i}", i % 7, None if i % 11 == 0 else i / 3) for i in range(400)] + [(None, "x", 1, 1.0)]
    a = spark.createDataFrame(rows + rows[5:8], "window_start timestamp, marker_id string, ccv int, revenue double")
    same = spark.createDataFrame(list(reversed(rows)) + rows[5:8], a.schema).repartition(7)
    assert G.differing_dates(a, same, "window_start").count() == 0 and G.digest_diff(a, same).count() == 0
    one = spark.createDataFrame([*rows[:50], (*rows[50][:3], 0.5), *rows[51:], *rows[5:8]], a.schema)
    assert [r.date for r in G.differing_dates(a, one, "window_start").collect()] == [rows[50][0].date()]
    assert sorted((r.side, r.marker_id, r.copies) for r in G.digest_diff(a, one).collect()) == [("only_a", "m50", 1), ("only_b", "m50", 1)]
    fewer = spark.createDataFrame(rows[:-1] + rows[5:7], a.schema)                    # a row without a date, and one copy of another, are gone
    assert sorted((r.side, r.marker_id, r.copies) for r in G.digest_diff(a, fewer).collect()) == [("only_a", "m7", 1), ("only_a", "x", 1)]
    plan = G.date_digests(a, "window_start")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_xor" in plan                                                  # only digests are shuffled


def test_nested_paths_and_types(spark):
    texts = ['{"a":1,"b":{"c":"x","d":[1,"y",{"e":null}]}}', '{"a":"t","b":null}', "{bad", "[1]", "{}", None, '{"b":{"c":{"c":true}}}']
    got = {(r.path, r.type): (r.rows, r.share, r.known) for r in nested_drift(spark.createDataFrame([(t,) for t in texts], "value string"), ["a", "b.c"]).collect()}
    n = 5
    assert got == {("a", "BIGINT"): (1, 1 / n, True), ("a", "STRING"): (1, 1 / n, True), ("b", "OBJECT"): (2, 2 / n, False), ("b", "VOID"): (1, 1 / n, False),
                   ("b.c", "STRING"): (1, 1 / n, True), ("b.c", "OBJECT"): (1, 1 / n, True), ("b.c.c", "BOOLEAN"): (1, 1 / n, False), ("b.d", "ARRAY"): (1, 1 / n, False),
                   ("b.d[]", "BIGINT"): (1, 1 / n, False), ("b.d[]", "STRING"): (1, 1 / n, False), ("b.d[]", "OBJECT"): (1, 1 / n, False),
                   ("b.d[].e", "VOID"): (1, 1 / n, False), ("[]", "BIGINT"): (1, 1 / n, False)}
    assert nested_drift(spark.createDataFrame([("{bad",)], "value string"), []).count() == 0


def test_zone_map_names_the_dates_and_the_scan_reads_only_them(spark):
    root, day = scratch_path(spark, "t-zones"), ts(0).replace(hour=0)

    def raw(eid, event_h, ingest_h):
        t = day + timedelta(hours=event_h)
        body = json.dumps({"event_id": eid, "session_id": "s", "timestamp": t.isoformat() + ".000Z", "event_type": "heartbeat", "content_id": "ch-1", "cdn": "cdn-a"})
        return body.encode(), day + timedelta(hours=ingest_h)

    def put(rows):
        spark.createDataFrame(rows, "value binary, timestamp timestamp").withColumn("event_date", F.to_date("timestamp")) \
            .write.mode("append").partitionBy("event_date").parquet(f"{root}/bronze")

    put([raw("a", 1, 1), raw("b", 30, 30), raw("late", 2, 75), raw("early", 31, 23), (b"broken", day + timedelta(hours=100))])
    zones = zone_map(spark, f"{root}/bronze", f"{root}/zones")
    days = [(day + timedelta(days=d)).date() for d in range(6)]
    assert {r.event_date: (r.first_ts, r.last_ts) for r in zones.collect()} == {
        days[0]: (day + timedelta(hours=1), day + timedelta(hours=31)), days[1]: (day + timedelta(hours=30),) * 2,
        days[3]: (day + timedelta(hours=2),) * 2, days[4]: (None, None)}
    assert dates_of(zones, day, day + timedelta(days=1)) == [days[0], days[3]]
    assert dates_of(zones, day + timedelta(hours=26), None) == [days[0], days[1]] and dates_of(zones) == [days[0], days[1], days[3]]
    plan = read_bronze(spark, f"{root}/bronze").where(F.col("event_date").isin(dates_of(zones, day, day + timedelta(days=1))))
    assert len(plan.inputFiles()) == 5      # the listing; the scan prunes it
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [event_date" in text and str(days[3]) in text and str(days[1]) not in text
    put([raw("newer", 97, 97), raw("first", 3, 101)])     # the newest date has grown
    assert {r.event_date: r.first_ts for r in zone_map(spark, f"{root}/bronze", f"{root}/zones").collect()}[days[4]] == day + timedelta(hours=3)
    markers = spark.createDataFrame([], MARKER_DDL)
    full = sorted(backfill(spark, f"{root}/bronze", f"{root}/silver", markers).collect())
    part = backfill(spark, f"{root}/bronze", f"{root}/silver", markers, day + timedelta(hours=2), day + timedelta(hours=3), zones_path=f"{root}/zones")
    assert sorted(part.collect()) == full and len(full) == 6


def test_alike_decisions_without_an_id_all_count(spark):
    ddl = "decision_id string, marker_id string, channel string, slot_index int, advertiser_id string, advertiser_name string, price_cpm_brl double, served_ts timestamp"
    row = (None, "m", "c", 1, "a", "A", 1000.0, ts(0))
    ads = spark.createDataFrame([row, row, (None, "m", "c", 2, "b", "B", 500.0, ts(0)), ("d", *row[1:]), ("d", *row[1:])], ddl)
    assert G.dedupe_decisions(ads).count() == 4
    r = G.ad_revenue_by_marker(ads).first()
    assert (r.impressions, r.revenue_brl, r.advertiser_name) == (4, 3.5, "A")
    assert {x.advertiser_name: x.impressions for x in G.ad_revenue_by_advertiser(ads).collect()} == {"A": 3, "B": 1}


def test_swept_points_of_a_kick_off(spark):
    s = spark.createDataFrame([("c", ts(0), ts(100))] * 50 + [("c", ts(100), ts(200))] * 3, "content_id string, session_start timestamp, session_end timestamp")
    points = sorted((r.t, r.delta, r.concurrent) for r in SE.ccv_sweep(s).collect())
    assert len(points) == 106 and [p[2] for p in points[:50]] == list(range(1, 51)) and points[50:53] == [(ts(100), -1, 0), (ts(100), -1, 1), (ts(100), -1, 2)]


def test_hot_id_is_as_many_rows_as_it_has_times(spark):
    rows = [ev("a", 0)] * 40 + [ev("b", 0), ev("b", 15)] + [ev("c", 0), ev("c", 16)] + [ev("d", 5), (*ev("d", 5)[:2], None, *ev("d", 5)[3:])]
    df = spark.createDataFrame(rows, EVENT_DDL)
    assert slo_uniqueness(df, 15).first().duplicated_ids == 2
    lines = slo_uniqueness(df, 15)._jdf.queryExecution().executedPlan().toString().splitlines()
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    assert any("HashAggregate(keys=[event_id" in line and "timestamp" in line for line in lines[window:])


def test_events_are_read_once(spark):
    for name in ("rebuffer_ratio", "session_qoe"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 2, name        # the events and the five regions


def test_sketched_audience_stays_within_its_error(spark):
    rows = [ev(f"e{i}", (i * 7) % 600, session=f"s{i % 1500}") for i in range(6000)]
    df = spark.createDataFrame(rows, EVENT_DDL)
    exact = {r.window_start: r.ccv for r in ccv_exact(df).collect()}
    sketched = {r.window_start: r.ccv for r in ccv_approx(df, rsd=0.02).collect()}
    assert exact.keys() == sketched.keys() and all(abs(sketched[k] - v) <= 0.08 * v for k, v in exact.items())
