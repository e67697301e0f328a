import datetime as dt

from pyspark.sql import functions as F

from media_rows import EVENT_DDL, MARKER_DDL, ev, mk, ts
from crowdpulse.operators import joins, silver


def _ev(spark, rows):
    return spark.createDataFrame(rows, EVENT_DDL)


def _mk(spark, rows):
    return spark.createDataFrame(rows, MARKER_DDL)


def test_interval_bounds_are_inclusive(spark):
    events = _ev(spark, [ev("a", 100), ev("b", 220), ev("c", 99.999), ev("d", 220.001)])
    markers = _mk(spark, [mk("m1", 100)])
    out = joins.label_ad_marker(joins.ad_interval_join(events, markers, "2 minutes", bucket="30 seconds"))
    got = {r.event_id: r.marker_id for r in out.collect()}
    assert got == {"a": "m1", "b": "m1", "c": "conteudo_regular", "d": "conteudo_regular"}


def test_overlap_fans_out_but_asof_picks_latest(spark):
    events = _ev(spark, [ev("a", 61)])
    markers = _mk(spark, [mk("boundary", 60, kind="program_boundary"), mk("ad", 60.5)])
    fan = joins.ad_interval_join(events, markers, "2 minutes")
    assert sorted(r.marker_id for r in fan.collect()) == ["ad", "boundary"]
    asof = joins.asof_marker_join(events, markers, "2 minutes")
    assert [r.marker_id for r in asof.collect()] == ["ad"]
    only_ads = joins.ad_interval_join(events, markers, "2 minutes", break_types=("commercial",))
    assert [r.marker_id for r in only_ads.collect()] == ["ad"]


def test_break_join_uses_duration_half_open(spark):
    events = _ev(spark, [ev("in", 159), ev("end", 160), ev("zero", 500)])
    markers = _mk(spark, [mk("m1", 100, duration=60), mk("m0", 500, duration=0)])
    out = joins.ad_break_join(events, markers, bucket="30 seconds")
    got = {r.event_id: r.marker_id for r in out.collect()}
    assert got == {"in": "m1", "end": None, "zero": None}


def test_join_matches_brute_force_across_buckets(spark):
    import random
    rnd = random.Random(7)
    evs = [ev(f"e{i}", rnd.uniform(0, 3600), content=f"ch-{rnd.randint(0, 2)}") for i in range(300)]
    mks = [mk(f"m{i}", rnd.uniform(0, 3600), channel=f"ch-{rnd.randint(0, 2)}") for i in range(40)]
    out = joins.ad_interval_join(_ev(spark, evs), _mk(spark, mks), "2 minutes", bucket="45 seconds")
    got = sorted((r.event_id, r.marker_id or "") for r in out.collect())
    want = []
    for e in evs:
        hits = [m[0] for m in mks if m[1] == e[4] and m[2] <= e[2] <= m[2] + (ts(120) - ts(0))]
        want += [(e[0], h) for h in hits] or [(e[0], "")]
    assert got == sorted(want)


def test_dedupe_keys(spark):
    rows = [ev("a", 10), ev("a", 10), ev("a", 13)]
    df = _ev(spark, rows)
    assert silver.dedupe_events(df).count() == 2
    assert silver.dedupe_events(df, ("event_id",)).count() == 1


def test_silver_cube_values(spark):
    rows = [ev("a", 5, session="s1"), ev("b", 10, session="s2", err="E1"), ev("c", 20, "buffer_start", "s1"),
            ev("c", 20, "buffer_start", "s1"), ev("d", 70, session="s3")]
    out = silver.silver_qoe(_ev(spark, rows), _mk(spark, [mk("m1", 0)]), "1 minute", "2 minutes")
    r = {x.window_start.minute: x for x in out.collect()}
    first = r[0]
    assert first.marker_id == "m1" and first.ccv == 2 and first.event_count == 3 and first.error_count == 1
    assert abs(first.error_rate - 1 / 3) < 1e-12 and abs(first.rebuffering_ratio - 1 / 3) < 1e-12
    assert r[1].ccv == 1


def test_approx_ccv_close_to_exact(spark):
    rows = [ev(f"e{i}", i % 60, session=f"s{i}") for i in range(5000)]
    df = _ev(spark, rows)
    exact = silver.ccv_exact(df, "1 hour").first().ccv
    approx = silver.ccv_approx(df, "1 hour").first().ccv
    assert exact == 5000 and abs(approx - exact) / exact < 0.1
    sk = silver.rollup_sketches(silver.ccv_sketches(df, "1 minute", dims=("cdn",)), by=()).first().ccv
    assert abs(sk - 5000) / 5000 < 0.1


def test_null_dims_become_unknown(spark):
    rows = [ev("a", 5, region=None, device=None)]
    out = silver.silver_qoe(_ev(spark, rows), _mk(spark, [mk("m1", 1000)]), "1 minute", "2 minutes").first()
    assert out.region == "unknown" and out.device == "unknown" and out.marker_id == "conteudo_regular"


def test_count_per_marker_adds_up_before_the_shuffle(spark):
    """As a distinct count over the joined rows: replayed markers, ids at several places, rows without an id, re-sent events."""
    import random
    r, t0 = random.Random(5), dt.datetime(2024, 1, 1)
    at = lambda: t0 + dt.timedelta(seconds=r.randrange(900))
    events = [(r.choice([f"e{i}", f"e{i % 40}", None]), r.choice("aab"), r.choice([at(), at(), at(), None])) for i in range(600)]
    markers = [(f"m{i}", r.choice("ab"), at()) for i in range(30)]
    markers += markers[:6] + [("m7", "a", at()), ("m8", "b", at()), (None, "a", at()), (None, "a", at()), ("conteudo_regular", "b", at()), ("m50", None, at()), ("m9", "a", None)]
    ev = spark.createDataFrame(events, "event_id string, content_id string, timestamp timestamp").dropDuplicates(["event_id", "timestamp", "content_id"])
    mk = spark.createDataFrame(markers, "marker_id string, channel string, wallclock timestamp")
    plain = joins.label_ad_marker(joins.ad_interval_join(ev, mk, "2 minutes"))
    want = plain.groupBy("marker_id").agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_id").alias("n_ids"),
                                          F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))
    joined = joins.label_ad_marker(joins.ad_interval_join(joins.with_previous(ev), joins.marker_places(mk), "2 minutes"))
    got = joins.count_per_marker(joined)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert joined.where("_one").count() > 200 and joined.where("_one").select("marker_id").distinct().count() < 30
