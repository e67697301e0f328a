from datetime import datetime

from pyspark.sql import functions as F

from crowdpulse.operators import gold as G
from crowdpulse.operators import quality as Q
from crowdpulse.operators import serving as V
from crowdpulse.sources.contracts import PLAYER_EVENT_CONTRACT

GOLD_DDL = ("window_start timestamp, marker_id string, content_title string, genre string, advertiser_name string, "
            "region string, device string, cdn string, ccv long, total_revenue_brl double, avg_bitrate_kbps double, "
            "error_rate double")


def g(w, marker="m1", adv="A", rev=1.0, ccv=5, region="SE", err=0.0):
    return (datetime(2024, 1, 1, 12, w), marker, "T", "G", adv, region, "web", "cdn-a", ccv, rev, 1000.0, err)


def _report(spark, rows, **kw):
    df = spark.createDataFrame(rows, GOLD_DDL)
    return {r.check: r for r in Q.gold_quality_report(df, **kw).collect()}


def test_quality_passes_on_clean_gold(spark):
    rep = _report(spark, [g(0), g(1, rev=None, adv=None, marker="conteudo_regular")])
    assert all(r.passed for r in rep.values())


def test_quality_failures(spark):
    assert not _report(spark, [])["volume"].passed
    assert not _report(spark, [g(0, region=None)])["completeness"].passed
    assert not _report(spark, [g(0, adv=None)])["completeness"].passed
    assert not _report(spark, [g(0, rev=-1.0)])["revenue_not_negative"].passed
    assert not _report(spark, [g(0, ccv=-1)])["audience_not_negative"].passed
    assert not _report(spark, [g(0, err=1.5)])["range:error_rate"].passed


def test_freshness_lag_boundary(spark):
    ok = _report(spark, [g(0), g(10, rev=None, adv=None)])           # lag 600 s
    assert ok["freshness"].passed
    late = [g(0), (datetime(2024, 1, 1, 12, 10, 1),) + g(10, rev=None, adv=None)[1:]]  # lag 601 s
    assert not _report(spark, late)["freshness"].passed
    warn = _report(spark, [g(0, rev=None, adv=None)])["freshness"]
    assert warn.passed and "warning" in warn.detail
    import pytest
    with pytest.raises(Q.QualityError):
        Q.fail_if_any(Q.gold_quality_report(spark.createDataFrame([g(0, rev=-1.0)], GOLD_DDL)))


def test_padded_keys_and_fan_out_safe_revenue(spark):
    silver = spark.createDataFrame(
        [(datetime(2024, 1, 1, 12, m), " m1 ", r, "web", "cdn-a", 10, 1000.0, 0.0) for m in range(3)
         for r in ("SE", "S")],
        "window_start timestamp, marker_id string, region string, device string, cdn string, ccv long, "
        "avg_bitrate_kbps double, error_rate double")
    ads = spark.createDataFrame([("d1", "m1", "ch-1", 1, "a", "A", 1000.0), ("d2", "m1", "ch-1", 2, "b", "B", 500.0),
                                 ("d1", "m1", "ch-1", 1, "a", "A", 1000.0)],
                                "decision_id string, marker_id string, channel string, slot_index int, "
                                "advertiser_id string, advertiser_name string, price_cpm_brl double")
    content = spark.createDataFrame([(" ch-1 ", "Show", "Sport")], "content_id string, title string, genre string")
    gold = G.gold_reconciliation(silver, ads, content)
    rows = gold.collect()
    assert len(rows) == 6 and all(r.content_title == "Show" and r.total_revenue_brl == 1.5 for r in rows)
    assert all(r.advertiser_name == "A" for r in rows)           # first slot of the pod, not arbitrary
    sp = V.sponsor_revenue(gold).collect()
    assert len(sp) == 1 and sp[0].total_revenue_brl == 1.5 and sp[0].impacted_viewers == 60
    by_adv = {r.advertiser_name: r.revenue_brl for r in G.ad_revenue_by_advertiser(ads).collect()}
    assert by_adv == {"A": 1.0, "B": 0.5}                     # replayed d1 counted once (D22)


def test_contract_violations(spark):
    good = ('{"event_id":"1","session_id":"s","user_id":"u","timestamp":"2024-01-01T00:00:00.000Z",'
            '"event_type":"heartbeat","content_id":"c","is_live":true,'
            '"device":{"type":"web","model":"m","os":"o","app_version":"1"},'
            '"geo":{"region":"SE","state":"SP","city":"x","isp":"y"},"cdn":"cdn-a","bitrate_kbps":1,'
            '"buffer_length_ms":2,"playhead_position_s":3,"error_code":null}')
    rows = [(good,), ('{"event_id": "1"',), (good.replace('"cdn":"cdn-a",', ""),),
            (good.replace('"bitrate_kbps":1', '"bitrate_kbps":"x"'),),
            (good.replace('"event_id":"1"', '"event_id":null'),),
            (good.replace('"error_code":null', '"error_code":"E1","network_type":"wifi"'),)]
    v = Q.validate_contract(spark.createDataFrame(rows, "value string"), PLAYER_EVENT_CONTRACT).collect()
    assert [r.violations for r in v] == [[], ["malformed_json"], ["missing:cdn"], ["type:bitrate_kbps"],
                                         ["null:event_id"], []]
    valid, dlq = Q.split_valid_dlq(Q.validate_contract(spark.createDataFrame(rows, "value string"),
                                                       PLAYER_EVENT_CONTRACT))
    assert valid.count() == 2 and dlq.count() == 4


def test_format_brl(spark):
    from crowdpulse.functions.columns import format_brl, format_int_dotted
    r = spark.createDataFrame([(1234567.891, 12345)], "x double, n long").select(
        format_brl("x").alias("a"), format_int_dotted("n").alias("b")).first()
    assert r.a == "R$ 1.234.567,89" and r.b == "12.345"


SILVER_DDL = ("window_start timestamp, marker_id string, region string, device string, cdn string, ccv long, "
              "avg_bitrate_kbps double, error_rate double")
ADS_DDL = ("decision_id string, marker_id string, channel string, slot_index int, advertiser_id string, advertiser_name string, "
           "price_cpm_brl double")


def test_gold_has_one_row_per_silver_ad_row(spark):
    w = datetime(2024, 1, 1, 12)
    silver = spark.createDataFrame([(w, "m1", "S", "web", "cdn-a", 10, 1.0, 0.0), (w, "conteudo_regular", "S", "web", "cdn-a", 99, 1.0, 0.0),
                                    (w, None, "S", "web", "cdn-a", 99, 1.0, 0.0), (w, "m9", "S", "web", "cdn-a", 7, 1.0, 0.0)], SILVER_DDL)
    ads = spark.createDataFrame([("d1", "m1", "ch-1", 1, "a", "A", 1000.0), ("d2", " m1", "ch-1 ", 2, "b", "B", 500.0),
                                 ("d3", "m1 ", "ch-2", 1, "c", "C", 250.0)], ADS_DDL)
    content = spark.createDataFrame([(" ch-1 ", "Show", "Sport"), ("ch-1", "Old", "Sport"), ("ch-2", "Two", "News")],
                                    "content_id string, title string, genre string")
    got = {r.marker_id: r for r in G.gold_reconciliation(silver, ads, content).collect()}
    assert set(got) == {"m1", "m9"} and got["m9"].total_revenue_brl is None
    assert got["m1"].total_revenue_brl == 1.75 and got["m1"].content_title == "Show" and got["m1"].advertiser_name == "A"


def test_replayed_decisions_keep_the_first_served(spark):
    rows = [("d1", 2, 5.0), ("d1", 1, 3.0), ("d1", 1, 4.0), (None, 1, 1.0), (None, 2, 1.0)]
    ads = spark.createDataFrame(rows, "decision_id string, served_ts int, price double")
    for df in (ads, ads.orderBy("price"), ads.orderBy(F.desc("price"))):
        got = sorted([tuple(r) for r in G.dedupe_decisions(df).collect()], key=str)
        assert got == sorted([("d1", 1, 3.0), (None, 1, 1.0), (None, 2, 1.0)], key=str)


def test_uniqueness_has_no_window_edges(spark):
    from crowdpulse.operators.slo import slo_uniqueness
    rows = [("a", datetime(2024, 1, 1, 0, 0, 14)), ("a", datetime(2024, 1, 1, 0, 0, 16)), ("b", datetime(2024, 1, 1, 0, 0, 0)),
            ("b", datetime(2024, 1, 1, 0, 0, 16)), ("c", datetime(2024, 1, 1)), ("c", datetime(2024, 1, 1, 0, 0, 15))]
    r = slo_uniqueness(spark.createDataFrame(rows, "event_id string, timestamp timestamp")).first()
    assert r.duplicated_ids == 2 and not r.met


def test_every_failed_check_is_reported(spark):
    import pytest
    report = spark.createDataFrame([(f"c{i}", False, 1, None) for i in range(30)], "check string, passed boolean, failed_rows long, detail string")
    with pytest.raises(Q.QualityError) as e:
        Q.fail_if_any(report)
    assert all(f"c{i} failed" in str(e.value) for i in range(30))


def test_gold_files_are_sorted(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from crowdpulse.sinks.writers import gold_write_partitioned
    rows = [g(i % 60, marker=f"m{i}") for i in range(500)]
    gold_write_partitioned(spark.createDataFrame(rows, GOLD_DDL).repartition(3), f"file://{tmp_path}/gold")
    files = glob.glob(f"{tmp_path}/gold/*/*.parquet")
    assert files
    for f in files:
        times = pq.read_table(f).column("window_start").to_pylist()
        assert times == sorted(times)


def test_match_rate_counts_player_ad_events(spark):
    from media_rows import EVENT_DDL, MARKER_DDL, ev, mk
    from crowdpulse.operators.slo import slo_match_rate
    events = spark.createDataFrame([ev("a", 10, "ad_start"), ev("b", 500, "ad_start"), ev("c", 10), ev("d", 20, "ad_end")], EVENT_DDL)
    r = slo_match_rate(events, spark.createDataFrame([mk("m", 0), mk("n", 5)], MARKER_DDL)).first()
    assert (r.ad_events, r.matched, r.met) == (3, 2, False)
