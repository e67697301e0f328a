"""Decisions for markers that never came are dropped before the shuffle, and nothing else changes."""

import random

from pyspark.sql import functions as F

from media_rows import EVENT_DDL, MARKER_DDL, ev, mk, ts
from crowdpulse.operators import broadcast
from crowdpulse.operators import gold as G
from crowdpulse.operators.silver import silver_qoe

ADS = "decision_id string, marker_id string, channel string, slot_index int, creative_id string, advertiser_name string, price_cpm_brl double, served_ts timestamp"
CONTENT = "content_id string, title string, genre string, updated_at timestamp"


def test_no_key_is_lost_and_most_others_are(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    held = spark.createDataFrame([(None,), ("k7",)], "k string").unionByName(keys.where("k LIKE '%3'"))
    got = {r.k for r in broadcast.maybe_among(keys, F.col("k"), broadcast.key_bits(held, F.col("k"))).collect()}
    want = {f"k{i}" for i in range(3000) if i % 10 == 3} | {"k7"}
    assert want <= got and len(got - want) < 10
    assert broadcast.maybe_among(keys, F.col("k"), broadcast.key_bits(held.limit(0), F.col("k"))).count() == 0


def test_every_bit_is_read_where_it_is_set(spark, monkeypatch):
    monkeypatch.setattr(broadcast, "_spot", lambda key: key)
    spots = [0, 1, 7, 8, 32767, 32768, 32769, 65536, (1 << 27) - 1]
    bits = broadcast.key_bits(spark.createDataFrame([(s,) for s in spots], "at long"), F.col("at"))
    near = spark.createDataFrame([(s + d,) for s in spots for d in (-1, 0, 1) if s + d >= 0], "at long").distinct()
    assert sorted(r.at for r in broadcast.maybe_among(near, F.col("at"), bits).collect()) == spots


def test_gold_is_the_same_with_fewer_decisions(spark):
    rnd = random.Random(5)
    events = spark.createDataFrame([ev(f"e{i}", i * 3.0, session=f"s{i % 5}") for i in range(60)], EVENT_DDL)
    cues = spark.createDataFrame([mk("m1", 30), mk(" m2", 60), mk("m2 ", 90), mk("m3", 120), mk(None, 10), mk("conteudo_regular", 20)], MARKER_DDL)
    ads = [(f"d{i}", rnd.choice(["m1 ", "m2", " m3", "x1", "x2", None]), "ch-1", i % 3, f"c{i}", rnd.choice(["a", "b", None]), i * 10.0, ts(i)) for i in range(80)]
    # copies of a decision for several markers, known and not: the one served first counts, wherever it is
    ads += [("moved", "x9", "ch-1", 0, "c", "gone", 1e6, ts(0)), ("moved", "m1", "ch-1", 0, "c", "never", 1e6, ts(5)), ("moved2", "m1", "ch-1", 0, "c", "first", 5e5, ts(0)),
            ("moved2", "x9", "ch-1", 0, "c", "gone", 1e6, ts(5)), (None, "m1", "ch-1", 1, "c", "a", 7e4, ts(1)), (None, "m1", "ch-1", 1, "c", "a", 7e4, ts(1))]
    ads = spark.createDataFrame(ads + ads[:30], ADS)
    content = spark.createDataFrame([(" ch-1 ", "t", "g", ts(0))], CONTENT)
    silver = silver_qoe(events, cues, "1 minute", "2 minutes")
    got, want = G.gold_reconciliation(silver, ads, content, cues=cues), G.gold_reconciliation(silver, ads, content)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 0
    listed = G.gold_reconciliation(silver, ads, content, cues=cues, listed=ads.select("marker_id", "decision_id").distinct())
    assert sorted(map(str, listed.collect())) == sorted(map(str, want.collect()))
    assert {r.advertiser_name for r in G.decisions_of(ads, cues).where("marker_id LIKE 'x%'").collect()} == {"gone"}
    assert G.gold_reconciliation(silver, ads, content, cues=cues.limit(0)).where("total_revenue_brl > 0").count() > 0   # no id: they stay


def test_the_second_run_sends_an_input_row_once(spark, tmp_path, monkeypatch):
    """idempotence_diff reorders events and decisions in one exchange each and doubles the rows behind it."""
    from crowdpulse.plans import gold_queries as Q
    seen, kept = [], G.gold_reconciliation

    def watched(silver, ads, *a, **kw):
        gold = kept(silver, ads, *a, **kw)
        seen.append((ads, gold._jdf.queryExecution().optimizedPlan().toString().splitlines()))
        return gold

    monkeypatch.setattr(Q.G, "gold_reconciliation", watched)
    sf = "/root/testdata/sf0.001"
    assert Q.q_idempotence_diff(spark, sf).first()[:] == (0, 0)
    ads, plan = seen[1]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for key, parts in (("creative_id", 5), ("session_id", 7)):
        at = [i for i, line in enumerate(plan) if f"RepartitionByExpression [{key}#" in line and f"], {parts}" in line]
        assert at and all("Union" not in x for i in at for x in plan[i + 1:i + 1 + next((n for n, x in enumerate(plan[i + 1:]) if depth(x) <= depth(plan[i])), len(plan))])
    assert sum("RepartitionByExpression [creative_id#" in line for line in plan) == 1      # none for the filter
    assert ads.count() == 2 * Q.tm.ad_decisions(spark, sf).count()
