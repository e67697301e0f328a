"""The salted Silver stream over lists: the cube of the plain join, and state that grows with events and markers only."""

import random

from pyspark.sql import functions as F

from media_rows import EVENT_DDL, MARKER_DDL, ev, mk, ts
from crowdpulse.operators.joins import ad_interval_join, label_ad_marker
from crowdpulse.operators.silver import aggregate_qoe, dedupe_events
from crowdpulse.session import scratch_path
from crowdpulse.streaming.pipeline import silver_stream_salted, start_to_parquet


def test_salted_state_holds_no_cells_per_marker(spark):
    root, rnd = scratch_path(spark, "t-salted-lists"), random.Random(8)
    rows = [ev(f"e{i}", rnd.choice([rnd.uniform(0, 900), 30.0 * rnd.randint(0, 30)]), rnd.choice(["heartbeat", "buffer_start", None]), rnd.choice(["s0", "s1", "s2", None]),
               rnd.choice(["ch-1", "ch-1", "ch-2", None]), rnd.choice(["cdn-a", "cdn-b", None]), rnd.choice([None, "E1"]), rnd.choice([None, 7, -5, 2**31 - 1]),
               rnd.choice(["SE", None]), "web", rnd.choice([None, 3])) for i in range(300)]
    rows += rows[:40]
    marks = [mk(f"m{i}", rnd.uniform(-130, 900), rnd.choice(["ch-1", "ch-2", "ch-3", None])) for i in range(60)]
    marks += marks[:5] + [mk("both", 300), mk("both", 320, "ch-2"), mk("conteudo_regular", 500)]
    marks += [mk(f"d{i}", 400 + i * 0.25) for i in range(300)]              # each event there meets some hundred
    for part, last, ddl, to in ((rows, ev("zz", 10 ** 6, content="ch-9", cdn="zz"), EVENT_DDL, "ev"), (marks, mk("zz", 10 ** 6, channel="ch-9"), MARKER_DDL, "mk")):
        for some in (part, [last]):
            spark.createDataFrame(some, ddl).coalesce(1).write.mode("append").parquet(f"{root}/{to}")
    es, ms = (spark.readStream.schema(d).parquet(f"{root}/{p}") for d, p in ((EVENT_DDL, "ev"), (MARKER_DDL, "mk")))
    query = start_to_parquet(silver_stream_salted(es, ms, salts=4), f"{root}/out", f"{root}/ck")
    query.awaitTermination()
    got = spark.read.parquet(f"{root}/out").where(F.col("window_start") < F.lit(ts(9000)))
    mks = spark.createDataFrame(marks, MARKER_DDL).select("marker_id", "channel", "wallclock")
    want = aggregate_qoe(label_ad_marker(ad_interval_join(dedupe_events(spark.createDataFrame(rows, EVENT_DDL)), mks, "2 minutes")), "1 minute")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    held = max(o.numRowsTotal for p in query.recentProgress for o in p.stateOperators)
    assert got.count() > 1200 > 400 > held
