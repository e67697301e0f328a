"""Jobs that write their result leave no shuffle files, and the upsert no second copy of what it merged."""

import os
import time

from pyspark.sql import functions as F

from crowdpulse.session import FREE_SHUFFLES, freed_shuffles, scratch_path
from crowdpulse.sinks.writers import gold_write_partitioned, read_upserted, silver_upsert


def _shuffle_files(spark) -> set:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _left(spark, before, wait=10.0) -> set:
    until = time.time() + wait
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def _rows(spark, n=500):
    return spark.range(n).select((F.col("id") % 50).alias("key"), "id").groupBy("key").agg(F.max("id").alias("v"))


def test_shuffles_are_freed_only_inside(spark, tmp_path):
    before, rows = _shuffle_files(spark), _rows(spark)
    with freed_shuffles(spark):
        rows.write.parquet(f"{tmp_path}/in")
    assert not _left(spark, before) and spark.conf.get(FREE_SHUFFLES, None) is None
    spark.conf.set(FREE_SHUFFLES, "false")
    try:
        with freed_shuffles(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "true"
        assert spark.conf.get(FREE_SHUFFLES) == "false"
    finally:
        spark.conf.unset(FREE_SHUFFLES)
    assert sorted(rows.collect()) == sorted(spark.read.parquet(f"{tmp_path}/in").collect())   # run again, it is made anew


def test_upsert_leaves_no_shuffles_and_no_merged_copy(spark):
    root = scratch_path(spark, "t-upsert-disk")
    spark.createDataFrame([(i % 40, i) for i in range(100)], "key int, v int").write.parquet(f"{root}/in")
    before = _shuffle_files(spark)
    for extra in ([], [(3, 7), (99, 1)]):
        if extra:
            spark.createDataFrame(extra, "key int, v int").write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("key int, v int").parquet(f"{root}/in")
        silver_upsert(stream, f"{root}/t", f"{root}/ck", ["key"], rules={}, trigger=None, parts=4).awaitTermination()
    assert {r.key: r.v for r in read_upserted(spark, f"{root}/t").collect()} == {**{k: (80 if k < 20 else 40) + k for k in range(40)}, 3: 7, 99: 1}
    assert os.listdir(f"{root}/ck-staged") == ["batch"]
    assert not [f for f in _left(spark, before) if f.endswith(".data")]


def test_gold_write_leaves_no_shuffles(spark, tmp_path):
    gold = _rows(spark).select(F.timestamp_seconds(F.lit(1704067200) + 7200 * F.col("key")).alias("window_start"), "v")
    before = _shuffle_files(spark)
    gold_write_partitioned(gold, f"{tmp_path}/gold")
    assert not _left(spark, before)
    assert sorted(spark.read.parquet(f"{tmp_path}/gold").select(*gold.columns).collect()) == sorted(gold.collect())
