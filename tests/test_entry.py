import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"window_start", "marker_id", "ccv", "error_rate"} <= set(df.columns)


def test_oracles_cover_registered_queries():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 85
    # queries without an oracle are the HLL (approximate) ones only
    own = set(qs) - set(entry.LLM_QUERIES)
    assert own - set(sql) == {"ccv_approx", "ccv_sketch_rollup"}
