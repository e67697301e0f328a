"""Plan shape of the headline queries: JVM-side only, pruned scans, and the
marker side broadcast behind its size check."""

import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_headline_plans_have_no_python_and_prune_columns(spark):
    q = entry.queries()
    for name in ("silver_qoe", "gold_reconciliation", "sponsor_revenue"):
        plan = _plan(q[name](spark, SF))
        assert not [n for n in PYTHON_NODES if n in plan], name
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
            if "l_orderkey" in schema:  # lineitem: only the columns ad decisions use
                assert not {"l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"} & {
                    c.split(":")[0] for c in schema.split(",")}, schema


def test_silver_marker_side_is_broadcast(spark):
    plan = _plan(entry.queries()["silver_qoe"](spark, SF))
    assert "BroadcastHashJoin" in plan and "BroadcastExchange" in plan


def test_session_sweep_reads_events_once(spark):
    # Sessionise then sweep: each operator reads its input once, so the plan
    # scans events once (plus the five-row region table), not once per branch.
    plan = _plan(entry.queries()["ccv_sweep"](spark, SF))
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Exchange") <= 8


def test_gold_filters_before_the_join(spark):
    plan = entry.queries()["gold_reconciliation"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan     # the marker join: rows without a marker cannot reach Gold


def test_no_query_shuffles_its_scan_round(spark):
    for name in ("silver_qoe", "gold_reconciliation", "session_summary"):
        assert "REPARTITION_BY_NUM" not in _plan(entry.queries()[name](spark, SF))


def test_asof_never_ranks_events(spark):
    plan = _plan(entry.queries()["silver_qoe_asof"](spark, SF))
    assert plan.count("Window [") + plan.count("Window(") <= 1      # the markers' successor
