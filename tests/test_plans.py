"""Plan-shape checks: column pruning reaches the scan, map-only operators do
not shuffle, shared window specs sort once, scalar subqueries run once."""

import __spark_entry__ as entry
from tickloom.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_scan_is_pruned(spark):
    p = plan(fx.bars(spark, SF))
    assert "o_orderpriority" not in p and "o_orderstatus" not in p
    assert "c_name" not in p and "c_acctbal" not in p


def test_lexicon_scoring_is_map_only(spark):
    p = plan(entry.queries()["g1_lexicon_scoring"](spark, SF))
    assert "Exchange" not in p
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p


def test_indicators_share_one_sort(spark):
    df = entry.queries()["d1_d5_indicators"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("Sort [symbol") == 1


def test_vix_range_subquery_runs_once(spark):
    df = fx.vix(spark, SF)
    df.collect()
    p = plan(df)
    assert p.count("ReusedSubquery") >= 2


def test_news_range_is_a_partition_filter(spark):
    df = entry.queries()["f1_partition_pruned_scan"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in p or "PartitionFilters: [" in p
