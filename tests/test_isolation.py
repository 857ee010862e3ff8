import datetime as dt

import pytest

from tickloom.operators import backtest as bt
from tickloom.session import scratch_path


def signals(spark, flags):
    rows = [("S", dt.date(2024, 1, 1 + i), 100.0 + 3 * i - 4 * (i % 3), f) for i, f in enumerate(flags)]
    return spark.createDataFrame(rows, "symbol string, date date, price_close double, predicted_signal int")


def test_a_failing_model_is_skipped_and_named(spark):
    good = [1, 0, 1, 1, 0, 1]
    models = {"good": lambda: signals(spark, good), "unloadable": lambda: 1 / 0,
              "breaks": lambda: signals(spark, good).selectExpr("symbol", "date", "price_close", "raise_error('spoilt row') AS predicted_signal"),
              "lacks a column": lambda: signals(spark, good).drop("price_close")}
    fine, errors = bt.isolated_comparison(spark, models, scratch_path(spark, "t_iso"))
    assert set(errors) == {"unloadable", "breaks", "lacks a column"}
    assert errors["unloadable"] == "ZeroDivisionError: division by zero"
    alone = bt.backtest_metrics(bt.order_book(signals(spark, good).selectExpr("*", "'good' AS model"), capital=100_000.0, first_row_position=False), 100_000.0)
    cols = sorted(alone.columns)
    assert fine.select(cols).collect() == alone.select(cols).collect()


def test_all_failing_is_an_error(spark):
    with pytest.raises(bt.AllModelsFailed) as e:
        bt.isolated_comparison(spark, {"a": lambda: 1 / 0, "b": lambda: {}["x"]}, scratch_path(spark, "t_iso"))
    assert set(e.value.errors) == {"a", "b"} and "a: ZeroDivisionError" in str(e.value)


def test_no_models_and_empty_signals(spark):
    assert bt.isolated_comparison(spark, {}, scratch_path(spark, "t_iso")) == (None, {})
    fine, errors = bt.isolated_comparison(spark, {"empty": lambda: signals(spark, [1]).limit(0)}, scratch_path(spark, "t_iso"))
    assert errors == {} and fine.collect() == []
