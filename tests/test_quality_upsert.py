import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException

from tickloom.operators import contracts as ct
from tickloom.operators import quality as qu
from tickloom.operators import upsert as up
from tickloom.session import scratch_path


def test_required_columns(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0)], "date date, close double")
    with pytest.raises(ct.ContractError, match="missing columns"):
        ct.require_columns(df, ct.STOCK_PROCESSED, "silver")
    with pytest.raises(ct.ContractError):
        ct.require_columns(None, ct.STOCK_PROCESSED, "silver")
    empty = spark.createDataFrame([], ct.STOCK_PROCESSED)
    ct.validate(empty, ct.STOCK_PROCESSED, "empty passes")


def test_lax_integer_coercion(spark):
    schema = ct._schema(("n", ct.L, False))
    df = spark.createDataFrame([("5",), ("5.0",), ("5.5",), ("x",), (None,)], "n string")
    v = ct.violations(df, schema, "s").collect()[0]
    assert v["bad_rows"] == 3            # 5.5, x and the required NULL
    with pytest.raises(ct.ContractError):
        ct.validate(df, schema, "s")
    ok = spark.createDataFrame([(5.0,), (float("nan"),)], "n double")
    assert ct.violations(ok, ct._schema(("n", ct.L, True)), "s").collect()[0]["bad_rows"] == 0


def test_counter_and_label_and_url(spark):
    df = spark.createDataFrame([("5 retweets", "7.0", "http://x.org/a/b/123"), ("", None, "https://y/9#z"),
                                (None, "n/a", "u")], "lbl string, c string, url string")
    got = df.select(qu.count_from_label("lbl").alias("a"), qu.counter("c").alias("b"),
                    qu.id_from_url("url").alias("u")).collect()
    assert [tuple(r) for r in got] == [("5", 7, "123"), ("0", 0, "9#z"), ("0", 0, "u")]


def test_one_line(spark):
    df = spark.createDataFrame([(" a\r\nb\t\tc  ",)], "t string")
    assert df.select(qu.one_line("t")).first()[0] == "a b c"


def test_first_seen_and_cap(spark):
    df = spark.createDataFrame([(1, 3, "late"), (1, 1, "first"), (2, 2, "only"), (3, 0, "zero")],
                               "id int, arrival int, v string")
    got = {r["id"]: r["v"] for r in qu.first_seen(df, "id", "arrival").collect()}
    assert got == {1: "first", 2: "only", 3: "zero"}
    capped = [r["id"] for r in qu.first_seen(df, "id", "arrival", cap=2).collect()]
    assert sorted(capped) == [1, 3]


def test_drop_sparse_then_incomplete(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, None), (3, 5.0, 3.0)], "a int, b double, c double")
    out = qu.drop_sparse_then_incomplete(df)
    assert out.columns == ["a", "c"] and out.count() == 2


def test_describe_percentiles_linear(spark):
    df = spark.createDataFrame([("S", float(x)) for x in [1, 2, 3, 4]], "symbol string, close double")
    r = qu.describe(df, "close").collect()[0]
    assert (r["p25"], r["p50"], r["p75"]) == (1.75, 2.5, 3.25)


def test_newest_batch_wins(spark):
    d = dt.date(2024, 1, 2)
    df = spark.createDataFrame([("S", d, 1.0, 1), ("S", d, 2.0, 2), ("S", dt.date(2024, 1, 3), 5.0, 1)],
                               "symbol string, date date, close double, batch_seq int")
    got = {r["date"]: r["close"] for r in up.newest_wins(df, ["symbol", "date"]).collect()}
    assert got == {d: 2.0, dt.date(2024, 1, 3): 5.0}


def test_upsert_table_versions_and_unreadable_history(spark):
    root = scratch_path(spark, "t_upsert")
    d1 = spark.createDataFrame([("S", 1, 1.0, 1), ("S", 2, 2.0, 1)], "symbol string, k int, v double, batch_seq int")
    d2 = spark.createDataFrame([("S", 2, 9.0, 2), ("S", 3, 3.0, 2)], "symbol string, k int, v double, batch_seq int")
    up.upsert_table(spark, root, d1, ["symbol", "k"])
    t = up.upsert_table(spark, root, d2, ["symbol", "k"])
    assert sorted((r["k"], r["v"]) for r in t.collect()) == [(1, 1.0), (2, 9.0), (3, 3.0)]
    assert up.read_or_none(spark, scratch_path(spark, "missing")) is None


def test_killed_versions_do_not_count(spark):
    """An empty folder, or one with finished files but no commit mark, is no version."""
    root = scratch_path(spark, "t_killed")
    rows = spark.createDataFrame([("S", i, float(i), 1) for i in range(100)], "symbol string, k int, v double, batch_seq int")
    one = spark.createDataFrame([("S", 500, 1.0, 2)], rows.schema)
    up.upsert_table(spark, root, rows, ["symbol", "k"])
    os.makedirs(f"{root}/v=2/_temporary/0")
    assert up.upsert_table(spark, root, one, ["symbol", "k"]).count() == 101
    two = spark.createDataFrame([("S", 501, 1.0, 3)], rows.schema)
    one.write.parquet(f"{root}/v=4")
    os.remove(f"{root}/v=4/_SUCCESS")
    assert up.upsert_table(spark, root, two, ["symbol", "k"]).count() == 102
    assert up.versions(spark, root) == [1, 3, 5]
    up.drop_versions(spark, root, 2)
    assert up.versions(spark, root) == [3, 5] and up.read_table_version(spark, root).count() == 102


def test_unreadable_history_is_an_error_unless_said(spark):
    root = scratch_path(spark, "t_unreadable")
    os.makedirs(f"{root}/v=1")
    open(f"{root}/v=1/_SUCCESS", "w").close()
    new = spark.createDataFrame([("S", 1, 1.0, 1)], "symbol string, k int, v double, batch_seq int")
    with pytest.raises(AnalysisException):
        up.upsert_table(spark, root, new, ["symbol", "k"])
    assert up.upsert_table(spark, root, new, ["symbol", "k"], unreadable_is_absent=True).count() == 1


def test_equal_batches_have_one_winner(spark):
    rows = [("S", 1, 2.0, 7), ("S", 1, 1.0, 7)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "symbol string, k int, v double, batch_seq int")
        assert [r["v"] for r in up.newest_wins(df, ["symbol", "k"]).collect()] == [2.0]


def test_day_writes_make_few_files(spark):
    """Rows of every day in every task: files stay within days x parts."""
    df = spark.range(4000).selectExpr("id", "date_add(date'2026-01-01', cast(id % 10 as int)) AS fecha_limpia").repartition(16)
    path = scratch_path(spark, "t_days")
    up.write_days(df, path, parts=2)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 20 and spark.read.parquet(path).count() == 4000


def test_bad_csv_field_is_an_error(spark):
    from pyspark.sql import types as T

    from tickloom.sources import files as io
    path = scratch_path(spark, "t_csv")
    spark.createDataFrame([("1",), ("x",)], "n string").write.option("header", True).csv(path)
    with pytest.raises(Exception):
        io.read_csv(spark, path, T.StructType([T.StructField("n", T.IntegerType())])).collect()


def test_replace_matching_and_pending_days(spark):
    old = spark.createDataFrame([("m1", 1.0), ("m2", 2.0)], "model string, v double")
    new = spark.createDataFrame([("m2", 5.0)], "model string, v double")
    assert sorted(tuple(r) for r in up.replace_matching(old, new, ["model"]).collect()) == [("m1", 1.0), ("m2", 5.0)]
    cand = spark.createDataFrame([(1,), (2,), (3,)], "d int")
    done = spark.createDataFrame([(2,)], "d int")
    assert sorted(r[0] for r in up.pending_days(cand, done, ["d"]).collect()) == [1, 3]


def test_fill_both_ways(spark):
    from tickloom.operators.features import fill_both_ways
    df = spark.createDataFrame([("S", dt.date(2024, 1, i), v) for i, v in [(1, None), (2, 2.0), (3, None), (4, 4.0),
                                                                             (5, None)]],
                               "symbol string, date date, x double")
    got = [r["x"] for r in fill_both_ways(df, ["x"]).orderBy("date").collect()]
    assert got == [2.0, 2.0, 4.0, 4.0, 4.0]


def test_params_from_file_name(spark):
    from tickloom.sources.files import params_from_name, range_bounds
    df = spark.createDataFrame([("social_raw_BRK_B_20260101_20260131.csv",)], "n string")
    r = df.select(params_from_name("n").alias("p")).first()["p"]
    assert (r["ticker"], r["start_date"], r["end_date"], r["safe_name"]) == (
        "BRK_B", dt.date(2026, 1, 1), dt.date(2026, 1, 31), "brk_b")
    bad = spark.createDataFrame([("a_b_c.csv",)], "n string")
    with pytest.raises(Exception):
        bad.select(params_from_name("n")).collect()
    assert range_bounds("2026-01-05", "2026-01-05") == ("2026-01-05", "2026-01-06")


def test_small_days_have_one_file_and_large_ones_parts(spark, monkeypatch):
    monkeypatch.setattr(up, "DAY_ROWS", 100)
    df = spark.range(1290).selectExpr("id", "date_add(date'2026-01-01', cast(if(id < 290, id % 29, 29) as int)) AS fecha_limpia")
    path = scratch_path(spark, "t_one_file")
    up.write_days(df.unionByName(spark.sql("SELECT 0L AS id, CAST(NULL AS date) AS fecha_limpia")).repartition(8), path)
    files = {os.path.basename(d): len([f for f in names if f.endswith(".parquet")]) for d, _, names in os.walk(path) if "=" in os.path.basename(d)}
    assert len(files) == 31 and 2 <= files.pop("fecha_limpia=2026-01-30") <= 4 and set(files.values()) == {1}
    assert spark.read.parquet(path).count() == 1291
    up.write_days(df.where("id = 5"), path)                     # just this day is replaced
    assert spark.read.parquet(path).count() == 1291 - 9


def test_consolidate_lists_the_days_asked_for(spark):
    df = spark.range(400).selectExpr("cast(id as string) AS tweet_id", "date_add(date'2025-12-01', cast(id % 100 as int)) AS fecha_limpia")
    path = scratch_path(spark, "t_range")
    up.write_days(df, path)
    got = up.consolidate(spark, path, "2025-12-30", "2026-02-02")
    assert got.count() == 4 * 35 and len(got.inputFiles()) == 35
    with pytest.raises(FileNotFoundError):
        up.consolidate(spark, path, "2027-01-01", "2027-02-01")


def test_posts_by_day_small_days_have_one_file(spark):
    from tickloom.sources import files as io
    raw = spark.range(200).selectExpr("cast(id as string) AS ID_Tweet", "if(id = 7, 'x', concat('2026-01-', lpad(id % 20 + 1, 2, '0'), ' 10:00:00')) AS Fecha_UTC")
    path = scratch_path(spark, "t_posts_by_day")
    assert io.partition_by_day(raw.repartition(8), path, "Fecha_UTC", "yyyy-MM-dd HH:mm:ss") == 1
    assert len([f for _, _, names in os.walk(path) for f in names if f.endswith(".csv")]) == 20
    assert spark.read.option("header", True).csv(path).count() == 199
