import datetime as dt
import statistics
import time

import pytest
from hypothesis import given
from hypothesis import strategies as hs

from tickloom.session import scratch_path
from tickloom.streaming import late_posts as lp

SCHEMA = "tweet_id string, symbol string, fecha_utc timestamp, fecha_limpia date, puntuacion_sentimiento double"


def land(spark, src, rows):
    data = [(str(i), sym, None, d and dt.date(2026, 3, d), s) for i, sym, d, s in rows]
    df = spark.createDataFrame(data, SCHEMA)
    df.write.mode("append").parquet(src)
    return df.schema


def brute(rows):
    days = {}
    for _, sym, d, s in rows:
        if d:
            days.setdefault((sym, d), []).extend([] if s is None else [s])
    return {k: (len(v), statistics.fmean(v) if v else None, statistics.stdev(v) if len(v) > 1 else 0.0) for k, v in days.items()}


def check(table, rows):
    got = {(r["symbol"], r["fecha_limpia"].day): r for r in table.collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for k, (n, mean, std) in want.items():
        assert got[k]["volumen_posts"] == n
        assert got[k]["sentimiento_medio"] == (None if mean is None else pytest.approx(mean))
        assert got[k]["sentimiento_std"] == pytest.approx(std)
    return got


@given(hs.lists(hs.lists(hs.floats(-1e3, 1e3), min_size=1, max_size=8), min_size=1, max_size=6))
def test_merge_equals_the_whole(parts):
    n, mean, squares = 0, 0.0, 0.0
    for p in parts:
        m = statistics.fmean(p)
        n, mean, squares = lp.merge((n, mean, squares), (len(p), m, sum((x - m) ** 2 for x in p)))
    whole = [x for p in parts for x in p]
    assert n == len(whole) and mean == pytest.approx(statistics.fmean(whole), abs=1e-6)
    assert squares == pytest.approx(sum((x - statistics.fmean(whole)) ** 2 for x in whole), abs=1e-3)


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_late_posts_reopen_days_without_reading_them_again(spark, few_partitions):
    work = scratch_path(spark, "t_m3")
    src = f"{work}/landing"
    first = [(i, "S", 1 + i % 3, i / 50) for i in range(30)] + [(90, "T", 1, None), (91, None, 2, 0.4), (92, "S", None, 0.3)]
    schema = land(spark, src, first)
    got = check(lp.late_daily_sentiment(spark, src, schema, work, quiet_ms=1), first)
    assert all(r["deliveries"] == 1 and not r["closed"] for r in got.values())
    time.sleep(0.1)
    late = [(100, "S", 1, 0.9), (101, "S", 1, None), (102, "U", 9, 0.5), (103, "T", 1, 0.2)]
    land(spark, src, late)
    got = check(lp.late_daily_sentiment(spark, src, schema, work, quiet_ms=1), first + late)
    assert got["S", 1]["deliveries"] == 2 and not got["S", 1]["closed"]         # opened again
    assert got["S", 2]["closed"] and got["S", 2]["deliveries"] == 1             # quiet since: the timer closed it
    assert got["U", 9]["deliveries"] == 1 and not got["U", 9]["closed"]
    time.sleep(0.1)
    later = [(104, "S", 2, 0.7)]
    land(spark, src, later)
    got = check(lp.late_daily_sentiment(spark, src, schema, work, quiet_ms=1), first + late + later)
    assert not got["S", 2]["closed"] and got["S", 2]["deliveries"] == 2
