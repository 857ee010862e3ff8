import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import indicators as ind


def series(spark, closes, symbol="S", opens=None):
    start = dt.date(2024, 1, 1)
    data = [(symbol, start + dt.timedelta(days=i), float(c), float(opens[i] if opens else c), 100 + i)
            for i, c in enumerate(closes)]
    return spark.createDataFrame(data, "symbol string, date date, close double, open double, volume bigint")


def col_values(df, c):
    return [r[0] for r in df.orderBy("date").select(c).collect()]


def test_daily_return_first_row_null(spark):
    df = series(spark, [100, 110, 99])
    got = col_values(df.withColumn("r", ind.daily_return()), "r")
    assert got[0] is None
    assert got[1] == pytest.approx(0.1)
    assert got[2] == pytest.approx(-0.1)


def test_sma_null_until_n_rows(spark):
    df = series(spark, [1, 2, 3, 4, 5])
    got = col_values(df.withColumn("s", ind.sma(3)), "s")
    assert got[:2] == [None, None]
    assert got[2:] == pytest.approx([2.0, 3.0, 4.0])


def test_rsi_simple_mean_variant(spark):
    # flat then rising then flat: first row has no gain and no loss -> NULL;
    # only gains in the frame -> 100; both zero again only once the window
    # slides past every change.
    closes = [10, 10, 11, 12, 12]
    got = col_values(series(spark, closes).withColumn("rsi", ind.rsi(3)), "rsi")
    assert got[0] is None
    assert got[1] is None
    assert got[2] == 100.0
    assert got[3] == 100.0
    # a loss after gains: avg gain (1+0+0)/3? frame rows 3..5 deltas (1, 0, -1) -> 100 - 100/(1+1) = 50
    got2 = col_values(series(spark, [10, 11, 12, 11]).withColumn("rsi", ind.rsi(3)), "rsi")
    assert got2[3] == pytest.approx(100 - 100 / (1 + (2 / 3) / (1 / 3)))


def test_rsi_by_hand(spark):
    # deltas 0, 1, 1, -1, 2: means over 3 rows of gains 2/3 and losses 1/3, then 1 and 1/3
    got = col_values(series(spark, [10, 11, 12, 11, 13]).withColumn("rsi", ind.rsi(3)), "rsi")
    assert got[0] is None
    assert got[1:] == pytest.approx([100.0, 100.0, 200 / 3, 75.0])


def test_missing_closes(spark):
    """NaN is a missing value everywhere: no gain, no loss, no higher close."""
    df = series(spark, [1, 2, float("nan"), 3, 4])
    assert col_values(df.withColumn("t", ind.target_direction()), "t") == [1, 0, 0, 1, 0]
    assert col_values(df.withColumn("r", ind.rsi(3)), "r")[1:] == [100.0, 100.0, 100.0, 100.0]
    assert col_values(df.withColumn("d", ind.daily_return()), "d") == [None, 1.0, None, None, pytest.approx(1 / 3)]
    assert col_values(df.withColumn("s", ind.sma(2)), "s") == [None, 1.5, None, None, 3.5]
    assert col_values(ind.ema(df, {"E": 3}), "E") == pytest.approx([1, 1.5, 1.5, 2.25, 3.125])
    from tickloom.operators.features import drop_incomplete, fill_both_ways
    assert col_values(fill_both_ways(df, ["close"]), "close") == [1, 2, 3, 3, 4]
    assert drop_incomplete(df).count() == 4


def test_zero_first_close(spark):
    row = ind.return_stats(series(spark, [0, 2, 3])).collect()[0]
    assert row["total_return"] is None and row["mean_return"] == pytest.approx(0.5)


def test_macd_by_hand(spark):
    # spans 1 and 3: the fast mean is the close itself, the slow one 4, 5, 6.5; signal span 1 equals the line
    got = ind.macd(series(spark, [4, 6, 8]), fast=1, slow=3, sig=1).orderBy("date").collect()
    assert [r["EMA_Long"] for r in got] == [4.0, 5.0, 6.5]
    assert [r["MACD"] for r in got] == [0.0, 1.0, 1.5]
    assert [r["MACD_Histogram"] for r in got] == [0.0, 0.0, 0.0]


def test_target_direction_last_row_zero(spark):
    got = col_values(series(spark, [1, 2, 1, 3]).withColumn("t", ind.target_direction()), "t")
    assert got == [1, 0, 1, 0]


def test_volatility_first_value_on_row_11(spark):
    closes = [100 + (i % 3) for i in range(13)]
    df = series(spark, closes).withColumn("daily_return", ind.daily_return())
    got = col_values(df.withColumn("v", ind.rolling_std(10, "daily_return")), "v")
    assert all(v is None for v in got[:10])
    assert got[10] is not None
    expect = pd.Series(closes).pct_change().rolling(10).std().tolist()
    assert got[10] == pytest.approx(expect[10])


def test_ema_and_macd_match_pandas(spark):
    closes = [float(100 + ((i * 7) % 11) - i * 0.3) for i in range(60)]
    df = series(spark, closes).select("symbol", "date", "close")
    got = col_values(ind.ema(df, {"EMA": 20}), "EMA")
    expect = pd.Series(closes).ewm(span=20, adjust=False).mean().tolist()
    assert got == pytest.approx(expect)
    m = ind.macd(df).orderBy("date").collect()
    e12 = pd.Series(closes).ewm(span=12, adjust=False).mean()
    e26 = pd.Series(closes).ewm(span=26, adjust=False).mean()
    sig = (e12 - e26).ewm(span=9, adjust=False).mean()
    assert [r["Signal_Line"] for r in m] == pytest.approx(sig.tolist())


def test_indicator_readout_latest_row(spark):
    df = series(spark, [1.0, 2.0, 3.0]).withColumns({"RSI": F.lit(75.0), "MACD": F.lit(1.0), "Signal_Line": F.lit(0.5)})
    r = ind.indicator_readout(df).collect()[0]
    assert r["date"] == dt.date(2024, 1, 3)
    assert (r["rsi_reading"], r["macd_reading"]) == ("Sobrecompra", "Alcista")


def test_vix_regime_buckets_null_is_top(spark):
    df = spark.createDataFrame([(15.0,), (25.0,), (35.0,), (45.0,), (None,)], "close double")
    got = [r[0] for r in df.select(ind.vix_regime()).collect()]
    assert got == ["Bajo", "Moderado", "Alto", "Muy Alto", "Muy Alto"]


def test_intraday_change_rounds_half_even(spark):
    df = series(spark, [101.005] * 10, opens=[100.0] * 10)
    r = ind.intraday(df).orderBy("date").collect()
    assert r[0]["Evolucion_pct"] == round(1.005, 2)
    assert r[9]["Media_Movil_10"] == pytest.approx(101.0, abs=0.011)


def test_candidate_features(spark):
    df = series(spark, [1.0, 2.0, 3.0]).withColumns({"RSI": F.lit(20.0), "sentimiento_promedio": F.lit(0.5)})
    r = ind.candidate_features(df).orderBy("date").collect()
    assert [x["RSI_Signal"] for x in r] == [1, 1, 1]
    assert r[0]["Sentiment_Momentum"] == 0.5
    assert [x["Volume_Spike"] for x in r] == [0, 0, 0]
