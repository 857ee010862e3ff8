"""Price and technical-indicator queries over the daily bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import indicators as ind
from ..sources import fixtures as fx
from ..sources.tables import read_table
from .oracle import dbl, rolling_sql, rows, win, with_views
from .registry import register

from ..functions.exprs import rnd as R  # noqa: E402

# ------------------------------------------------------------------ shared SQL

IND_CTES = [
    ("ind0", f"""
        SELECT *, CASE WHEN lag(close) OVER ({win()}) = 0 THEN NULL
                       ELSE close / lag(close) OVER ({win()}) - 1 END AS daily_return,
               coalesce(close - lag(close) OVER ({win()}), 0.0) AS delta
        FROM bars"""),
    ("ind", f"""
        SELECT symbol, date, open, high, low, close, volume,
               CASE WHEN ag = 0 AND al = 0 THEN NULL WHEN al = 0 THEN 100.0
                    ELSE 100.0 - 100.0 / (1.0 + ag / al) END AS RSI,
               daily_return, SMA_10, SMA_50, volatilidad_10d, target_direction
        FROM (SELECT *,
                     avg(greatest(delta, 0.0)) OVER ({win(frame=rows(14))}) AS ag,
                     avg(greatest(-delta, 0.0)) OVER ({win(frame=rows(14))}) AS al,
                     {rolling_sql('avg', 'close', 10)} AS SMA_10,
                     {rolling_sql('avg', 'close', 50)} AS SMA_50,
                     {rolling_sql('stddev_samp', 'daily_return', 10)} AS volatilidad_10d,
                     CAST(coalesce(lead(close) OVER ({win()}) > close, false) AS INTEGER) AS target_direction
              FROM ind0)"""),
]


def ind_sql(body: str, views=("bars",), extra=None) -> str:
    return with_views(views, body, IND_CTES + (extra or []))


def _alpha(span: int) -> tuple[str, str]:
    a = 1.0 / (1.0 + (span - 1) / 2.0)
    return dbl(a), dbl(1.0 - a)


def ema_step(prev: str, cur: str, span: int) -> str:
    """One adjust=False EMA step written as pandas evaluates it."""
    a, b = _alpha(span)
    return f"(CASE WHEN {prev} <> {cur} THEN (({b} * {prev}) + ({a} * {cur})) / ({b} + {a}) ELSE {prev} END)"


MACD_CTES = [
    ("b", "SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM bars"),
    ("m(symbol, rn, date, close, e12, e26, sig)", f"""
        SELECT symbol, rn, date, close, close, close, close - close FROM b WHERE rn = 1
        UNION ALL
        SELECT symbol, rn, date, close, n12, n26, {ema_step('sig', '(n12 - n26)', 9)}
        FROM (SELECT b.symbol, b.rn, b.date, b.close, e.sig,
                     {ema_step('e.e12', 'b.close', 12)} AS n12, {ema_step('e.e26', 'b.close', 26)} AS n26
              FROM m e JOIN b ON b.symbol = e.symbol AND b.rn = e.rn + 1)"""),
]


# ------------------------------------------------------------------- queries

def indicator_table(spark, sf):
    return ind.with_indicators(fx.bars(spark, sf))


def _ind_out(df):
    return df.select("symbol", "date", R("RSI", 6).alias("RSI"), R("daily_return", 8).alias("daily_return"),
                     R("SMA_10", 6).alias("SMA_10"), R("SMA_50", 6).alias("SMA_50"),
                     R("volatilidad_10d", 8).alias("volatilidad_10d"), "target_direction")


IND_OUT_SQL = ("SELECT symbol, date, round(RSI, 6) AS RSI, round(daily_return, 8) AS daily_return, "
               "round(SMA_10, 6) AS SMA_10, round(SMA_50, 6) AS SMA_50, "
               "round(volatilidad_10d, 8) AS volatilidad_10d, target_direction FROM ind")


@register("d1_d5_indicators", ind_sql(IND_OUT_SQL))
def q_indicators(spark, sf):
    return _ind_out(indicator_table(spark, sf))


@register("d1_daily_return", ind_sql("SELECT symbol, date, round(daily_return, 8) AS daily_return FROM ind"))
def q_d1(spark, sf):
    b = fx.bars(spark, sf)
    return b.select("symbol", "date", R(ind.daily_return(), 8).alias("daily_return"))


@register("d2_sma", ind_sql(f"""SELECT symbol, date, round(SMA_10, 6) AS SMA_10, round(SMA_50, 6) AS SMA_50,
                                  round({rolling_sql('avg', 'close', 200)}, 6) AS SMA_200 FROM ind"""))
def q_d2(spark, sf):
    b = fx.bars(spark, sf)
    return b.select("symbol", "date", *[R(ind.sma(n), 6).alias(f"SMA_{n}") for n in (10, 50, 200)])


@register("d3_volatility_10d", ind_sql("SELECT symbol, date, round(volatilidad_10d, 8) AS volatilidad_10d FROM ind"))
def q_d3(spark, sf):
    return indicator_table(spark, sf).select("symbol", "date", R("volatilidad_10d", 8).alias("volatilidad_10d"))


@register("d4_rsi", ind_sql("SELECT symbol, date, round(RSI, 6) AS RSI FROM ind"))
def q_d4(spark, sf):
    b = fx.bars(spark, sf)
    return b.select("symbol", "date", R(ind.rsi(14), 6).alias("RSI"))


@register("d5_target_direction", ind_sql("SELECT symbol, date, target_direction FROM ind"))
def q_d5(spark, sf):
    return fx.bars(spark, sf).select("symbol", "date", ind.target_direction().alias("target_direction"))


_EMA_CTES = [
    ("b", "SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM bars"),
    ("e(symbol, rn, date, ema)", f"""
        SELECT symbol, rn, date, close FROM b WHERE rn = 1
        UNION ALL
        SELECT b.symbol, b.rn, b.date, {ema_step('e.ema', 'b.close', 20)}
        FROM e JOIN b ON b.symbol = e.symbol AND b.rn = e.rn + 1"""),
]


@register("d6_ema", with_views(["bars"], "SELECT symbol, date, round(ema, 4) AS EMA FROM e", _EMA_CTES, recursive=True))
def q_d6(spark, sf):
    b = fx.bars(spark, sf).select("symbol", "date", "close")
    return ind.ema(b, {"EMA": 20}).select("symbol", "date", R("EMA", 4).alias("EMA"))


@register("d7_macd", with_views(["bars"], """
        SELECT symbol, date, round(e12 - e26, 4) AS MACD, round(sig, 4) AS Signal_Line,
               round((e12 - e26) - sig, 4) AS MACD_Histogram FROM m""", MACD_CTES, recursive=True))
def q_d7(spark, sf):
    b = fx.bars(spark, sf).select("symbol", "date", "close")
    return ind.macd(b).select("symbol", "date", R("MACD", 4).alias("MACD"), R("Signal_Line", 4).alias("Signal_Line"),
                              R("MACD_Histogram", 4).alias("MACD_Histogram"))


@register("d8_indicator_readout", with_views(["bars"], """
        SELECT symbol, max(date) AS date, round(arg_max(RSI, date), 4) AS RSI, round(arg_max(e12 - e26, date), 4) AS MACD,
               CASE WHEN arg_max(RSI, date) > 70 THEN 'Sobrecompra' WHEN arg_max(RSI, date) < 30 THEN 'Sobreventa'
                    ELSE 'Neutral' END AS rsi_reading,
               CASE WHEN arg_max(e12 - e26, date) > arg_max(sig, date) THEN 'Alcista' ELSE 'Bajista' END AS macd_reading
        FROM (SELECT m.*, i.RSI FROM m JOIN ind i USING (symbol, date)) GROUP BY symbol""",
        IND_CTES + MACD_CTES, recursive=True))
def q_d8(spark, sf):
    b = fx.bars(spark, sf).select("symbol", "date", "close")
    t = ind.macd(b.withColumn("RSI", ind.rsi(14)))
    out = ind.indicator_readout(t)
    return out.select("symbol", "date", R("RSI", 4).alias("RSI"), R("MACD", 4).alias("MACD"),
                      "rsi_reading", "macd_reading")


@register("d9_intraday_change", with_views(["bars"], f"""
        SELECT symbol, date, round_even(CASE WHEN open = 0 THEN NULL ELSE (close - open) / open END * 100 * 100, 0) / 100 AS Evolucion_pct,
               round_even(CASE WHEN count(close) OVER ({win(frame=rows(10))}) >= 10 THEN CAST(sum(CAST(round(close * 100) AS BIGINT)) OVER ({win(frame=rows(10))}) AS DOUBLE) / count(close) OVER ({win(frame=rows(10))}) / 100 END * 100, 0) / 100 AS Media_Movil_10 FROM bars"""))
def q_d9(spark, sf):
    return ind.intraday(fx.bars(spark, sf)).select("symbol", "date", "Evolucion_pct", "Media_Movil_10")


VIX_BUCKET_SQL = ("CASE WHEN close < 20 THEN 'Bajo' WHEN close < 30 THEN 'Moderado' "
                  "WHEN close < 40 THEN 'Alto' ELSE 'Muy Alto' END")


@register("d10_vix_regime", with_views(["vix"], f"SELECT date, close, {VIX_BUCKET_SQL} AS VIX_Category FROM vix"))
def q_d10(spark, sf):
    v = fx.vix(spark, sf)
    return v.select("date", "close", ind.vix_regime("close").alias("VIX_Category"))


@register("d11_regime_distribution", with_views(["vix"], f"""
        SELECT VIX_Category, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM vix), 6) AS pct
        FROM (SELECT {VIX_BUCKET_SQL} AS VIX_Category FROM vix) GROUP BY 1"""))
def q_d11(spark, sf):
    v = fx.vix(spark, sf).select(ind.vix_regime("close").alias("VIX_Category"))
    d = ind.distribution(v, "VIX_Category")
    return d.select("VIX_Category", "n", R("pct", 6).alias("pct"))


@register("d12_return_stats", with_views(["bars"], f"""
        SELECT symbol, round(avg(r), 8) AS mean_return, round(stddev_samp(r), 8) AS daily_std,
               round(stddev_samp(r) * sqrt(252), 8) AS annual_std,
               round(arg_max(close, date) / arg_min(close, date) - 1, 8) AS total_return
        FROM (SELECT symbol, date, close, close / lag(close) OVER ({win()}) - 1 AS r FROM bars) GROUP BY symbol"""))
def q_d12(spark, sf):
    s = ind.return_stats(fx.bars(spark, sf))
    return s.select("symbol", *[R(c, 8).alias(c) for c in ("mean_return", "daily_std", "annual_std", "total_return")])


@register("d13_candle_direction", with_views(["bars"], """
        SELECT symbol, date, CASE WHEN close >= open THEN 'g' ELSE 'r' END AS candle
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM bars) WHERE k <= 252"""))
def q_d13(spark, sf):
    return ind.candle_direction(fx.bars(spark, sf), 252).select("symbol", "date", "candle")


def company_info(spark, sf):
    """A company-info record per symbol derived from the customer table:
    balances give assets and debt; a low-balance segment has no dividend."""
    c = read_table(spark, sf, "customer").select("c_mktsegment", "c_acctbal")
    a = F.col("c_acctbal")
    return c.groupBy(F.col("c_mktsegment").alias("symbol")).agg(
        F.sum(F.when(a > 0, a)).alias("total_assets"),
        F.sum(F.when(a < 0, -a)).alias("total_debt"),
        F.sum(a).alias("market_cap"),
        F.when(F.avg(a) > 4500, F.avg(a) / 100000).alias("dividend_yield"),
        (F.avg(a) / F.max(a)).alias("profit_margins"))


COMPANY_INFO_SQL = ("company_info", """
        SELECT c_mktsegment AS symbol, sum(CASE WHEN c_acctbal > 0 THEN c_acctbal END) AS total_assets,
               sum(CASE WHEN c_acctbal < 0 THEN -c_acctbal END) AS total_debt, sum(c_acctbal) AS market_cap,
               CASE WHEN avg(c_acctbal) > 4500 THEN avg(c_acctbal) / 100000 END AS dividend_yield,
               avg(c_acctbal) / max(c_acctbal) AS profit_margins
        FROM customer GROUP BY 1""")


@register("d14_fundamental_ratios", with_views([], """
        SELECT symbol, round(CASE WHEN total_debt IS NOT NULL AND total_assets IS NOT NULL AND total_assets <> 0
                                  THEN total_debt / total_assets END, 6) AS debt_to_assets,
               CASE WHEN dividend_yield IS NOT NULL AND dividend_yield <> 0 THEN printf('%.2f%%', dividend_yield * 100)
                    ELSE '0%' END AS dividend_text,
               printf('%.2f%%', coalesce(profit_margins, 0.0) * 100) AS margin_text,
               round(coalesce(market_cap, 0.0), 2) AS market_cap
        FROM company_info""", [COMPANY_INFO_SQL]))
def q_d14(spark, sf):
    r = ind.fundamental_ratios(company_info(spark, sf))
    return r.select("symbol", R("debt_to_assets", 6).alias("debt_to_assets"), "dividend_text", "margin_text",
                    R("market_cap", 2).alias("market_cap"))
