"""SMA crossover strategy, grid search, periods and Monte Carlo on the
smoothed price series."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.exprs import rnd as R
from ..operators import strategy as sg
from ..sources import fixtures as fx
from ..sources.fixtures import GRID_LONG, GRID_SHORT
from .oracle import dbl, rolling_sql, with_views
from .q_backtest import metrics_ctes
from .registry import register

CAP = 100_000.0


def series(spark, sf):
    return fx.px(spark, sf).select("symbol", "date", F.col("px").alias("close"))


def book(spark, sf, short=10, long=200):
    return sg.crossover_backtest(sg.crossover_signals(series(spark, sf), short, long), CAP)


def grid(spark, sf):
    return sg.grid_metrics(series(spark, sf), CAP)


SERIES = ("series", "SELECT symbol, date, px AS close FROM px")


def bt_ctes(keys: str, src: str = "sig"):
    w = f"PARTITION BY {keys} ORDER BY date"
    wr = f"{w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return [
        ("bt0", f"SELECT *, CASE WHEN lag(close) OVER ({w}) = 0 THEN NULL ELSE close / lag(close) OVER ({w}) - 1 END AS Returns FROM {src}"),
        ("bt1", f"SELECT *, Returns * lag(Signal) OVER ({w}) AS Strategy_Returns FROM bt0"),
        ("ob", f"""SELECT *, CASE WHEN Returns IS NOT NULL THEN {dbl(CAP)} * product(1 + Returns) OVER ({wr}) END AS Buy_Hold_Equity,
                          CASE WHEN Strategy_Returns IS NOT NULL THEN {dbl(CAP)} * product(1 + Strategy_Returns) OVER ({wr}) END AS Strategy_Equity,
                          coalesce(Position = 1, false) AS Buy_Signal, coalesce(Position = -1, false) AS Sell_Signal FROM bt1"""),
    ]


def sig_ctes(short=10, long=200):
    return [
        SERIES,
        ("k0", f"SELECT symbol, date, close, {rolling_sql('avg', 'close', short)} AS s, {rolling_sql('avg', 'close', long)} AS l FROM series"),
        ("k1", "SELECT *, CAST(coalesce(s > l, false) AS INTEGER) AS Signal FROM k0"),
        ("k2", "SELECT *, CAST(Signal - lag(Signal) OVER (PARTITION BY symbol ORDER BY date) AS DOUBLE) AS Position FROM k1"),
        ("sig", "SELECT * FROM k2 WHERE l IS NOT NULL AND Position IS NOT NULL"),
    ]


ONE = sig_ctes() + bt_ctes("symbol") + metrics_ctes(CAP, "ob", "symbol", "close")

_LENGTHS = sorted(set(GRID_SHORT) | set(GRID_LONG))
GRID_CTES = [
    SERIES,
    ("g0", "SELECT symbol, date, close, " + ", ".join(f"{rolling_sql('avg', 'close', n)} AS sma{n}" for n in _LENGTHS)
     + " FROM series"),
    ("g1", "SELECT g0.symbol, g0.date, g0.close, p.short, p.long, CASE p.short "
     + " ".join(f"WHEN {n} THEN sma{n}" for n in GRID_SHORT) + " END AS s, CASE p.long "
     + " ".join(f"WHEN {n} THEN sma{n}" for n in GRID_LONG) + " END AS l FROM g0 CROSS JOIN params p"),
    ("g2", "SELECT *, CAST(coalesce(s > l, false) AS INTEGER) AS Signal FROM g1"),
    ("g3", "SELECT *, CAST(Signal - lag(Signal) OVER (PARTITION BY symbol, short, long ORDER BY date) AS DOUBLE) AS Position FROM g2"),
    ("sig", "SELECT * FROM g3 WHERE l IS NOT NULL AND Position IS NOT NULL"),
] + bt_ctes("symbol, short, long") + metrics_ctes(CAP, "ob", "symbol, short, long", "close")

VIEWS = ["px", "params"]


@register("k1_crossover_signal", with_views(VIEWS, "SELECT symbol, date, Signal, Position FROM sig", ONE))
def q_k1(spark, sf):
    return sg.crossover_signals(series(spark, sf)).select("symbol", "date", "Signal", "Position")


@register("k2_crossover_backtest", with_views(VIEWS, """
    SELECT symbol, date, round(Returns, 8) AS Returns, round(Strategy_Returns, 8) AS Strategy_Returns,
           round(Buy_Hold_Equity, 2) AS Buy_Hold_Equity, round(Strategy_Equity, 2) AS Strategy_Equity,
           CAST(Buy_Signal AS INTEGER) AS Buy_Signal, CAST(Sell_Signal AS INTEGER) AS Sell_Signal FROM ob""", ONE))
def q_k2(spark, sf):
    b = book(spark, sf)
    return b.select("symbol", "date", R("Returns", 8).alias("Returns"), R("Strategy_Returns", 8).alias("Strategy_Returns"),
                    R("Buy_Hold_Equity", 2).alias("Buy_Hold_Equity"), R("Strategy_Equity", 2).alias("Strategy_Equity"),
                    F.col("Buy_Signal").cast("int").alias("Buy_Signal"), F.col("Sell_Signal").cast("int").alias("Sell_Signal"))


K3_COLS = ["strategy_return", "bh_return", "sharpe", "sharpe_bh", "sortino", "sortino_bh", "max_dd", "max_dd_bh",
           "calmar", "win_rate", "avg_win", "avg_loss"]


@register("k3_crossover_metrics", with_views(VIEWS, "SELECT symbol, num_trades, "
                                            + ", ".join(f"round({c}, 6) AS {c}" for c in K3_COLS) + " FROM met", ONE))
def q_k3(spark, sf):
    m = sg.crossover_metrics(book(spark, sf), CAP)
    return m.select("symbol", "num_trades", *[R(c, 6).alias(c) for c in K3_COLS])


K4_COLS = ["strategy_return", "sharpe", "max_dd"]


@register("k4_parameter_grid", with_views(VIEWS, "SELECT symbol, short, long, num_trades, "
                                         + ", ".join(f"round({c}, 6) AS {c}" for c in K4_COLS) + " FROM met", GRID_CTES))
def q_k4(spark, sf):
    g = grid(spark, sf)
    return g.select("symbol", "short", "long", "num_trades", *[R(c, 6).alias(c) for c in K4_COLS])


def _best_sql(metric, label):
    return (f"SELECT symbol, short AS {label}_short, long AS {label}_long FROM ("
            f"SELECT symbol, short, long, row_number() OVER (PARTITION BY symbol ORDER BY round({metric}, 9) DESC, short, long) AS k "
            f"FROM met) WHERE k = 1")


@register("k5_best_configs", with_views(VIEWS, f"""
    SELECT * FROM ({_best_sql('strategy_return', 'best_return')}) a
    JOIN ({_best_sql('sharpe', 'best_sharpe')}) b USING (symbol)
    JOIN ({_best_sql('max_dd', 'best_drawdown')}) c USING (symbol)""", GRID_CTES))
def q_k5(spark, sf):
    out = sg.best_configs(grid(spark, sf))
    return out.select("symbol", *[F.col(f"{lbl}.{p}").alias(f"{lbl}_{p}")
                                  for lbl in ("best_return", "best_sharpe", "best_drawdown") for p in ("short", "long")])


@register("k6_sharpe_pivot", with_views(VIEWS, "SELECT symbol, short, "
                                       + ", ".join(f"round(max(CASE WHEN long = {lg} THEN sharpe END), 6) AS \"{lg}\""
                                                   for lg in GRID_LONG) + " FROM met GROUP BY symbol, short", GRID_CTES))
def q_k6(spark, sf):
    g = grid(spark, sf).withColumn("sharpe", R("sharpe", 6))
    return sg.sharpe_pivot(g)


# Labels and order of the compared metrics.
K7_METRICS = [("Retorno Total (%)", "strategy_return", "bh_return"), ("Sharpe Ratio", "sharpe", "sharpe_bh"),
              ("Max Drawdown (%)", "max_dd", "max_dd_bh")]


def _k7_sql():
    rows = []
    for i, (name, col, bh) in enumerate(K7_METRICS):
        rows.append(f"SELECT symbol, 'Original (10/200)' AS strategy, {i} AS metric_order, '{name}' AS metric, "
                    f"round({col}, 6) AS value FROM met WHERE short = 10 AND long = 200")
        rows.append(f"SELECT m.symbol, 'Optimizada (' || m.short || '/' || m.long || ')', {i}, '{name}', round(m.{col}, 6) "
                    f"FROM met m JOIN best b ON m.symbol = b.symbol AND m.short = b.best_sharpe_short AND m.long = b.best_sharpe_long")
        rows.append(f"SELECT symbol, 'Buy & Hold', {i}, '{name}', round({bh}, 6) FROM met WHERE short = 10 AND long = 200")
    rows.append("SELECT symbol, 'Original (10/200)', 3, 'Número de Trades', CAST(num_trades AS DOUBLE) FROM met "
                "WHERE short = 10 AND long = 200")
    rows.append("SELECT m.symbol, 'Optimizada (' || m.short || '/' || m.long || ')', 3, 'Número de Trades', "
                "CAST(m.num_trades AS DOUBLE) FROM met m JOIN best b ON m.symbol = b.symbol "
                "AND m.short = b.best_sharpe_short AND m.long = b.best_sharpe_long")
    rows.append("SELECT symbol, 'Buy & Hold', 3, 'Número de Trades', 0.0::DOUBLE FROM met WHERE short = 10 AND long = 200")
    return " UNION ALL ".join(rows)


@register("k7_strategy_comparison", with_views(VIEWS, _k7_sql(), GRID_CTES + [("best", _best_sql("sharpe", "best_sharpe"))]))
def q_k7(spark, sf):
    """One pass over the grid metrics: rank the 24 configurations of each
    symbol by Sharpe (ties: first in grid order) with a window over those
    rows, keep the original and the best, and fan each kept row out into its
    labelled strategies and metrics."""
    from pyspark.sql import Window
    w = Window.partitionBy("symbol").orderBy(R("sharpe", sg.RANK_DIGITS).desc_nulls_last(), "short", "long")
    g = grid(spark, sf).withColumn("_rk", F.row_number().over(w))
    is_orig = (F.col("short") == 10) & (F.col("long") == 200)
    g = g.where(is_orig | (F.col("_rk") == 1))
    opt_label = F.concat(F.lit("Optimizada ("), F.col("short"), F.lit("/"), F.col("long"), F.lit(")"))

    def metric_rows(cols, trades):
        return F.array(*[F.struct(F.lit(i).alias("metric_order"), F.lit(name).alias("metric"),
                                  R(F.col(c), 6).alias("value")) for i, (name, c) in enumerate(cols)],
                       F.struct(F.lit(3).alias("metric_order"), F.lit("Número de Trades").alias("metric"),
                                trades.cast("double").alias("value")))
    names = [(n, c) for n, c, _ in K7_METRICS]
    bh = [(n, b) for n, _, b in K7_METRICS]
    strategies = F.array(
        F.struct(F.lit("Original (10/200)").alias("strategy"), is_orig.alias("keep"),
                 metric_rows(names, F.col("num_trades")).alias("rows")),
        F.struct(opt_label.alias("strategy"), (F.col("_rk") == 1).alias("keep"),
                 metric_rows(names, F.col("num_trades")).alias("rows")),
        F.struct(F.lit("Buy & Hold").alias("strategy"), is_orig.alias("keep"),
                 metric_rows(bh, F.lit(0)).alias("rows")))
    s = g.select("symbol", F.explode(F.filter(strategies, lambda x: x["keep"])).alias("s"))
    r = s.select("symbol", F.col("s.strategy").alias("strategy"), F.explode("s.rows").alias("m"))
    return r.select("symbol", "strategy", F.col("m.metric_order").alias("metric_order"),
                    F.col("m.metric").alias("metric"), F.col("m.value").alias("value"))


OPT = GRID_CTES + [("bestcfg", _best_sql("sharpe", "b")),
                   ("optob", "SELECT ob.* FROM ob JOIN bestcfg c ON ob.symbol = c.symbol AND ob.short = c.b_short "
                             "AND ob.long = c.b_long")]


def opt_book(spark, sf):
    return sg.optimized_book(series(spark, sf), CAP)


K8_SQL = f"""
    SELECT symbol, period,
           round((arg_max_null(Strategy_Equity, date) / arg_min_null(Strategy_Equity, date) - 1) * 100, 6) AS strategy_return,
           round((arg_max_null(Buy_Hold_Equity, date) / arg_min_null(Buy_Hold_Equity, date) - 1) * 100, 6) AS bh_return,
           round(stddev_samp(Strategy_Returns) * {dbl(sg.SQRT252)} * 100, 6) AS strategy_vol,
           round(stddev_samp(Returns) * {dbl(sg.SQRT252)} * 100, 6) AS bh_vol,
           count(*) FILTER (WHERE Buy_Signal) AS trades
    FROM optob ob JOIN periods p ON ob.date BETWEEN p.start AND p."end" GROUP BY symbol, period"""


@register("k8_period_performance", with_views(VIEWS + ["periods"], K8_SQL, OPT))
def q_k8(spark, sf):
    p = sg.period_performance(opt_book(spark, sf))
    return p.select("symbol", "period", *[R(c, 6).alias(c) for c in ("strategy_return", "bh_return", "strategy_vol",
                                                                     "bh_vol")], "trades")


@register("k9_best_worst_period", with_views(VIEWS + ["periods"], """
    SELECT symbol, arg_max(period, strategy_return) AS best_period, arg_min(period, strategy_return) AS worst_period
    FROM k8 GROUP BY symbol""", OPT + [("k8", K8_SQL)]))
def q_k9(spark, sf):
    return sg.best_worst_period(sg.period_performance(opt_book(spark, sf)))


_PARTS = "'42:' || p.symbol || ':' || CAST(path AS VARCHAR) || ':' || CAST(day AS VARCHAR) || ':"
_U = "(CAST('0x' || substr(md5(" + _PARTS + "{n}'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE"
K10_CTES = [
    ("stats", "SELECT symbol, avg(Strategy_Returns) AS mu, stddev_samp(Strategy_Returns) AS sigma FROM optob "
              "WHERE Strategy_Returns IS NOT NULL GROUP BY symbol"),
    ("draws", f"""SELECT p.symbol, path, mu, sigma, {_U.format(n=1)} AS u1, {_U.format(n=2)} AS u2
                  FROM stats p CROSS JOIN range(1000) a(path) CROSS JOIN range(252) d(day)"""),
    ("ends", f"""SELECT symbol, path, {dbl(CAP)} * product(1 + mu + sigma * sqrt(-2 * ln(u1)) * cos({dbl(2 * math.pi)} * u2)) AS v
                 FROM draws GROUP BY symbol, path"""),
]


@register("k10_monte_carlo", with_views(VIEWS, f"""
    SELECT symbol, {', '.join(f"round(quantile_cont(v, {q / 100}), 2) AS p{q}" for q in (5, 25, 50, 75, 95))},
           round(count(*) FILTER (WHERE v < {dbl(CAP)}) * 100.0 / count(*), 4) AS p_loss_pct,
           round((avg(v) / {dbl(CAP)} - 1) * 100, 4) AS expected_return_pct, count(*) AS paths FROM ends GROUP BY symbol""", OPT + K10_CTES))
def q_k10(spark, sf):
    mc = sg.monte_carlo(opt_book(spark, sf), n_paths=1000, n_days=252, capital=CAP, seed=42)
    return mc.select("symbol", *[R(c, 2).alias(c) for c in ("p5", "p25", "p50", "p75", "p95")],
                     R("p_loss_pct", 4).alias("p_loss_pct"), R("expected_return_pct", 4).alias("expected_return_pct"),
                     "paths")


@register("k11_trade_log", with_views(VIEWS, """
    SELECT symbol, date, round(close, 6) AS close, CAST(Buy_Signal AS INTEGER) AS Buy_Signal,
           CAST(Sell_Signal AS INTEGER) AS Sell_Signal FROM optob WHERE Buy_Signal OR Sell_Signal""", OPT))
def q_k11(spark, sf):
    t = sg.trade_log(opt_book(spark, sf))
    return t.select("symbol", "date", R("close", 6).alias("close"), F.col("Buy_Signal").cast("int").alias("Buy_Signal"),
                    F.col("Sell_Signal").cast("int").alias("Sell_Signal"))
