"""Order book, equity, risk metrics and simulations over model signals."""

from __future__ import annotations

import functools
import math

from pyspark.sql import functions as F

from ..functions.exprs import rnd as R
from ..operators import backtest as bt
from ..session import scratch_path
from ..sources import fixtures as fx
from .oracle import dbl, with_views
from .registry import register

K = "model, symbol"
W = f"PARTITION BY {K} ORDER BY date"
WR = f"{W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
SQ = dbl(math.sqrt(252))


def ob_ctes(capital: float, first_row_position: bool, src: str = "preds", name: str = "ob"):
    cap = dbl(capital)
    pos = ("CASE WHEN prev_sig IS NULL THEN predicted_signal ELSE predicted_signal - prev_sig END"
           if first_row_position else "predicted_signal - prev_sig")
    return [
        (f"{name}0", f"""
            SELECT *, coalesce(CASE WHEN lag(price_close) OVER ({W}) = 0 THEN NULL
                                    ELSE price_close / lag(price_close) OVER ({W}) - 1 END, 0.0) AS Returns,
                   lag(predicted_signal) OVER ({W}) AS prev_sig
            FROM {src}"""),
        (f"{name}1", f"""
            SELECT *, {cap} * product(1 + Returns) OVER ({WR}) AS Buy_Hold_Equity,
                   Returns * CAST(coalesce(prev_sig, 0) AS DOUBLE) AS Strategy_Returns,
                   CAST({pos} AS DOUBLE) AS Position
            FROM {name}0"""),
        (name, f"""
            SELECT *, {cap} * product(1 + Strategy_Returns) OVER ({WR}) AS Strategy_Equity,
                   coalesce(Position = 1, false) AS Buy_Signal, coalesce(Position = -1, false) AS Sell_Signal,
                   CASE WHEN coalesce(Position = 1, false) THEN 'COMPRA' WHEN coalesce(Position = -1, false) THEN 'VENTA'
                        WHEN predicted_signal = 1 THEN 'MANTENER_POSICION' ELSE 'MANTENER_LIQUIDEZ' END AS Trading_Action
            FROM {name}1"""),
    ]


def metrics_ctes(capital: float, src: str = "ob", keys: str = K, price: str = "price_close"):
    cap = dbl(capital)
    W = f"PARTITION BY {keys} ORDER BY date"  # noqa: N806
    WR = f"{W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"  # noqa: N806
    kc = len(keys.split(","))
    gb = ", ".join(str(i + 1) for i in range(kc))
    return [
        ("mdd", f"""
            SELECT *, (Buy_Hold_Equity - max(Buy_Hold_Equity) OVER ({WR})) / max(Buy_Hold_Equity) OVER ({WR}) AS dd_bh,
                      (Strategy_Equity - max(Strategy_Equity) OVER ({WR})) / max(Strategy_Equity) OVER ({WR}) AS dd_st
            FROM {src}"""),
        ("m0", f"""
            SELECT {keys}, count(*) AS days,
                   (arg_max(Strategy_Equity, date) / {cap} - 1) * 100 AS strategy_return,
                   (arg_max(Buy_Hold_Equity, date) / {cap} - 1) * 100 AS bh_return,
                   CASE WHEN stddev_samp(Strategy_Returns) = 0 THEN 0.0
                        ELSE {SQ} * avg(Strategy_Returns) / stddev_samp(Strategy_Returns) END AS sharpe,
                   CASE WHEN stddev_samp(Returns) = 0 THEN 0.0 ELSE {SQ} * avg(Returns) / stddev_samp(Returns) END AS sharpe_bh,
                   CASE WHEN stddev_samp(CASE WHEN Strategy_Returns < 0 THEN Strategy_Returns END) = 0 THEN 0.0
                        ELSE {SQ} * avg(Strategy_Returns) / stddev_samp(CASE WHEN Strategy_Returns < 0 THEN Strategy_Returns END) END AS sortino,
                   CASE WHEN stddev_samp(CASE WHEN Returns < 0 THEN Returns END) = 0 THEN 0.0
                        ELSE {SQ} * avg(Returns) / stddev_samp(CASE WHEN Returns < 0 THEN Returns END) END AS sortino_bh,
                   min(dd_st) * 100 AS max_dd, min(dd_bh) * 100 AS max_dd_bh,
                   count(*) FILTER (WHERE Buy_Signal) AS num_trades
            FROM mdd GROUP BY {keys}"""),
        ("ev", f"""
            SELECT {keys}, date, {price} AS price_close, row_number() OVER ({W}) - 1 AS e
            FROM {src} WHERE Buy_Signal OR Sell_Signal"""),
        ("pairs", f"""
            SELECT {keys}, CAST(floor(e / 2) AS BIGINT) AS pair, min(date) AS open_date, max(date) AS close_date,
                   arg_min(price_close, e) AS p_open, arg_max(price_close, e) AS p_close,
                   (arg_max(price_close, e) - arg_min(price_close, e)) / arg_min(price_close, e) AS trade_return
            FROM ev GROUP BY {gb}, {kc + 1} HAVING count(*) = 2"""),
        ("tstats", f"""
            SELECT {keys}, count(*) AS n_pairs,
                   coalesce(count(*) FILTER (WHERE trade_return > 0) * 100.0 / count(*), 0.0) AS win_rate,
                   coalesce(avg(CASE WHEN trade_return > 0 THEN trade_return END) * 100, 0.0) AS avg_win,
                   coalesce(avg(CASE WHEN trade_return < 0 THEN trade_return END) * 100, 0.0) AS avg_loss
            FROM pairs GROUP BY {gb}"""),
        ("met", f"""
            SELECT m0.*, CASE WHEN max_dd = 0 THEN 0.0 ELSE strategy_return / abs(max_dd) END AS calmar,
                   CASE WHEN max_dd_bh = 0 THEN 0.0 ELSE bh_return / abs(max_dd_bh) END AS calmar_bh,
                   coalesce(t.n_pairs, 0) AS n_pairs, coalesce(t.win_rate, 0.0) AS win_rate,
                   coalesce(t.avg_win, 0.0) AS avg_win, coalesce(t.avg_loss, 0.0) AS avg_loss
            FROM m0 LEFT JOIN tstats t USING ({keys})"""),
    ]


BOOK_COLS = ["Returns", "Buy_Hold_Equity", "Strategy_Returns", "Strategy_Equity"]


def _book_out(df):
    return df.select("model", "symbol", "date", "price_close", "predicted_signal",
                     R("Returns", 8).alias("Returns"), R("Buy_Hold_Equity", 2).alias("Buy_Hold_Equity"),
                     R("Strategy_Returns", 8).alias("Strategy_Returns"),
                     R("Strategy_Equity", 2).alias("Strategy_Equity"), "Position",
                     F.col("Buy_Signal").cast("int").alias("Buy_Signal"),
                     F.col("Sell_Signal").cast("int").alias("Sell_Signal"), "Trading_Action")


BOOK_SQL = """SELECT model, symbol, date, round(price_close, 6) AS price_close, predicted_signal,
       round(Returns, 8) AS Returns, round(Buy_Hold_Equity, 2) AS Buy_Hold_Equity,
       round(Strategy_Returns, 8) AS Strategy_Returns, round(Strategy_Equity, 2) AS Strategy_Equity, Position,
       CAST(Buy_Signal AS INTEGER) AS Buy_Signal, CAST(Sell_Signal AS INTEGER) AS Sell_Signal, Trading_Action FROM ob"""


def book(spark, sf, capital=10_000.0, first_row_position=True):
    return bt.order_book(fx.preds(spark, sf), capital=capital, first_row_position=first_row_position)


@register("j1_j6_order_book", with_views(["preds"], BOOK_SQL, ob_ctes(10_000.0, True)))
def q_j1_j6(spark, sf):
    return _book_out(book(spark, sf)).withColumn("price_close", R("price_close", 6))


@register("j1_order_book_range", with_views(["preds"], """
        SELECT model, symbol, date, round(Returns, 8) AS Returns FROM ob""",
        ob_ctes(10_000.0, True, "(SELECT * FROM preds WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31')")))
def q_j1(spark, sf):
    b = bt.order_book(fx.preds(spark, sf), start="1997-01-01", end="1998-12-31")
    return b.select("model", "symbol", "date", R("Returns", 8).alias("Returns"))


@register("j2_buy_hold_equity", with_views(["preds"], """
        SELECT model, symbol, date, round(Buy_Hold_Equity, 2) AS Buy_Hold_Equity FROM ob""", ob_ctes(100_000.0, False)))
def q_j2(spark, sf):
    return book(spark, sf, 100_000.0, False).select("model", "symbol", "date",
                                                    R("Buy_Hold_Equity", 2).alias("Buy_Hold_Equity"))


@register("j3_strategy_equity", with_views(["preds"], """
        SELECT model, symbol, date, round(Strategy_Returns, 8) AS Strategy_Returns,
               round(Strategy_Equity, 2) AS Strategy_Equity FROM ob""", ob_ctes(10_000.0, True)))
def q_j3(spark, sf):
    return book(spark, sf).select("model", "symbol", "date", R("Strategy_Returns", 8).alias("Strategy_Returns"),
                                  R("Strategy_Equity", 2).alias("Strategy_Equity"))


@register("j4_position_backtest_mode", with_views(["preds"], """
        SELECT model, symbol, date, Position, CAST(Buy_Signal AS INTEGER) AS Buy_Signal FROM ob""",
        ob_ctes(100_000.0, False)))
def q_j4(spark, sf):
    b = book(spark, sf, 100_000.0, False)
    return b.select("model", "symbol", "date", "Position", F.col("Buy_Signal").cast("int").alias("Buy_Signal"))


@register("j5_j6_actions", with_views(["preds"], """
        SELECT model, symbol, Trading_Action, count(*) AS n, count(*) FILTER (WHERE Buy_Signal) AS buys,
               count(*) FILTER (WHERE Sell_Signal) AS sells FROM ob GROUP BY 1, 2, 3""", ob_ctes(10_000.0, True)))
def q_j5_j6(spark, sf):
    b = book(spark, sf)
    return b.groupBy("model", "symbol", "Trading_Action").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("Buy_Signal").alias("buys"), F.count_if("Sell_Signal").alias("sells"))


MET_COLS6 = ["strategy_return", "bh_return", "sharpe", "sharpe_bh", "sortino", "sortino_bh", "max_dd", "max_dd_bh",
             "calmar", "calmar_bh", "win_rate", "avg_win", "avg_loss"]


def _met_out(df):
    return df.select("model", "symbol", "days", "num_trades", F.col("n_pairs").cast("bigint").alias("n_pairs"),
                     *[R(c, 6).alias(c) for c in MET_COLS6])


MET_SQL = ("SELECT model, symbol, days, num_trades, CAST(n_pairs AS BIGINT) AS n_pairs, "
           + ", ".join(f"round({c}, 6) AS {c}" for c in MET_COLS6) + " FROM met")


def metrics(spark, sf):
    return bt.backtest_metrics(book(spark, sf, 100_000.0, False), 100_000.0)


@register("j16_model_comparison", with_views(["preds"], MET_SQL, ob_ctes(100_000.0, False) + metrics_ctes(100_000.0)))
def q_j16(spark, sf):
    return _met_out(metrics(spark, sf))


def _metric_query(name, cols):
    sql = with_views(["preds"], "SELECT model, symbol, " + ", ".join(f"round({c}, 6) AS {c}" for c in cols) + " FROM met",
                     ob_ctes(100_000.0, False) + metrics_ctes(100_000.0))

    @register(name, sql)
    def q(spark, sf):
        return metrics(spark, sf).select("model", "symbol", *[R(c, 6).alias(c) for c in cols])
    return q


_metric_query("j7_total_return", ["strategy_return", "bh_return"])
_metric_query("j8_sharpe", ["sharpe", "sharpe_bh"])
_metric_query("j9_sortino", ["sortino", "sortino_bh"])
_metric_query("j10_max_drawdown", ["max_dd", "max_dd_bh"])
_metric_query("j11_calmar", ["calmar", "calmar_bh"])
_metric_query("j14_win_rate", ["win_rate", "avg_win", "avg_loss"])


@register("j12_num_trades", with_views(["preds"], "SELECT model, symbol, num_trades FROM met",
                                       ob_ctes(100_000.0, False) + metrics_ctes(100_000.0)))
def q_j12(spark, sf):
    return metrics(spark, sf).select("model", "symbol", "num_trades")


@register("j13_trade_pairs", with_views(["preds"], """
        SELECT model, symbol, pair, open_date, close_date, round(p_open, 6) AS p_open, round(p_close, 6) AS p_close,
               round(trade_return, 8) AS trade_return FROM pairs""",
        ob_ctes(100_000.0, False) + metrics_ctes(100_000.0)))
def q_j13(spark, sf):
    p = bt.trade_pairs(book(spark, sf, 100_000.0, False))
    return p.select("model", "symbol", F.col("pair").cast("bigint").alias("pair"), "open_date", "close_date",
                    R("p_open", 6).alias("p_open"), R("p_close", 6).alias("p_close"),
                    R("trade_return", 8).alias("trade_return"))


@register("j15_report_by_model", with_views(["preds"], """
        SELECT model, symbol, date, predicted_signal, round(Strategy_Equity, 2) AS Strategy_Equity FROM ob""",
        ob_ctes(100_000.0, False)))
def q_j15(spark, sf):
    """Daily backtest report written as a table partitioned by model (one
    directory per model) in the shared folder, then read back."""
    path = scratch_path(spark, "j15_report")
    b = book(spark, sf, 100_000.0, False).select("model", "symbol", "date", "predicted_signal", "Strategy_Equity")
    b.write.mode("overwrite").partitionBy("model").parquet(path)
    back = spark.read.parquet(path)
    return back.select("model", "symbol", "date", "predicted_signal", R("Strategy_Equity", 2).alias("Strategy_Equity"))


@register("j17_order_book_summary", with_views(["preds"], """
        SELECT model, symbol, count(*) AS total_days, round(arg_max(Buy_Hold_Equity, date), 2) AS final_bh_equity,
               round(arg_max(Strategy_Equity, date), 2) AS final_strategy_equity,
               count(*) FILTER (WHERE Buy_Signal) AS buy_signals_count,
               count(*) FILTER (WHERE Sell_Signal) AS sell_signals_count FROM ob GROUP BY 1, 2""",
        ob_ctes(10_000.0, True)))
def q_j17(spark, sf):
    s = bt.order_book_summary(book(spark, sf))
    return s.select("model", "symbol", "total_days", R("final_bh_equity", 2).alias("final_bh_equity"),
                    R("final_strategy_equity", 2).alias("final_strategy_equity"),
                    "buy_signals_count", "sell_signals_count")


@register("j18_curves", with_views(["preds"], f"""
        SELECT model, symbol, date,
               round(dd_st * 100, 4) AS drawdown_pct, round(dd_bh * 100, 4) AS drawdown_bh_pct,
               round((Strategy_Equity / {dbl(10000.0)} - 1) * 100, 4) AS cum_return_pct,
               round((Buy_Hold_Equity / {dbl(10000.0)} - 1) * 100, 4) AS cum_return_bh_pct FROM mdd""",
        ob_ctes(10_000.0, True) + metrics_ctes(10_000.0)[:1]))
def q_j18(spark, sf):
    c = bt.curves(book(spark, sf), 10_000.0)
    return c.select("model", "symbol", "date", *[R(x, 4).alias(x) for x in
                                                 ("drawdown_pct", "drawdown_bh_pct", "cum_return_pct", "cum_return_bh_pct")])


def ls_ctes(t=0.6, cost=0.001, capital=100_000.0):
    cap = dbl(capital)
    return [
        ("ls0", f"""
            SELECT *, CASE WHEN confidence > {dbl(t)} THEN 1 WHEN confidence < {dbl(1 - t)} THEN -1 ELSE 0 END AS Signal
            FROM preds"""),
        ("ls1", f"""
            SELECT *, CASE WHEN lag(price_close) OVER ({W}) = 0 THEN NULL ELSE price_close / lag(price_close) OVER ({W}) - 1 END AS r,
                   lag(Signal) OVER ({W}) AS prev FROM ls0"""),
        ("ls2", f"""
            SELECT *, coalesce(r, 0.0) AS Return, coalesce(prev * r - {dbl(cost)} * abs(Signal - prev), 0.0) AS Strategy_Return,
                   abs(Signal - prev) AS ops FROM ls1"""),
        ("ls", f"""
            SELECT *, {cap} * product(1 + Return) OVER ({WR}) AS Buy_Hold_Equity,
                   {cap} * product(1 + Strategy_Return) OVER ({WR}) AS Strategy_Equity FROM ls2"""),
        ("lsd", f"""
            SELECT *, (Buy_Hold_Equity - max(Buy_Hold_Equity) OVER ({WR})) / max(Buy_Hold_Equity) OVER ({WR}) AS dd_bh,
                      (Strategy_Equity - max(Strategy_Equity) OVER ({WR})) / max(Strategy_Equity) OVER ({WR}) AS dd_st
            FROM ls"""),
        ("lsm", f"""
            SELECT model, symbol, arg_max(Buy_Hold_Equity, date) / {cap} - 1 AS total_return_bh,
                   arg_max(Strategy_Equity, date) / {cap} - 1 AS total_return_strategy,
                   CASE WHEN stddev_samp(Return) = 0 THEN 0.0 ELSE {SQ} * avg(Return) / stddev_samp(Return) END AS sharpe_bh,
                   CASE WHEN stddev_samp(Strategy_Return) = 0 THEN 0.0
                        ELSE {SQ} * avg(Strategy_Return) / stddev_samp(Strategy_Return) END AS sharpe_strategy,
                   min(dd_bh) * 100 AS max_drawdown_bh, min(dd_st) * 100 AS max_drawdown_strategy,
                   CAST(coalesce(sum(ops), 0) AS BIGINT) AS num_operations
            FROM lsd GROUP BY 1, 2"""),
    ]


LS_COLS = ["total_return_bh", "total_return_strategy", "sharpe_bh", "sharpe_strategy",
           "max_drawdown_bh", "max_drawdown_strategy"]


def ls_metrics(spark, sf):
    return bt.long_short_metrics(bt.long_short(fx.preds(spark, sf)))


@register("j19_long_short_sim", with_views(["preds"], "SELECT model, symbol, "
                                           + ", ".join(f"round({c}, 6) AS {c}" for c in LS_COLS)
                                           + ", num_operations FROM lsm", ls_ctes()))
def q_j19(spark, sf):
    return ls_metrics(spark, sf).select("model", "symbol", *[R(c, 6).alias(c) for c in LS_COLS], "num_operations")


@register("j19_long_short_daily", with_views(["preds"], """
        SELECT model, symbol, date, Signal, round(Strategy_Return, 8) AS Strategy_Return,
               round(Strategy_Equity, 2) AS Strategy_Equity FROM ls""", ls_ctes()))
def q_j19_daily(spark, sf):
    s = bt.long_short(fx.preds(spark, sf))
    return s.select("model", "symbol", "date", "Signal", R("Strategy_Return", 8).alias("Strategy_Return"),
                    R("Strategy_Equity", 2).alias("Strategy_Equity"))


@register("j20_best_simulated_model", with_views(["preds"], """
        SELECT symbol, arg_max(model, total_return_strategy) AS model,
               round(max(total_return_strategy), 6) AS total_return_strategy FROM lsm GROUP BY symbol""", ls_ctes()))
def q_j20(spark, sf):
    b = bt.best_by(ls_metrics(spark, sf), "total_return_strategy", "model")
    return b.select("symbol", "model", R("total_return_strategy", 6).alias("total_return_strategy"))


@register("j21_simulation_summary", with_views(["preds"], """
        SELECT model, symbol, metric_order, metric, value FROM (
          SELECT model, symbol, 0 AS metric_order, 'Buy & Hold Return' AS metric, printf('%.2f%%', total_return_bh * 100) AS value FROM lsm
          UNION ALL SELECT model, symbol, 1, 'ML Strategy Return', printf('%.2f%%', total_return_strategy * 100) FROM lsm
          UNION ALL SELECT model, symbol, 2, 'Sharpe Ratio Buy & Hold', printf('%.4f', sharpe_bh) FROM lsm
          UNION ALL SELECT model, symbol, 3, 'Sharpe Ratio Strategy', printf('%.4f', sharpe_strategy) FROM lsm
          UNION ALL SELECT model, symbol, 4, 'Max Drawdown Buy & Hold (%)', printf('%.2f%%', max_drawdown_bh) FROM lsm
          UNION ALL SELECT model, symbol, 5, 'Max Drawdown Strategy (%)', printf('%.2f%%', max_drawdown_strategy) FROM lsm
          UNION ALL SELECT model, symbol, 6, 'Number of Operations', CAST(num_operations AS VARCHAR) FROM lsm)""",
        ls_ctes()))
def q_j21(spark, sf):
    return bt.simulation_summary(ls_metrics(spark, sf))


@register("j21_summary_transposed", with_views(["preds"], """
    SELECT symbol, metric_order, metric, max(CASE WHEN model = 'm1' THEN value END) AS m1,
           max(CASE WHEN model = 'm2' THEN value END) AS m2, max(CASE WHEN model = 'm3' THEN value END) AS m3
    FROM (SELECT model, symbol, 0 AS metric_order, 'Buy & Hold Return' AS metric, printf('%.2f%%', total_return_bh * 100) AS value FROM lsm
          UNION ALL SELECT model, symbol, 1, 'ML Strategy Return', printf('%.2f%%', total_return_strategy * 100) FROM lsm
          UNION ALL SELECT model, symbol, 2, 'Sharpe Ratio Buy & Hold', printf('%.4f', sharpe_bh) FROM lsm
          UNION ALL SELECT model, symbol, 3, 'Sharpe Ratio Strategy', printf('%.4f', sharpe_strategy) FROM lsm
          UNION ALL SELECT model, symbol, 4, 'Max Drawdown Buy & Hold (%)', printf('%.2f%%', max_drawdown_bh) FROM lsm
          UNION ALL SELECT model, symbol, 5, 'Max Drawdown Strategy (%)', printf('%.2f%%', max_drawdown_strategy) FROM lsm
          UNION ALL SELECT model, symbol, 6, 'Number of Operations', CAST(num_operations AS VARCHAR) FROM lsm)
    GROUP BY 1, 2, 3""", ls_ctes()))
def q_j21t(spark, sf):
    models = [m for m, _ in fx.SIGNAL_MODELS]
    return bt.transpose_by_model(bt.simulation_summary(ls_metrics(spark, sf)), models)


@register("j16_isolated_comparison", with_views(["preds"], MET_SQL.replace("SELECT model,", "SELECT 'ok' AS status, model,", 1) + """
    UNION ALL SELECT 'skipped', model, NULL, NULL, NULL, NULL, """ + ", ".join("NULL" for _ in MET_COLS6) + """
    FROM (VALUES ('m4 not stored'), ('m5 spoilt')) t(model)""", ob_ctes(100_000.0, False) + metrics_ctes(100_000.0)))
def q_j16b(spark, sf):
    """Three sound models and two broken ones: one whose signals were never stored, and one with a spoilt
    confidence that fails in the middle of its job.  Both are skipped and named."""
    path = scratch_path(spark, "j16")
    stored = f"{path}/signals"
    fx.preds(spark, sf).write.partitionBy("model").parquet(stored)

    def signals(name):
        return spark.read.parquet(f"{stored}/model={name}").select("symbol", "date", "price_close", "predicted_signal", "confidence")

    def spoilt():
        text = F.when(F.col("date") == F.lit("1997-05-05").cast("date"), "n/a").otherwise(F.col("confidence").cast("string"))
        read = F.when(text.try_cast("double").isNull(), F.raise_error(F.lit("not a confidence"))).otherwise(text.try_cast("double"))
        return signals("m2").withColumn("predicted_signal", (read > 0.5).cast("int"))

    models = {m: functools.partial(signals, m) for m, _ in fx.SIGNAL_MODELS}
    models |= {"m4 not stored": functools.partial(signals, "m4"), "m5 spoilt": spoilt}
    fine, errors = bt.isolated_comparison(spark, models, f"{path}/reports")
    skipped = spark.createDataFrame([(m,) for m in sorted(errors)], "model string")
    return _met_out(fine).withColumn("status", F.lit("ok")).unionByName(skipped.withColumn("status", F.lit("skipped")), allowMissingColumns=True)
