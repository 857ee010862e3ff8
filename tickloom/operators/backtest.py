"""Order book, equity curves and risk metrics.

Series key: ``keys`` (default model, symbol) ordered by date.  Running products
and running maxima are window aggregates over ``unboundedPreceding..current``
(one sort per series, shared by every column).  Metrics of all series come out
of one ``groupBy(keys).agg`` - no Python loop over models or symbols.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import is_true, running, safe_div, series_window

SQRT252 = math.sqrt(252)
# Order-book action names.
ACTIONS = ("COMPRA", "VENTA", "MANTENER_POSICION", "MANTENER_LIQUIDEZ")

KEYS = ("model", "symbol")


def slice_dates(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive date range (E15 / J1); a pushed-down filter on the scan."""
    if start:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("date") <= F.lit(end).cast("date"))
    return df


def order_book(signals: DataFrame, capital: float = 10_000.0, price: str = "price_close",
               signal: str = "predicted_signal", keys=KEYS, first_row_position: bool = True,
               start: str | None = None, end: str | None = None) -> DataFrame:
    """J1-J6.  Returns = pct_change (first 0); hold and strategy equity as
    running products; strategy return uses the previous day's signal;
    Position = signal change (first row = signal in order-book mode, NULL in
    backtest mode); buy/sell flags and the action text."""
    w = series_window(keys)
    run = running(w)
    df = slice_dates(signals, start, end)
    prev_px = F.lag(price).over(w)
    df = df.withColumn("Returns", F.coalesce(safe_div(F.col(price), prev_px) - 1, F.lit(0.0)))
    prev_sig = F.lag(signal).over(w)
    pos = F.col(signal) - prev_sig
    if first_row_position:
        pos = F.when(prev_sig.isNull(), F.col(signal)).otherwise(pos)
    df = df.withColumns({
        "Buy_Hold_Equity": F.lit(capital) * F.product(F.lit(1.0) + F.col("Returns")).over(run),
        "Strategy_Returns": F.col("Returns") * F.coalesce(prev_sig, F.lit(0)).cast("double"),
        "Position": pos.cast("double"),
    })
    df = df.withColumns({
        "Strategy_Equity": F.lit(capital) * F.product(F.lit(1.0) + F.col("Strategy_Returns")).over(run),
        "Buy_Signal": is_true(F.col("Position") == 1),
        "Sell_Signal": is_true(F.col("Position") == -1),
    })
    return df.withColumn(
        "Trading_Action",
        F.when(F.col("Buy_Signal"), ACTIONS[0]).when(F.col("Sell_Signal"), ACTIONS[1])
         .when(F.col(signal) == 1, ACTIONS[2]).otherwise(ACTIONS[3]))


def drawdown(equity: str, keys=KEYS) -> Column:
    """J10 / J18 per row: (E - running max E) / running max E; NULL while the peak is 0."""
    peak = F.max(equity).over(running(series_window(keys)))
    return safe_div(F.col(equity) - peak, peak)


def sharpe(r: str | Column, periods: float = SQRT252) -> Column:
    """sqrt(252) * mean / sample std; 0 when std is 0 (NULL for <2 rows)."""
    x = F.col(r) if isinstance(r, str) else r
    sd = F.stddev_samp(x)
    return F.when(sd == 0, F.lit(0.0)).otherwise(F.lit(periods) * F.avg(x) / sd)


def sortino(r: str, periods: float = SQRT252) -> Column:
    """sqrt(252) * mean / std of the negative returns; 0 when that std is
    0; NULL with fewer than two negative returns."""
    sd = F.stddev_samp(F.when(F.col(r) < 0, F.col(r)))
    return F.when(sd == 0, F.lit(0.0)).otherwise(F.lit(periods) * F.avg(r) / sd)


def calmar(ret_pct: Column, dd_pct: Column) -> Column:
    """Return / |max drawdown|, 0 when the drawdown is 0."""
    return F.when(dd_pct == 0, F.lit(0.0)).otherwise(ret_pct / F.abs(dd_pct))


def trade_pairs(book: DataFrame, price: str = "price_close", keys=KEYS) -> DataFrame:
    """buy/sell events in date order paired (0,1), (2,3), ...; trade return
    = (p2 - p1) / p1 (NULL for a zero opening price); an odd tail is dropped.  A
    leading sell starts a pair (as in the reference).  Events per series are
    bounded by its trading days."""
    ev = book.where(F.col("Buy_Signal") | F.col("Sell_Signal"))
    ev = ev.withColumn("_e", F.row_number().over(series_window(keys)) - 1)
    pairs = ev.groupBy(*keys, F.floor(F.col("_e") / 2).alias("pair")).agg(
        F.min_by(price, "_e").alias("p_open"), F.max_by(price, "_e").alias("p_close"),
        F.min("date").alias("open_date"), F.max("date").alias("close_date"),
        F.count(F.lit(1)).alias("_n"))
    return pairs.where(F.col("_n") == 2).select(
        *keys, "pair", "open_date", "close_date", "p_open", "p_close",
        safe_div(F.col("p_close") - F.col("p_open"), F.col("p_open")).alias("trade_return"))


def trade_stats(pairs: DataFrame, keys=KEYS) -> DataFrame:
    """Win rate %, average win %, average loss %; 0 when there is none."""
    r = F.col("trade_return")
    return pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.coalesce(F.count_if(r > 0) * 100.0 / F.count(F.lit(1)), F.lit(0.0)).alias("win_rate"),
        F.coalesce(F.avg(F.when(r > 0, r)) * 100, F.lit(0.0)).alias("avg_win"),
        F.coalesce(F.avg(F.when(r < 0, r)) * 100, F.lit(0.0)).alias("avg_loss"))


def backtest_metrics(book: DataFrame, capital: float, price: str = "price_close", keys=KEYS) -> DataFrame:
    """J7-J14 for every series in one aggregate.  Trades are paired in the same
    window as the drawdowns: each second event closes the trade that the event
    before it opened."""
    w = series_window(keys)
    event = F.col("Buy_Signal") | F.col("Sell_Signal")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    b = book.withColumns({"_dd_bh": drawdown("Buy_Hold_Equity", keys), "_dd_st": drawdown("Strategy_Equity", keys),
                          "_events": F.count(F.when(event, 1)).over(running(w)),
                          "_opened": F.last(F.when(event, F.col(price)), ignorenulls=True).over(before)})
    b = b.withColumn("_closes", is_true(event) & (F.col("_events") % 2 == 0))
    r = F.when(F.col("_closes"), safe_div(F.col(price) - F.col("_opened"), F.col("_opened")))
    b = b.withColumn("_trade", r)
    trade = F.col("_trade")
    m = b.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"),
        ((F.max_by("Strategy_Equity", "date") / capital - 1) * 100).alias("strategy_return"),
        ((F.max_by("Buy_Hold_Equity", "date") / capital - 1) * 100).alias("bh_return"),
        sharpe("Strategy_Returns").alias("sharpe"),
        sharpe("Returns").alias("sharpe_bh"),
        sortino("Strategy_Returns").alias("sortino"),
        sortino("Returns").alias("sortino_bh"),
        (F.min("_dd_st") * 100).alias("max_dd"),
        (F.min("_dd_bh") * 100).alias("max_dd_bh"),
        F.count_if(F.col("Buy_Signal")).alias("num_trades"),
        F.count_if("_closes").alias("n_pairs"),
        F.coalesce(safe_div(F.count_if(trade > 0) * 100.0, F.count_if("_closes")), F.lit(0.0)).alias("win_rate"),
        F.coalesce(F.avg(F.when(trade > 0, trade)) * 100, F.lit(0.0)).alias("avg_win"),
        F.coalesce(F.avg(F.when(trade < 0, trade)) * 100, F.lit(0.0)).alias("avg_loss"),
    )
    return m.withColumns({"calmar": calmar(F.col("strategy_return"), F.col("max_dd")),
                          "calmar_bh": calmar(F.col("bh_return"), F.col("max_dd_bh"))})


def order_book_summary(book: DataFrame, keys=KEYS) -> DataFrame:
    """Days, final equities, buys, sells per series."""
    return book.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_days"),
        F.max_by("Buy_Hold_Equity", "date").alias("final_bh_equity"),
        F.max_by("Strategy_Equity", "date").alias("final_strategy_equity"),
        F.count_if("Buy_Signal").alias("buy_signals_count"),
        F.count_if("Sell_Signal").alias("sell_signals_count"))


def curves(book: DataFrame, capital: float, keys=KEYS) -> DataFrame:
    """Per-row drawdown % and cumulative return % of both equity curves."""
    return book.select(
        *keys, "date",
        (drawdown("Strategy_Equity", keys) * 100).alias("drawdown_pct"),
        (drawdown("Buy_Hold_Equity", keys) * 100).alias("drawdown_bh_pct"),
        ((F.col("Strategy_Equity") / capital - 1) * 100).alias("cum_return_pct"),
        ((F.col("Buy_Hold_Equity") / capital - 1) * 100).alias("cum_return_bh_pct"))


def long_short(df: DataFrame, prob: str = "confidence", price: str = "price_close",
               threshold: float = 0.6, cost: float = 0.001, capital: float = 100_000.0,
               keys=KEYS) -> DataFrame:
    """J19 per row: signal 1 above t, -1 below 1-t, else 0; strategy return =
    previous signal x return - cost x |signal change|, NULL -> 0."""
    w = series_window(keys)
    run = running(w)
    sig = (F.when(F.col(prob) > threshold, 1).when(F.col(prob) < 1 - threshold, -1).otherwise(0))
    df = df.withColumn("Signal", sig)
    ret = safe_div(F.col(price), F.lag(price).over(w)) - 1
    prev = F.lag("Signal").over(w)
    strat = prev * ret - F.lit(cost) * F.abs(F.col("Signal") - prev)
    df = df.withColumns({"Return": F.coalesce(ret, F.lit(0.0)),
                         "Strategy_Return": F.coalesce(strat, F.lit(0.0)),
                         "_ops": F.abs(F.col("Signal") - prev)})
    return df.withColumns({
        "Buy_Hold_Equity": F.lit(capital) * F.product(1 + F.col("Return")).over(run),
        "Strategy_Equity": F.lit(capital) * F.product(1 + F.col("Strategy_Return")).over(run),
    })


def long_short_metrics(sim: DataFrame, capital: float = 100_000.0, keys=KEYS) -> DataFrame:
    """J19 summary: total returns (fractions), Sharpe, max drawdown %, operations."""
    s = sim.withColumns({"_dd_bh": drawdown("Buy_Hold_Equity", keys),
                         "_dd_st": drawdown("Strategy_Equity", keys)})
    return s.groupBy(*keys).agg(
        (F.max_by("Buy_Hold_Equity", "date") / capital - 1).alias("total_return_bh"),
        (F.max_by("Strategy_Equity", "date") / capital - 1).alias("total_return_strategy"),
        sharpe("Return").alias("sharpe_bh"),
        sharpe("Strategy_Return").alias("sharpe_strategy"),
        (F.min("_dd_bh") * 100).alias("max_drawdown_bh"),
        (F.min("_dd_st") * 100).alias("max_drawdown_strategy"),
        F.coalesce(F.sum("_ops"), F.lit(0)).cast("bigint").alias("num_operations"))


def best_by(df: DataFrame, metric: str, label: str, group=("symbol",)) -> DataFrame:
    """The row with the highest metric per group; of equal ones the
    smallest label."""
    best = F.min_by(label, F.struct(-F.col(metric), F.col(label)))
    return df.where(F.col(metric).isNotNull()).groupBy(*group).agg(best.alias(label), F.max(metric).alias(metric))


def pct_text(c: Column, scale: float = 1.0) -> Column:
    """Percentage text with two decimals, e.g. 12.34%."""
    return F.format_string("%.2f%%", c * scale)


def simulation_summary(metrics: DataFrame, keys=KEYS) -> DataFrame:
    """Per series, fixed metric order, percentages as text, shown
    transposed: one (metric, value) row per series via ``stack``."""
    m = metrics.select(
        *keys,
        pct_text(F.col("total_return_bh"), 100).alias("Buy & Hold Return"),
        pct_text(F.col("total_return_strategy"), 100).alias("ML Strategy Return"),
        F.format_string("%.4f", F.col("sharpe_bh")).alias("Sharpe Ratio Buy & Hold"),
        F.format_string("%.4f", F.col("sharpe_strategy")).alias("Sharpe Ratio Strategy"),
        pct_text(F.col("max_drawdown_bh")).alias("Max Drawdown Buy & Hold (%)"),
        pct_text(F.col("max_drawdown_strategy")).alias("Max Drawdown Strategy (%)"),
        F.col("num_operations").cast("string").alias("Number of Operations"))
    names = m.columns[len(keys):]
    pairs = ", ".join(f"{i}, '{n}', `{n}`" for i, n in enumerate(names))
    return m.select(*keys, F.expr(f"stack({len(names)}, {pairs}) AS (metric_order, metric, value)"))


def transpose_by_model(summary: DataFrame, models: list[str], keys=("symbol",)) -> DataFrame:
    """J21 display: metrics as rows and one column per model (pivot on an
    explicit model list, so no extra job discovers the values)."""
    return summary.groupBy(*keys, "metric_order", "metric").pivot("model", models).agg(F.first("value"))


class AllModelsFailed(RuntimeError):
    """No model could be backtested; ``errors`` has each one's message."""

    def __init__(self, errors: dict[str, str]):
        super().__init__("no model could be backtested: " + "; ".join(f"{m}: {e}" for m, e in errors.items()))
        self.errors = errors


def isolated_comparison(spark: SparkSession, models: dict[str, Callable[[], DataFrame]], path: str, capital: float = 100_000.0,
                        at_once: int = 4) -> tuple[DataFrame | None, dict[str, str]]:
    """J16 with each model as a job of its own: ``models`` has for each name the function that loads the model and
    makes its signals (symbol, date, price_close, predicted_signal).  The daily report of a model is written below ``path``
    (one folder a model), and only a model whose report is whole enters the comparison.  A model that fails, on loading or in
    the middle of its job, is skipped and named with its error; the others go on.  If all fail: ``AllModelsFailed``.  Without
    models there is nothing to compare: (None, {}).  Up to ``at_once`` jobs run side by side, so that short ones fill the cluster."""
    def one(name: str) -> str | None:
        try:
            signals = models[name]().withColumn("model", F.lit(name))
            book = order_book(signals, capital=capital, first_row_position=False)
            book.write.mode("overwrite").parquet(f"{path}/model={name}")
        except Exception as e:  # noqa: BLE001 - the other models go on
            return f"{type(e).__name__}: {e}".splitlines()[0]
        return None

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        found = dict(zip(models, pool.map(inheritable_thread_target(one), models)))
    errors = {m: e for m, e in found.items() if e is not None}
    if models and len(errors) == len(models):
        raise AllModelsFailed(errors)
    fine = [m for m in models if m not in errors]
    if not fine:
        return None, errors
    books = [spark.read.parquet(f"{path}/model={m}") for m in fine]
    return backtest_metrics(reduce(DataFrame.unionByName, books), capital), errors
