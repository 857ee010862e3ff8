"""Rule-based strategy, parameter search and robustness.

The parameter grid is a literal array exploded per row (a bounded generator,
no join): every distinct SMA length is computed once in a single window pass
per symbol, then each (short, long) pair picks its two columns.  The backtest
of all 24 pairs is one plan with windows partitioned by (symbol, short, long).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import is_true, rnd, running, safe_div, series_window

# Configuration rankings use metrics rounded to 9 digits (ties in exact
# arithmetic resolve to the first configuration in grid order).
RANK_DIGITS = 9
from ..sources.fixtures import GRID_LONG, GRID_SHORT, params_array, periods_array
from .backtest import backtest_metrics
from .indicators import sma

SQRT252 = math.sqrt(252)


def crossover_signals(df: DataFrame, short: int = 10, long: int = 200, keys=("symbol",)) -> DataFrame:
    """K1: Signal = 1 when SMA(short) > SMA(long) else 0 (0 during warm-up);
    Position = Signal change, computed before warm-up rows are dropped, so
    the first kept row can already be a buy."""
    w = series_window(keys)
    d = df.withColumns({"SMA_short": sma(short, "close", keys), "SMA_long": sma(long, "close", keys)})
    d = d.withColumn("Signal", is_true(F.col("SMA_short") > F.col("SMA_long")).cast("int"))
    d = d.withColumn("Position", (F.col("Signal") - F.lag("Signal").over(w)).cast("double"))
    return d.where(F.col("SMA_long").isNotNull() & F.col("Position").isNotNull())


def crossover_backtest(sig: DataFrame, capital: float = 100_000.0, keys=("symbol",)) -> DataFrame:
    """K2: returns recomputed on the kept rows (first row NULL, not filled);
    equity = capital x running product of (1 + r), NULL where r is NULL
    (cumprod skips NaN); flags from Position."""
    w = series_window(keys)
    run = running(w)
    d = sig.withColumn("Returns", safe_div(F.col("close"), F.lag("close").over(w)) - 1)
    d = d.withColumn("Strategy_Returns", F.col("Returns") * F.lag("Signal").over(w))

    def equity(r: str) -> Column:
        return F.when(F.col(r).isNotNull(), F.lit(capital) * F.product(1 + F.col(r)).over(run))
    return d.withColumns({
        "Buy_Hold_Equity": equity("Returns"),
        "Strategy_Equity": equity("Strategy_Returns"),
        "Buy_Signal": is_true(F.col("Position") == 1),
        "Sell_Signal": is_true(F.col("Position") == -1),
    })


def crossover_metrics(book: DataFrame, capital: float = 100_000.0, keys=("symbol",)) -> DataFrame:
    """K3: the J7-J14 metric set on the crossover backtest (pairs priced at close)."""
    return backtest_metrics(book, capital, price="close", keys=keys)


def _pick(n_col: str, lengths: list[int]) -> Column:
    out = None
    for n in lengths:
        out = (F.when(F.col(n_col) == n, F.col(f"_sma{n}")) if out is None
               else out.when(F.col(n_col) == n, F.col(f"_sma{n}")))
    return out


def grid_backtest(df: DataFrame, capital: float = 100_000.0, keys=("symbol",)) -> DataFrame:
    """K4: the crossover backtest for every (short, long) of the grid in one plan."""
    lengths = sorted(set(GRID_SHORT) | set(GRID_LONG))
    d = df.withColumns({f"_sma{n}": sma(n, "close", keys) for n in lengths})
    d = d.select(*df.columns, *[f"_sma{n}" for n in lengths], F.inline(params_array()))
    gk = (*keys, "short", "long")
    w = series_window(gk)
    d = d.withColumns({"SMA_short": _pick("short", GRID_SHORT), "SMA_long": _pick("long", GRID_LONG)})
    d = d.withColumn("Signal", is_true(F.col("SMA_short") > F.col("SMA_long")).cast("int"))
    d = d.withColumn("Position", (F.col("Signal") - F.lag("Signal").over(w)).cast("double"))
    d = d.where(F.col("SMA_long").isNotNull() & F.col("Position").isNotNull())
    d = d.drop(*[f"_sma{n}" for n in lengths])
    return crossover_backtest(d, capital, gk)


def grid_metrics(df: DataFrame, capital: float = 100_000.0, keys=("symbol",)) -> DataFrame:
    return crossover_metrics(grid_backtest(df, capital, keys), capital, (*keys, "short", "long"))


def optimized_book(df: DataFrame, capital: float = 100_000.0, keys=("symbol",)) -> DataFrame:
    """The backtest of each symbol's best-Sharpe configuration (the
    "optimized system"), in one pass over the grid backtest: each
    configuration's Sharpe is a window aggregate over its own rows (the
    frame the grid windows already partitioned), and a dense rank per symbol
    by (Sharpe desc, short, long) keeps the rows of the first-best one (ties:
    first in grid order, as idxmax).  No aggregate is joined back."""
    from pyspark.sql import Window
    book = grid_backtest(df, capital, keys)
    cfg = Window.partitionBy(*keys, "short", "long")
    r = F.col("Strategy_Returns")
    sd = F.stddev_samp(r).over(cfg)
    sh = F.when(sd == 0, F.lit(0.0)).otherwise(F.lit(SQRT252) * F.avg(r).over(cfg) / sd)
    ranked = book.withColumn("_sharpe", sh).withColumn(
        "_rk", F.dense_rank().over(Window.partitionBy(*keys).orderBy(rnd("_sharpe", RANK_DIGITS).desc_nulls_last(),
                                                                     "short", "long")))
    return ranked.where(F.col("_rk") == 1).drop("_sharpe", "_rk")


def best_configs(grid: DataFrame, keys=("symbol",)) -> DataFrame:
    """K5: best (short, long) by return, by Sharpe and by drawdown (the
    drawdown is negative, so the highest is the smallest loss).  A tie goes
    to the first configuration in grid order, as idxmax does."""
    cfg = F.struct("short", "long")

    def key(metric):
        return F.struct(rnd(metric, RANK_DIGITS), -F.col("short"), -F.col("long"))
    return grid.groupBy(*keys).agg(
        F.max_by(cfg, key("strategy_return")).alias("best_return"),
        F.max_by(cfg, key("sharpe")).alias("best_sharpe"),
        F.max_by(cfg, key("max_dd")).alias("best_drawdown"))


def sharpe_pivot(grid: DataFrame, keys=("symbol",)) -> DataFrame:
    """K6: Sharpe as a short x long matrix (explicit pivot values: no extra job)."""
    return grid.groupBy(*keys, "short").pivot("long", GRID_LONG).agg(F.first("sharpe"))


def period_performance(book: DataFrame, keys=("symbol",)) -> DataFrame:
    """K8: per named period: equity last/first - 1, annualised volatility and
    trades; periods without rows are absent.  Periods are a literal array
    filtered per row (a bounded range join without a join)."""
    p = book.select("*", F.explode(F.filter(periods_array(), lambda x: F.col("date").between(x["start"], x["end"])))
                    .alias("_p")).withColumn("period", F.col("_p.period")).drop("_p")
    return p.groupBy(*keys, "period").agg(
        ((safe_div(F.max_by("Strategy_Equity", "date"), F.min_by("Strategy_Equity", "date")) - 1) * 100).alias("strategy_return"),
        ((safe_div(F.max_by("Buy_Hold_Equity", "date"), F.min_by("Buy_Hold_Equity", "date")) - 1) * 100).alias("bh_return"),
        (F.stddev_samp("Strategy_Returns") * SQRT252 * 100).alias("strategy_vol"),
        (F.stddev_samp("Returns") * SQRT252 * 100).alias("bh_vol"),
        F.count_if("Buy_Signal").alias("trades"))


def best_worst_period(perf: DataFrame, keys=("symbol",)) -> DataFrame:
    """K9."""
    return perf.groupBy(*keys).agg(F.max_by("period", "strategy_return").alias("best_period"),
                                   F.min_by("period", "strategy_return").alias("worst_period"))


def _uniform(*parts: Column) -> Column:
    """A uniform (0, 1) number from the first 13 hex digits (52 bits) of an md5:
    the same for a given (seed, key, path, day) whatever the partitioning, and
    in any engine."""
    h = F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 13)
    return (F.conv(h, 16, 10).cast("double") + 0.5) / float(1 << 52)


def monte_carlo(book: DataFrame, n_paths: int = 1000, n_days: int = 252, capital: float = 100_000.0,
                seed: int = 42, keys=("symbol",), partitions: int | None = None) -> DataFrame:
    """Terminal wealth of ``n_paths`` paths of ``n_days`` normal returns
    with the mean / std of the strategy returns; 5/25/50/75/95 percentiles,
    probability of a loss and expected return.  Normals come from Box-Muller
    on hash-derived uniforms, so the result is reproducible and independent
    of how Spark partitions the paths."""
    stats = book.where(F.col("Strategy_Returns").isNotNull()).groupBy(*keys).agg(
        F.avg("Strategy_Returns").alias("mu"), F.stddev_samp("Strategy_Returns").alias("sigma"))
    paths = stats.select(*keys, "mu", "sigma", F.explode(F.sequence(F.lit(0), F.lit(n_paths - 1))).alias("path"))
    paths = paths.repartition(partitions, *keys, "path") if partitions else paths.repartition(*keys, "path")
    days = paths.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_days - 1))).alias("day"))
    u1 = _uniform(F.lit(seed), *[F.col(k) for k in keys], F.col("path"), F.col("day"), F.lit(1))
    u2 = _uniform(F.lit(seed), *[F.col(k) for k in keys], F.col("path"), F.col("day"), F.lit(2))
    z = F.sqrt(-2 * F.log(u1)) * F.cos(2 * math.pi * u2)
    r = F.col("mu") + F.col("sigma") * z
    final = days.groupBy(*keys, "path").agg((F.lit(capital) * F.product(1 + r)).alias("final_value"))
    q = F.percentile("final_value", F.array(*[F.lit(x) for x in (0.05, 0.25, 0.5, 0.75, 0.95)]))
    out = final.groupBy(*keys).agg(q.alias("_q"), (F.count_if(F.col("final_value") < capital) * 100.0
                                                   / F.count(F.lit(1))).alias("p_loss_pct"),
                                   ((F.avg("final_value") / capital - 1) * 100).alias("expected_return_pct"),
                                   F.count(F.lit(1)).alias("paths"))
    return out.select(*keys, *[F.col("_q")[i].alias(f"p{p}") for i, p in enumerate((5, 25, 50, 75, 95))],
                      "p_loss_pct", "expected_return_pct", "paths")


def trade_log(book: DataFrame, keys=("symbol",)) -> DataFrame:
    """Rows with a buy or a sell."""
    return book.where(F.col("Buy_Signal") | F.col("Sell_Signal")).select(*keys, "date", "close", "Buy_Signal",
                                                                        "Sell_Signal")
