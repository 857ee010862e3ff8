"""Price and technical-indicator operators.

All indicators of one series share a single window spec (partition by symbol,
order by date), so Catalyst sorts each symbol once and evaluates every rolling
expression in the same Window operator.  A symbol's window partition holds one
row per trading day, so its size is bounded by the calendar, not by the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import is_true, nan_to_null, rnd_even, rolling, safe_div, series_window, trailing

# RSI / MACD read-out labels and thresholds.
RSI_HIGH, RSI_LOW = 70, 30
RSI_LABELS = ("Sobrecompra", "Sobreventa", "Neutral")
MACD_LABELS = ("Alcista", "Bajista")
# Volatility-regime buckets (upper bounds, exclusive) and names.
VIX_BUCKETS = [(20, "Bajo"), (30, "Moderado"), (40, "Alto")]
VIX_TOP = "Muy Alto"


def daily_return(close: str | Column = "close", keys=("symbol",)) -> Column:
    """Close / previous close - 1; NULL on the first row (and on a zero
    previous close, where pandas would give inf)."""
    x = nan_to_null(close)
    return safe_div(x, F.lag(x).over(series_window(keys))) - 1


def sma(n: int, c: str | Column = "close", keys=("symbol",)) -> Column:
    """Simple moving average, NULL until n values are available."""
    return rolling(F.avg, nan_to_null(c), series_window(keys), n)


def rolling_std(n: int, c: str | Column, keys=("symbol",)) -> Column:
    """D3: rolling sample standard deviation, NULL until n non-null values."""
    return rolling(F.stddev_samp, nan_to_null(c), series_window(keys), n)


def rsi(n: int = 14, c: str | Column = "close", keys=("symbol",)) -> Column:
    """Simple-mean RSI.  The first row's delta counts as a zero gain and a
    zero loss; means use min_periods=1; no loss and some gain gives 100; no
    gain and no loss gives NULL."""
    w = series_window(keys)
    x = nan_to_null(c)
    delta = F.coalesce(x - F.lag(x).over(w), F.lit(0.0))
    frame = trailing(w, n)
    ag = F.avg(F.greatest(delta, F.lit(0.0))).over(frame)
    al = F.avg(F.greatest(-delta, F.lit(0.0))).over(frame)
    return (F.when((ag == 0) & (al == 0), F.lit(None).cast("double"))
            .when(al == 0, F.lit(100.0))
            .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + ag / al)))


def target_direction(c: str | Column = "close", keys=("symbol",)) -> Column:
    """1 when the next close is higher, else 0; the last row is 0."""
    x = nan_to_null(c)
    return is_true(F.lead(x).over(series_window(keys)) > x).cast("int")


def with_indicators(bars: DataFrame, keys=("symbol",)) -> DataFrame:
    """D1-D5 in one projection: RSI, daily_return, SMA_10, SMA_50,
    volatilidad_10d, target_direction."""
    df = bars.withColumn("daily_return", daily_return("close", keys))
    return df.withColumns({
        "RSI": rsi(14, "close", keys),
        "SMA_10": sma(10, "close", keys),
        "SMA_50": sma(50, "close", keys),
        "volatilidad_10d": rolling_std(10, "daily_return", keys),
        "target_direction": target_direction("close", keys),
    })


# ---------------------------------------------------------------- EMA / MACD

def smoothing(span: int) -> float:
    """Weight of a new value in an EMA of ``span``."""
    return 1.0 / (1.0 + (span - 1) / 2.0)


def ema_step(mean: Column, x: Column, span: int) -> Column:
    """One value more: a*x + (1-a)*mean; the first value starts the mean, a
    missing one leaves it."""
    a = smoothing(span)
    b = 1.0 - a
    moved = (F.lit(b) * mean + F.lit(a) * x) / F.lit(b + a)
    return F.when(mean.isNull(), x).when(x.isNull() | (x == mean), mean).otherwise(moved)


def fold(df: DataFrame, start: dict[str, Column], step, keys=("symbol",)) -> DataFrame:
    """Running values of a recursion over each ordered series, as new columns.

    ``start`` names the values, ``step(values, row)`` gives the next ones.  A
    recursion is no frame aggregate, so each series (a row per day, bounded by
    the calendar) is gathered in date order and folded by ``aggregate``."""
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("date", *[c for c in df.columns if c not in ("date", *keys)]))).alias("_s"))
    state = F.struct(*[v.alias(n) for n, v in start.items()])
    none = F.filter(F.array(state), lambda x: F.lit(False))

    def add(acc: Column, row: Column) -> Column:
        now = F.struct(*[v.alias(n) for n, v in step(acc["now"], row).items()])
        return F.struct(now.alias("now"), F.concat(acc["out"], F.array(now)).alias("out"))

    out = F.aggregate("_s", F.struct(state.alias("now"), none.alias("out")), add, lambda acc: acc["out"])
    both = rows.select(*keys, F.explode(F.arrays_zip(F.col("_s").alias("r"), out.alias("v"))).alias("_z"))
    return both.select(*[F.col(c) if c in keys else F.col(f"_z.r.`{c}`").alias(c) for c in df.columns],
                       *[F.col(f"_z.v.`{n}`").alias(n) for n in start])


def ema(df: DataFrame, spans: dict[str, int] | None = None, src: str = "close", keys=("symbol",)) -> DataFrame:
    """Recursive EMA, e0 = x0, e_t = a*x_t + (1-a)*e_{t-1}, a = 2/(span+1)."""
    spans = spans or {"EMA": 20}
    null = F.lit(None).cast("double")

    def step(now: Column, row: Column) -> dict[str, Column]:
        return {n: ema_step(now[n], nan_to_null(row[src]), span) for n, span in spans.items()}
    return fold(df, {n: null for n in spans}, step, keys)


def macd(df: DataFrame, src: str = "close", fast: int = 12, slow: int = 26, sig: int = 9, keys=("symbol",)) -> DataFrame:
    """MACD = EMA(fast) - EMA(slow); signal = EMA(sig) of MACD; histogram.
    All three averages in one fold."""
    null = F.lit(None).cast("double")

    def step(now: Column, row: Column) -> dict[str, Column]:
        x = nan_to_null(row[src])
        short, long = ema_step(now["EMA_Short"], x, fast), ema_step(now["EMA_Long"], x, slow)
        return {"EMA_Short": short, "EMA_Long": long, "Signal_Line": ema_step(now["Signal_Line"], short - long, sig)}
    both = fold(df, {n: null for n in ("EMA_Short", "EMA_Long", "Signal_Line")}, step, keys)
    line = F.col("EMA_Short") - F.col("EMA_Long")
    return both.withColumns({"MACD": line, "MACD_Histogram": line - F.col("Signal_Line")})


def indicator_readout(df: DataFrame, keys=("symbol",)) -> DataFrame:
    """RSI / MACD interpretation on each symbol's latest row.  The latest
    row comes from ``max_by`` (a partial aggregate, no per-symbol sort)."""
    last = df.groupBy(*keys).agg(
        F.max("date").alias("date"),
        F.max_by(F.struct("RSI", "MACD", "Signal_Line"), "date").alias("l"))
    r, m, s = F.col("l.RSI"), F.col("l.MACD"), F.col("l.Signal_Line")
    return last.select(
        *keys, "date", r.alias("RSI"), m.alias("MACD"),
        F.when(is_true(r > RSI_HIGH), RSI_LABELS[0]).when(is_true(r < RSI_LOW), RSI_LABELS[1])
         .otherwise(RSI_LABELS[2]).alias("rsi_reading"),
        F.when(is_true(m > s), MACD_LABELS[0]).otherwise(MACD_LABELS[1]).alias("macd_reading"))


def intraday(df: DataFrame, keys=("symbol",)) -> DataFrame:
    """Intraday change % rounded to 2 and a 2-digit SMA-10.  Prices are
    quoted in cents, so the mean is taken over whole cents (an exact integer
    sum): rounding a half-cent mean then cannot depend on summation order."""
    frame = trailing(series_window(keys), 10)
    cents = F.round(F.col("close") * 100).cast("bigint")
    n = F.count("close").over(frame)
    mean = F.sum(cents).over(frame).cast("double") / n / 100
    return df.withColumns({
        "Evolucion_pct": rnd_even(safe_div(F.col("close") - F.col("open"), F.col("open")) * 100, 2),
        "Media_Movil_10": rnd_even(F.when(n >= 10, mean), 2),
    })


def vix_regime(c: str | Column = "close") -> Column:
    """Volatility regime; a NULL level compares false and lands in the top bucket."""
    x = nan_to_null(c)
    out = None
    for bound, name in VIX_BUCKETS:
        cond = is_true(x < bound)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(VIX_TOP)


def distribution(df: DataFrame, c: str) -> DataFrame:
    """Count and percentage of rows per value.  The total is a
    scalar subquery (one number), not a window over the whole table."""
    total = df.select(F.count(F.lit(1))).scalar()
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).select(
        c, "n", (F.col("n") * 100.0 / total).alias("pct"))


def return_stats(df: DataFrame, keys=("symbol",), periods: int = 252) -> DataFrame:
    """Mean daily return, daily std, annualised std and total return."""
    ret = df.withColumn("r", daily_return("close", keys))
    return ret.groupBy(*keys).agg(
        F.avg("r").alias("mean_return"),
        F.stddev_samp("r").alias("daily_std"),
        (F.stddev_samp("r") * math.sqrt(periods)).alias("annual_std"),
        (safe_div(F.max_by("close", "date"), F.min_by("close", "date")) - 1).alias("total_return"))


def last_n(df: DataFrame, n: int, keys=("symbol",)) -> DataFrame:
    """Keep each symbol's last n rows (per-symbol row_number, bounded frame)."""
    w = series_window(keys).orderBy(F.col("date").desc())
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


def candle_direction(df: DataFrame, n: int = 252, keys=("symbol",)) -> DataFrame:
    """Candle colour (close >= open) over the last n bars."""
    return last_n(df, n, keys).withColumn(
        "candle", F.when(is_true(F.col("close") >= F.col("open")), "g").otherwise("r"))


def fundamental_ratios(info: DataFrame) -> DataFrame:
    """Ratios from a company-info record; missing inputs give NULL / 0."""
    debt, assets = F.col("total_debt"), F.col("total_assets")
    dy, pm = F.col("dividend_yield"), F.col("profit_margins")
    return info.select(
        "symbol",
        F.when(debt.isNotNull() & assets.isNotNull() & (assets != 0), debt / assets).alias("debt_to_assets"),
        F.when(dy.isNotNull() & (dy != 0), F.format_string("%.2f%%", dy * 100)).otherwise("0%").alias("dividend_text"),
        F.format_string("%.2f%%", F.coalesce(pm, F.lit(0.0)) * 100).alias("margin_text"),
        F.coalesce(F.col("market_cap"), F.lit(0.0)).alias("market_cap"),
    )


def candidate_features(df: DataFrame, keys=("symbol",)) -> DataFrame:
    """RSI_Signal, Sentiment_Momentum (rolling-5 mean, min 1) and
    Volume_Spike (volume > 1.5 x rolling-20 mean, min 1)."""
    w = series_window(keys)
    r = F.col("RSI")
    return df.withColumns({
        "RSI_Signal": is_true(r < RSI_LOW).cast("int") - is_true(r > RSI_HIGH).cast("int"),
        "Sentiment_Momentum": rolling(F.avg, "sentimiento_promedio", w, 5, 1),
        "Volume_Spike": is_true(F.col("volume") > rolling(F.avg, "volume", w, 20, 1) * 1.5).cast("int"),
    })
