"""Exploratory analytics (L1-L15): correlations, histograms, error analysis,
calibration and sampling - all as aggregates, no driver-side loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import pair_corr, rnd, safe_div, series_window

# Rankings use values rounded to 9 digits, so that ties in exact arithmetic
# (equal up to the last bits) resolve by the stated tie rule.
RANK_DIGITS = 9
from .indicators import last_n


def next_day_return(c: str = "close", keys=("symbol",)) -> Column:
    """L1: lead(close) / close - 1 (NULL on the last row)."""
    return safe_div(F.lead(c).over(series_window(keys)), F.col(c)) - 1


def yearly_means(df: DataFrame, cols: list[str], keys=("symbol",), year: str = "year") -> DataFrame:
    """Per-year means."""
    return df.groupBy(*keys, year).agg(*[F.avg(c).alias(c) for c in cols])


def _stack(df: DataFrame, keys, names: list[str], value: str, label: str = "feature") -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return df.select(*keys, F.expr(f"stack({len(names)}, {pairs}) AS ({label}, {value})"))


def corr_matrix(df: DataFrame, cols: list[str], keys=("symbol",)) -> DataFrame:
    """L3: Pearson correlation of every pair (pairwise non-null rows), one
    aggregate, long form (f1, f2, corr); NaN (constant column) -> NULL.  A pair
    is computed once and mirrored in the long form."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.groupBy(*keys).agg(*[pair_corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [(a, b, f"{a}|{b}") for a, b in pairs] + [(b, a, f"{a}|{b}") for a, b in pairs if a != b]
    rows = ", ".join(f"'{a}', '{b}', `{name}`" for a, b, name in cells)
    return wide.select(*keys, F.expr(f"stack({len(cells)}, {rows}) AS (f1, f2, corr)"))


def zscores_last(df: DataFrame, cols: list[str], n: int = 252, keys=("symbol",)) -> DataFrame:
    """L4: (x - mean) / sample std over each symbol's last n rows."""
    from pyspark.sql import Window
    t = last_n(df, n, keys)
    w = Window.partitionBy(*keys)
    return t.select(*keys, "date", *[safe_div(F.col(c) - F.avg(c).over(w), F.stddev_samp(c).over(w)).alias(c)
                                     for c in cols])


def corr_with_target(df: DataFrame, cols: list[str], target: str, keys=("symbol",)) -> DataFrame:
    """L6 / L7 (long form): correlation of each column with the target."""
    wide = df.groupBy(*keys).agg(*[pair_corr(c, target).alias(c) for c in cols])
    return _stack(wide, keys, cols, "corr")


def top_bottom(corrs: DataFrame, n: int = 10, keys=("symbol",)) -> DataFrame:
    """The n highest and the n lowest correlations (descending, NULL last,
    as pandas sorts); a feature can appear in both lists."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(rnd("corr", RANK_DIGITS).desc_nulls_last(), F.col("feature"))
    r = corrs.withColumns({"rank": F.row_number().over(w), "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys))})
    sides = F.array_compact(F.array(F.when(F.col("rank") <= n, "top"), F.when(F.col("rank") > F.col("_n") - n, "bottom")))
    return r.select("*", F.explode(sides).alias("side")).drop("_n")


def histogram(df: DataFrame, c: str, bins: int = 50, keys=("symbol",), density: bool = True) -> DataFrame:
    """Equal-width histogram between the min and the max (last bin closed
    on the right); density = count / (n * width).  The per-group min / max is
    a one-row-per-group aggregate joined back on the key."""
    x = df.where(F.col(c).isNotNull())
    rng = x.groupBy(*keys).agg(F.min(c).alias("_lo"), F.max(c).alias("_hi"), F.count(F.lit(1)).alias("_n"))
    j = x.join(rng, list(keys))
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(c) - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))), F.lit(bins - 1)))
    h = j.groupBy(*keys, idx.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"),
        F.first("_n").alias("_n"))
    out = h.select(*keys, "bin", "count", (F.col("_lo") + F.col("bin") * width).alias("left"),
                   (F.col("_lo") + (F.col("bin") + 1) * width).alias("right"),
                   safe_div(F.col("count"), F.col("_n") * width).alias("density") if density else F.lit(None))
    return out


def error_table(preds: DataFrame, prob: str = "confidence", pred: str = "predicted_signal",
                label: str = "label") -> DataFrame:
    """Error flag and the prediction's confidence margin |p - 0.5|
    (named ``margin``: column names are case-insensitive, and the signal
    table already calls the probability ``confidence``)."""
    return preds.withColumns({"Error": (F.col(pred) != F.col(label)).cast("int"),
                              "margin": F.abs(F.col(prob) - 0.5)})


def error_by_confidence(err: DataFrame, keys=("model",), bins: int = 10) -> DataFrame:
    """Error rate in 10 equal-width right-closed confidence bins
    (``greatest(1, ceil((x - min) / width))``); empty bins are absent."""
    rng = err.groupBy(*keys).agg(F.min("margin").alias("_lo"), F.max("margin").alias("_hi"))
    j = err.join(rng, list(keys))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = safe_div(F.col("margin") - F.col("_lo"), width, 1.0)         # all margins equal: one bin
    b = F.greatest(F.lit(1), F.ceil(place)).cast("int")
    return j.groupBy(*keys, b.alias("bin")).agg(F.avg("Error").alias("error_rate"), F.count(F.lit(1)).alias("n"))


def monthly_errors(err: DataFrame, keys=("model", "symbol")) -> DataFrame:
    """Errors per calendar month, every month between the first and the
    last (gaps appear with count 0 and a NULL rate)."""
    e = err.withColumn("month", F.trunc("date", "MM"))
    agg = e.groupBy(*keys, "month").agg(F.sum("Error").alias("errors"), F.count(F.lit(1)).alias("n"))
    span = agg.groupBy(*keys).agg(F.min("month").alias("_a"), F.max("month").alias("_b"))
    cal = span.select(*keys, F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    out = cal.join(agg, [*keys, "month"], "left")
    return out.select(*keys, "month", F.coalesce("errors", F.lit(0)).alias("errors"),
                      F.coalesce("n", F.lit(0)).alias("n"),
                      F.try_divide(F.col("errors"), F.col("n")).alias("error_rate"))


def worst_best_month(monthly: DataFrame, keys=("model", "symbol")) -> DataFrame:
    """Worst / best month (first month wins a tie; empty months ignored)."""
    m = monthly.where(F.col("error_rate").isNotNull()).withColumn(
        "_ord", F.months_between(F.col("month"), F.lit("1900-01-01").cast("date")).cast("int"))
    return m.groupBy(*keys).agg(
        F.max_by("month", F.struct(F.col("error_rate"), -F.col("_ord"))).alias("worst_month"),
        F.min_by("month", F.struct(F.col("error_rate"), F.col("_ord"))).alias("best_month"))


def feature_gap(df: DataFrame, cols: list[str], keys=("model", "symbol"), n: int = 10) -> DataFrame:
    """Feature means on right vs wrong predictions; the n largest |gap|."""
    from pyspark.sql import Window
    ok, bad = F.col("Error") == 0, F.col("Error") == 1
    wide = df.groupBy(*keys).agg(*[F.avg(F.when(ok, F.col(c))).alias(f"{c}|ok") for c in cols],
                                 *[F.avg(F.when(bad, F.col(c))).alias(f"{c}|bad") for c in cols])
    names = ", ".join(f"'{c}', `{c}|ok`, `{c}|bad`" for c in cols)
    long = wide.select(*keys, F.expr(f"stack({len(cols)}, {names}) AS (feature, correct_mean, error_mean)"))
    long = long.withColumn("abs_gap", F.abs(F.col("error_mean") - F.col("correct_mean")))
    w = Window.partitionBy(*keys).orderBy(rnd("abs_gap", RANK_DIGITS).desc_nulls_last(), "feature")
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def calibration(df: DataFrame, prob: str = "confidence", label: str = "label", keys=("model",),
                bins: int = 10) -> DataFrame:
    """Uniform bins on [0, 1], right-closed (first bin includes 0); empty bins absent."""
    b = F.least(F.greatest(F.ceil(F.col(prob) * bins), F.lit(1)), F.lit(bins)).cast("int")
    return df.groupBy(*keys, b.alias("bin")).agg(F.avg(label).alias("fraction_of_positives"),
                                                  F.avg(prob).alias("mean_predicted_value"),
                                                  F.count(F.lit(1)).alias("n"))


def high_confidence_errors(err: DataFrame, keys=("model",), threshold: float = 0.3) -> DataFrame:
    """Errors made with confidence above the threshold: count and share %."""
    hc = (F.col("Error") == 1) & (F.col("margin") > threshold)
    return err.groupBy(*keys).agg(F.count_if(hc).alias("n_high_conf_errors"),
                                  (F.count_if(hc) * 100.0 / F.count(F.lit(1))).alias("share_pct"))


def preview_sample(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """A reproducible random preview of n rows: order by a hash of
    (seed, id) and keep n (the limit is the operator)."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    return df.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")
