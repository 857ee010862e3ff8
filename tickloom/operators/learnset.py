"""Learning-set preparation (H1-H8): chronological splits, scaling with train
statistics, class weights and fixed-length sequence windows.

Every step is a window partitioned by symbol (and split) ordered by date, or
a one-row-per-symbol aggregate joined back on the key.  A symbol's window
holds one row per trading day, so its size is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import series_window


def chrono_split(df: DataFrame, frac: float = 0.8, keys=("symbol",)) -> DataFrame:
    """H1: the first int(frac * n) rows of each symbol are 'train', the rest 'test'."""
    rn = F.row_number().over(series_window(keys))
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("split", F.when(rn <= F.floor(n * frac), "train").otherwise("test"))


def scaler_stats(df: DataFrame, cols: list[str], keys=("symbol",), fit_on: str | None = "train") -> DataFrame:
    """H2: per-symbol mean and population std (ddof=0) of the fitting rows;
    a zero std becomes 1 (as the reference's scaler does)."""
    fit = df.where(F.col("split") == fit_on) if fit_on else df
    aggs = []
    for c in cols:
        sd = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"_mu_{c}"), F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"_sd_{c}")]
    return fit.groupBy(*keys).agg(*aggs)


def standardise(df: DataFrame, cols: list[str], keys=("symbol",), fit_on: str | None = "train") -> DataFrame:
    """H2: z-scores with the train statistics applied to every row
    (``fit_on=None`` refits on the rows being scored, as the scoring path does)."""
    st = scaler_stats(df, cols, keys, fit_on)
    j = df.join(st, list(keys), "left")
    return j.withColumns({c: (F.col(c) - F.col(f"_mu_{c}")) / F.col(f"_sd_{c}") for c in cols}).drop(
        *[f"_mu_{c}" for c in cols], *[f"_sd_{c}" for c in cols])


def class_weights(df: DataFrame, label: str = "target_direction", keys=("symbol",), fit_on: str | None = "train",
                  weight: str = "weight") -> DataFrame:
    """H3: balanced weights n / (2 * n_class) from the fitting rows, joined on (key, class)."""
    fit = df.where(F.col("split") == fit_on) if fit_on else df
    cnt = fit.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = fit.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    w = cnt.join(tot, list(keys)).select(*keys, label, (F.col("_n") / (2.0 * F.col("_nc"))).alias(weight))
    return df.join(w, [*keys, label], "left")


def _row(cols: list[str]) -> Column:
    return F.struct(F.col("date"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))


def train_sequences(df: DataFrame, cols: list[str], length: int = 5, label: str = "target_direction",
                    keys=("symbol",)) -> DataFrame:
    """H5: rows i-L .. i-1 -> label of row i, built inside each split, so the
    first L rows of every split have no sequence.  Splits with <= L rows are an error.
    ``df`` is read twice (once for that check): give a stored table."""
    sizes = df.groupBy(*keys, "split").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= length)
    if not sizes.isEmpty():
        raise ValueError(f"a split has no more rows than the sequence length {length}")
    w = series_window((*keys, "split")).rowsBetween(-length, -1)
    s = df.withColumn("seq", F.collect_list(_row(cols)).over(w))
    return s.where(F.size("seq") == length).select(*keys, "split", "date", "seq", F.col(label).alias("label"))


def score_sequences(df: DataFrame, cols: list[str], length: int = 10, keys=("symbol",)) -> DataFrame:
    """H6: rows i-L+1 .. i (current row included), left-padded by repeating
    the series' first row, so every row gets a full sequence."""
    w = series_window(keys)
    arr = F.collect_list(_row(cols)).over(w.rowsBetween(-(length - 1), 0))
    first = F.first(_row(cols)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    s = df.withColumns({"_arr": arr, "_first": first})
    pad = F.array_repeat(F.col("_first"), F.lit(length) - F.size("_arr"))
    return s.withColumn("seq", F.concat(pad, F.col("_arr"))).drop("_arr", "_first")


def validation_tail(seqs: DataFrame, frac: float = 0.2, keys=("symbol",)) -> DataFrame:
    """H7: the last int(frac * n) training sequences (in date order) are the validation part."""
    tr = seqs.where(F.col("split") == "train")
    rn = F.row_number().over(series_window(keys))
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return tr.withColumn("part", F.when(rn > n - F.floor(n * frac), "val").otherwise("fit"))


def drop_unlabelled_tail(df: DataFrame, cols: list[str], keys=("symbol",)) -> DataFrame:
    """H8: drop rows with a NULL feature, then each symbol's last row (no next day)."""
    d = df.dropna(subset=cols).withColumn("_next", F.lead("date").over(series_window(keys)))
    return d.where(F.col("_next").isNotNull()).drop("_next")
