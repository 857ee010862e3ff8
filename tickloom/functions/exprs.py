"""Column-expression helpers shared by the operators.

All of them stay inside Catalyst (no Python per row), so they compile into the
surrounding whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """pandas treats NaN as missing; Spark compares NaN as the largest value.
    Convert at the door so that comparisons and aggregates ignore it (S1)."""
    x = col(c)
    return F.when(~F.isnan(x.cast("double")), x)


def is_true(cond: Column) -> Column:
    """NULL-safe predicate: a missing comparison is False, as in pandas."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 int, NULL counted as 0."""
    return is_true(cond).cast("int")


def safe_div(num: Column, den: Column, when_zero: Column | float | None = None) -> Column:
    """num/den with an explicit answer for a zero denominator (S2: ANSI mode
    raises on x/0, pandas gives inf)."""
    zero = F.lit(when_zero) if not isinstance(when_zero, Column) else when_zero
    return F.when(den == 0, zero).otherwise(num / den)


def series_window(keys: tuple[str, ...] | list[str] = ("symbol",), order: str = "date") -> WindowSpec:
    """The one window spec of a time series: partitioned by its key, ordered by date."""
    return Window.partitionBy(*keys).orderBy(order)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """Frame of the current row and the n-1 rows before it."""
    return w.rowsBetween(-(n - 1), 0)


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def rolling(agg, c: str | Column, w: WindowSpec, n: int, min_periods: int | None = None) -> Column:
    """pandas ``rolling(n, min_periods).agg()``: NULL until ``min_periods``
    non-null values are in the frame (S4)."""
    need = n if min_periods is None else min_periods
    frame = trailing(w, n)
    x = col(c)
    return F.when(F.count(x).over(frame) >= need, agg(x).over(frame))


def rnd(c: str | Column, digits: int = 6) -> Column:
    """Round half away from zero on the binary value: round(x * 10^d) / 10^d.
    (``F.round`` rounds the shortest decimal string half-up, which differs on
    exact decimal ties; this form is the one other engines use.)"""
    m = float(10 ** digits)
    return F.round(col(c) * m, 0) / m


def rnd_even(c: str | Column, digits: int = 2) -> Column:
    """numpy/pandas ``round``: half to even on x * 10^d."""
    m = float(10 ** digits)
    return F.bround(col(c) * m, 0) / m


def pair_corr(a: str, b: str) -> Column:
    """Pearson correlation over the rows where both values exist (pandas'
    pairwise rule); NULL for a constant column (ANSI ``corr`` would raise)."""
    x = F.when(F.col(b).isNotNull(), F.col(a))
    y = F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
