"""Column hygiene and data-quality operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import col

# Java and RE2 agree on this explicit whitespace class (\s differs on \x0B).
WS = "[\\t\\n\\x0B\\f\\r ]+"


def lower_headers(df: DataFrame) -> DataFrame:
    """Strip (including a leading byte-order mark) and lower-case every column name."""
    return df.toDF(*[c.lstrip("\ufeff").strip().lower() for c in df.columns])


def map_columns(df: DataFrame, mapping: dict[str, str], required: T.StructType) -> DataFrame:
    """Rename by mapping, then add every missing required column as a typed NULL."""
    df = df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
    missing = {f.name: F.lit(None).cast(f.dataType) for f in required.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with a NULL in any key column."""
    return df.dropna(subset=keys)


def coerce_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """Parse to a UTC timestamp; unparsable -> NULL (session time zone is UTC)."""
    x = col(c)
    return F.try_to_timestamp(x, F.lit(fmt)) if fmt else F.try_to_timestamp(x)


def counter(c: str | Column) -> Column:
    """Counter cleanup - NULL / unparsable -> 0, then integer (truncating)."""
    return F.coalesce(col(c).cast("string").try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def one_line(c: str | Column) -> Column:
    """Collapse every whitespace run (CR and LF included) into one space, trim."""
    return F.trim(F.regexp_replace(col(c), WS, " "))


def count_from_label(c: str | Column) -> Column:
    """First whitespace token of a label such as "5 retweets"; empty -> "0"."""
    first = F.get(F.split(F.trim(F.coalesce(col(c), F.lit(""))), " "), 0)
    return F.coalesce(F.nullif(first, F.lit("")), F.lit("0"))


def id_from_url(c: str | Column) -> Column:
    """The last path segment of a URL."""
    return F.element_at(F.split(col(c), "/"), -1)


def first_seen(df: DataFrame, key: str, arrival: str, cap: int | None = None) -> DataFrame:
    """One row per id, the first seen wins (``min_by`` - a partial
    aggregate, safe for a hot id); optionally the first ``cap`` ids by arrival."""
    others = [c for c in df.columns if c != key]
    d = df.groupBy(key).agg(F.min_by(F.struct(*others), F.col(arrival)).alias("_r")).select(key, "_r.*")
    if cap is not None:
        d = d.orderBy(arrival, key).limit(cap)
    return d


def sparse_columns(df: DataFrame, threshold: float = 0.5) -> list[str]:
    """B12 (planning step): columns whose NULL share exceeds the threshold.
    One aggregate pass; only one number per column reaches the driver."""
    row = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] is not None and row[c] > threshold]


def drop_sparse_then_incomplete(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Drop columns with more than ``threshold`` missing, then rows with any NULL."""
    return df.drop(*sparse_columns(df, threshold)).dropna("any")


def drop_incomplete_with_count(df: DataFrame) -> tuple[DataFrame, Column]:
    """Drop rows with any NULL; the removed count as a column expression
    over the original frame (count - count of complete rows)."""
    complete = F.count_if(F.greatest(*[F.col(f"`{c}`").isNull() for c in df.columns]) == F.lit(False))
    return df.dropna("any"), (F.count(F.lit(1)) - complete)


def profile(df: DataFrame, keys=("symbol",), date: str = "date") -> DataFrame:
    """Period start / end, rows and years = days / 365."""
    return df.groupBy(*keys).agg(F.min(date).alias("start"), F.max(date).alias("end"),
                                 F.count(F.lit(1)).alias("rows")).withColumn(
        "years", F.datediff("end", "start") / 365.0)


def describe(df: DataFrame, c: str, keys=("symbol",)) -> DataFrame:
    """Count, mean, std, min, 25/50/75 % (linear interpolation), max.  The
    percentiles are exact: they hold a count for each distinct value of a group,
    so the groups should be series (a value a day), not raw rows."""
    q = F.percentile(F.col(c), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    d = df.groupBy(*keys).agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                              F.min(c).alias("min"), q.alias("_q"), F.max(c).alias("max"))
    return d.select(*keys, "count", "mean", "std", "min", F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"),
                    F.col("_q")[2].alias("p75"), "max")
