"""File sources and sinks (A1-A9): CSV with declared schemas, folder unions,
day-partitioned writes, append-only collection and parameters from file names."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import NO_MERGE_AT_THE_END, by_day


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A1 / A2: CSV with a header and a declared schema (no inference; an id
    declared as string stays a string, long ids never become floats).  A field
    that does not fit its declared type is an error, not a NULL."""
    r = spark.read.option("header", True)
    return r.schema(schema).option("mode", "FAILFAST").csv(path) if schema is not None else r.csv(path)


def read_csv_union(spark: SparkSession, parts: list[tuple[str, T.StructType | None]]) -> DataFrame:
    """A3: read several CSV files / folders whose headers may differ (each with
    its schema) and union them by column name, missing columns as NULL."""
    frames = [read_csv(spark, p, schema) for p, schema in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


BOM = "\ufeff"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", bom: bool = False) -> None:
    """A4: write a table as CSV with a header (UTF-8); ``bom`` starts every
    part file's header with a UTF-8 byte-order mark (as the news file is written)."""
    if bom and df.columns:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    (df.write.mode(mode).option("header", True).option("encoding", "UTF-8")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """A4: write a table as parquet (the engine's native layer format)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def partition_by_day(df: DataFrame, path: str, ts_col: str = "Fecha_UTC", fmt: str | None = None,
                     day_col: str = "solo_fecha", parts: int = 4) -> int:
    """A5: coerce the timestamp, drop unparsable rows (their count is
    returned, observed while writing), write one folder per calendar day; the
    helper day column lives only in the folder name.  Rows are shuffled by day
    first (``by_day``): a day has one file, or up to ``parts`` if it is large,
    however many tasks made the rows."""
    from pyspark.sql import Observation
    ts = F.try_to_timestamp(F.col(ts_col), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(ts_col))
    obs = Observation("partition_by_day")
    timed = df.withColumn("_ts", ts)

    def dated(t: DataFrame) -> DataFrame:
        return t.where(F.col("_ts").isNotNull()).withColumn(day_col, F.to_date("_ts")).drop("_ts")
    d = dated(timed.observe(obs, F.count_if(F.col("_ts").isNull()).alias("dropped")))
    (by_day(d, day_col, parts, dated(timed)).write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).options(**NO_MERGE_AT_THE_END).partitionBy(day_col).csv(path))
    return int(obs.get["dropped"])


# Raw-post fields, platform names and defaults.
RAW_POST_FIELDS = [("ID_Tweet", "id", ""), ("Fecha_UTC", "published_time", ""), ("Contenido_Texto", "text", ""),
                   ("Retweets", "reposts", "0"), ("Favoritos", "likes", "0")]


def normalise_raw_posts(df: DataFrame) -> DataFrame:
    """Platform fields -> raw schema, string typed, with defaults for missing values."""
    out = []
    for raw, src, default in RAW_POST_FIELDS:
        c = F.col(src).cast("string") if src in df.columns else F.lit(None).cast("string")
        out.append(F.coalesce(c, F.lit(default)).alias(raw))
    return df.select(*out)


def range_name(ticker: Column, start: str, end: str) -> Column:
    """File name of a date range."""
    return F.concat(ticker, F.lit(f"_{start}_{end}"))


def range_bounds(start: str, end: str) -> tuple[str, str]:
    """Half-open [start, end) download range; a single-day range widens
    the exclusive end by one day."""
    if start == end:
        end = (dt.date.fromisoformat(end) + dt.timedelta(days=1)).isoformat()
    return start, end


def in_range(date: str | Column, start: str, end: str) -> Column:
    s, e = range_bounds(start, end)
    d = F.col(date) if isinstance(date, str) else date
    return (d >= F.lit(s).cast("date")) & (d < F.lit(e).cast("date"))


def append_rows(df: DataFrame, path: str) -> None:
    """Append-only collection (the header is written with every part file,
    so each file stays self-describing)."""
    df.write.mode("append").option("header", True).csv(path)


def params_from_name(name: str | Column) -> Column:
    """``prefix_kind_TICKER_YYYYMMDD_YYYYMMDD`` -> struct(ticker, start, end,
    safe); the ticker may contain '_'; fewer than five parts raise an error."""
    n = F.regexp_replace(F.col(name) if isinstance(name, str) else name, "\\.csv$", "")
    parts = F.split(n, "_")
    k = F.size(parts)
    ticker = F.array_join(F.slice(parts, 3, k - 4), "_")
    ok = k >= 5
    return F.when(ok, F.struct(
        ticker.alias("ticker"),
        F.to_date(F.element_at(parts, -2), "yyyyMMdd").alias("start_date"),
        F.to_date(F.element_at(parts, -1), "yyyyMMdd").alias("end_date"),
        F.regexp_replace(F.lower(ticker), " ", "_").alias("safe_name"),
    )).otherwise(F.raise_error(F.concat(F.lit("file name does not match prefix_kind_TICKER_start_end: "), n)))


def source_file_dir(levels_up: int = 1) -> Column:
    """The folder name that holds each row's input file (``input_file_name``)."""
    return F.element_at(F.split(F.input_file_name(), "/"), -1 - levels_up)
