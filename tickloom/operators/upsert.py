"""Incremental maintenance.

Newest-wins merges are ``max(struct(batch_seq, row))`` aggregates keyed by
(symbol, date).  Structs aggregate by sort (not by hash), partially before the
shuffle, so restated copies of a hot key are combined map-side and no window
has to sort a whole key.  Merged tables are written to the shared folder
(``spark.checkpoint.dir``) and re-read, which also cuts the lineage; with
dynamic partition overwrite only the touched partitions are rewritten.

A stored table is a folder of versions ``v=N``.  A version counts once its
``_SUCCESS`` mark is there; what a killed write left behind never does.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .contracts import validate


def newest_wins(df: DataFrame, keys: list[str], seq: str = "batch_seq", keep_seq: bool = False) -> DataFrame:
    """One row per key, the row of the highest batch sequence wins.  Rows
    that tie in it are ordered by their other columns, so the result does not
    depend on the order of rows."""
    others = [c for c in df.columns if c not in keys and c != seq]
    latest = F.max(F.struct(seq, *others)).alias("_r")
    kept = [c for c in df.columns if c not in keys and (keep_seq or c != seq)]
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in kept])


def append_and_dedup(history: DataFrame | None, new: DataFrame, keys: list[str], seq: str = "batch_seq") -> DataFrame:
    """Union the history with a new batch (by name) and keep the newest row per key."""
    merged = new if history is None else history.unionByName(new, allowMissingColumns=True)
    return newest_wins(merged, keys, seq)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """An unreadable / missing history is treated as absent (overwrite)."""
    try:
        df = spark.read.parquet(path)
        df.schema  # noqa: B018 - forces the file listing
        return df
    except AnalysisException:
        return None


def versions(spark: SparkSession, root: str, committed: bool = True) -> list[int]:
    """Numbers of the versions under ``root``, ascending: the committed ones, or
    all whose folder exists."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    p = path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    found = [n for n in names if n.startswith("v=") and n[2:].isdigit()]
    return sorted(int(n[2:]) for n in found if not committed or fs.exists(path(f"{root}/{n}/_SUCCESS")))


def drop_versions(spark: SparkSession, root: str, keep: int) -> None:
    """Remove the committed versions before the last ``keep``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for v in versions(spark, root)[:-keep]:
        p = path(f"{root}/v={v}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_table_version(spark: SparkSession, root: str) -> DataFrame:
    """The last committed version of a stored table."""
    return spark.read.parquet(f"{root}/v={versions(spark, root)[-1]}")


def upsert_table(spark: SparkSession, root: str, new: DataFrame, keys: list[str], seq: str = "batch_seq",
                 contract=None, stage: str = "upsert", unreadable_is_absent: bool = False) -> DataFrame:
    """C1-C4 on a stored table.  Each merge reads the last committed version
    under ``root``, merges newest-wins keeping the batch sequence, optionally
    checks the contract (C4) and writes the next version: readers never see a
    half-written table and no folder is written twice.  A table without a
    committed version has no history; a committed version that cannot be read
    is an error, unless the caller says that it counts as absent (C3)."""
    done = versions(spark, root)
    hist = None
    if done:
        last = f"{root}/v={done[-1]}"
        hist = read_or_none(spark, last) if unreadable_is_absent else spark.read.parquet(last)
    merged = new if hist is None else hist.unionByName(new, allowMissingColumns=True)
    merged = newest_wins(merged, keys, seq, keep_seq=True)
    if contract is not None:
        validate(merged, contract, stage)
    out = f"{root}/v={max(versions(spark, root, committed=False), default=0) + 1}"
    merged.write.parquet(out)
    return spark.read.parquet(out)


def touched_keys(new: DataFrame, key: str = "symbol") -> DataFrame:
    return new.select(key).distinct()


def recompute_touched(history: DataFrame, new: DataFrame, compute, key: str = "symbol") -> DataFrame:
    """Recompute derived columns over the merged history of the symbols a
    batch touched only (``left_semi``), not over the whole table."""
    return compute(history.join(touched_keys(new, key), key, "left_semi"))


def replace_matching(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Drop old rows whose key is in the new run, then append the new run."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def pending_days(candidates: DataFrame, processed: DataFrame, keys: list[str]) -> DataFrame:
    """Days still to process = candidates without a finished checkpoint."""
    return candidates.join(processed.select(*keys).distinct(), keys, "left_anti")


DAY_ROWS = 100_000      # of a day that one file holds, unless that takes more than ``parts`` files
NO_MERGE_AT_THE_END = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}    # tasks move their files side by side


def by_day(df: DataFrame, day: str, parts: int, sizes: DataFrame | None = None) -> DataFrame:
    """Rows dealt for a write by day: a small day goes to one task, one of more than ``DAY_ROWS`` rows to up to
    ``parts`` by a salt.  The number of tasks is given, as it is the files that take the time: merged by their few
    bytes, the days would be written by one task.  ``sizes``: the rows whose days are counted, if not ``df``."""
    n = F.ceil(F.count(F.lit(1)) / DAY_ROWS)
    large = (sizes or df).groupBy(F.col(day).alias("_day")).agg(F.least(n, F.lit(parts)).alias("_files")).where("_files > 1")
    dealt = df.join(F.broadcast(large), F.col(day).eqNullSafe(F.col("_day")), "left")
    salt = F.pmod(F.xxhash64(*df.columns), F.coalesce("_files", F.lit(1)))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, F.col(day), salt).select(*df.columns)


def write_days(df: DataFrame, path: str, day: str = "fecha_limpia", parts: int = 4) -> None:
    """Dynamic partition overwrite - only the days present in ``df`` are
    replaced.  Rows are shuffled by day first (``by_day``), so a day has one
    file, or up to ``parts`` if it is large, however many tasks made the rows."""
    (by_day(df, day, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**NO_MERGE_AT_THE_END)
     .partitionBy(day).parquet(path))


def _months(first: str, last: str) -> list[str]:
    """The months from one ISO day to another, as yyyy-mm."""
    a, b = (int(d[:4]) * 12 + int(d[5:7]) - 1 for d in (first, last))
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(a, b + 1)]


def consolidate(spark: SparkSession, path: str, start: str, end: str, day: str = "fecha_limpia",
                id_col: str = "tweet_id") -> DataFrame:
    """All day chunks in [start, end]; none -> error; rows without an id
    dropped.  Only the folders of these days are listed, not the whole table's."""
    first, last = dt.date.fromisoformat(start).isoformat(), dt.date.fromisoformat(end).isoformat()
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # a brace pattern of the months lists the root once and matches only what lies near the range
    near = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"{day}={{{','.join(_months(first, last))}}}-*"))
    names = [st.getPath().getName() for st in near or []]
    inside = [n for n in names if first <= n.split("=", 1)[1] <= last]
    if not inside:
        raise FileNotFoundError(f"no day chunks between {start} and {end}")
    df = spark.read.option("basePath", path).parquet(*[f"{path}/{n}" for n in inside])
    if df.isEmpty():
        raise FileNotFoundError(f"no day chunks between {start} and {end}")
    return df.dropna(subset=[id_col])
