"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with just ``columns``, whatever characters their names have."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage
    and survives the loss of executors."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def train_rows(doc_id: str, folds: int, held: int):
    """Whether a row may be learnt from: crc32 of the id as text, modulo
    ``folds``, is not ``held``.  A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds != held


def class_weights(marked: DataFrame, label: str, sample: int) -> dict[int, float]:
    """What a row counts for in a fit that takes at most ``sample`` rows of each
    class of ``marked``: the sample then has the class shares of the whole table,
    and as much weight as it has rows (1 each where every row is taken)."""
    n = {r[label]: r["count"] for r in marked.groupBy(label).count().collect()}      # one row a class
    taken = {y: min(k, sample) for y, k in n.items()}
    share = sum(taken.values()) / max(1, sum(n.values()))
    return {y: k / taken[y] * share for y, k in n.items()}


ROWS_AT_ONCE = 1000       # of texts handed to Python: bounds what a task holds beside its own work


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands rows to Python ROWS_AT_ONCE at a time."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
    return df


def map_texts(df: DataFrame, keep: list[str], text: str, out: T.StructType,
              make: Callable[[], Callable[[list[str]], list[list]]]) -> DataFrame:
    """Keep the columns ``keep`` and add the columns of ``out``, computed from
    the whole text of each row (null counts as empty).

    ``make`` runs once for each task and returns a function from a list of texts
    to the list of output columns.  Texts reach Python in Arrow batches.
    """
    src = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)],
                    F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))      # plain names for the way to Python
    names = [*keep, *[f.name for f in out.fields]]
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(f.dataType) for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                work = work or make()
                cols = work(part.column(part.num_columns - 1).to_pylist())
                new = [pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], names=names)

    given = [T.StructField(c, f.dataType, f.nullable) for c, f in zip(keep, src.schema.fields)]
    schema = T.StructType(given + list(out.fields))
    return in_small_batches(src).mapInArrow(run, schema)
