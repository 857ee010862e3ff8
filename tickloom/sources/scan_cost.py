"""What a query would read, before it runs: the files its plan has left after partition pruning, and of these the
bytes of the columns it needs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COST = "path string, file_bytes bigint, column_bytes bigint"


class ScanOverBudget(RuntimeError):
    """A query would read more than its budget."""


def column_bytes(path: str, columns: list[str]) -> tuple[int, int]:
    """(size of the file, stored bytes of ``columns`` in it), from the footer alone.  A column that the file
    lacks (a partition column, say) has no bytes; a nested one counts with all its parts."""
    where, name = fs.FileSystem.from_uri(path)
    wanted = {c.lower() for c in columns}
    with where.open_input_file(name) as f:
        meta = pq.ParquetFile(f).metadata
        groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
        chunks = [g.column(j) for g in groups for j in range(meta.num_columns)]
        return f.size(), sum(c.total_compressed_size for c in chunks if c.path_in_schema.split(".")[0].lower() in wanted)


def scan_cost(scan: DataFrame, columns: list[str]) -> DataFrame:
    """(path, file_bytes, column_bytes) of each parquet file that ``scan`` would read for ``columns``: ``scan`` is a table
    with filters on its partition columns, and the files are those that pruning has left.  Their names come
    from a scan without columns and their footers are read by tasks, so no data is read and nothing is listed at
    the driver.  A file without rows costs nothing; without files: no rows."""
    files = scan.select(F.col("_metadata.file_path").alias("path")).distinct()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(p, *column_bytes(p, columns)) for p in b["path"]]
            yield pd.DataFrame(found, columns=["path", "file_bytes", "column_bytes"])

    return files.mapInPandas(read, COST)


def within_budget(scan: DataFrame, columns: list[str], most_bytes: int) -> DataFrame:
    """``scan`` with just ``columns``, refused (``ScanOverBudget``) if these would read more than ``most_bytes``."""
    total = scan_cost(scan, columns).agg(F.coalesce(F.sum("column_bytes"), F.lit(0))).first()[0]
    if total > most_bytes:
        raise ScanOverBudget(f"the scan would read {total} bytes, {total - most_bytes} over its budget of {most_bytes}")
    return scan.select(*columns)
