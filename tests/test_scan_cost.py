import glob
import os

import pyarrow.parquet as pq
import pytest

from tickloom.session import scratch_path
from tickloom.sources import scan_cost as sc


@pytest.fixture(scope="module")
def table(spark):
    path = scratch_path(spark, "t_scan")
    df = spark.range(6000).selectExpr("id % 6 AS day", "id AS a", "repeat(cast(id AS string), 20) AS wide", "struct(id AS x, id * 2 AS y) AS pair")
    df.repartition(2).write.partitionBy("day").parquet(path)
    return path


def bytes_of(files, roots):
    total = 0
    for f in files:
        m = pq.ParquetFile(f).metadata
        total += sum(m.row_group(g).column(c).total_compressed_size for g in range(m.num_row_groups) for c in range(m.num_columns)
                     if m.row_group(g).column(c).path_in_schema.split(".")[0] in roots)
    return total


def test_pruned_files_and_columns_only(spark, table):
    scan = spark.read.parquet(table).where("day BETWEEN 1 AND 2")
    files = glob.glob(f"{table}/day=1/*.parquet") + glob.glob(f"{table}/day=2/*.parquet")
    got = sc.scan_cost(scan, ["day", "A", "pair"]).collect()
    assert len(got) == len(files)
    assert sum(r["file_bytes"] for r in got) == sum(os.path.getsize(f) for f in files)
    assert sum(r["column_bytes"] for r in got) == bytes_of(files, {"a", "pair"})


def test_a_scan_over_budget_is_refused(spark, table):
    scan = spark.read.parquet(table).where("day = 3")
    need = bytes_of(glob.glob(f"{table}/day=3/*.parquet"), {"wide"})
    assert sc.within_budget(scan, ["wide"], need).count() == 1000
    with pytest.raises(sc.ScanOverBudget, match=f"{need} bytes, 1 over"):
        sc.within_budget(scan, ["wide"], need - 1)


def test_nothing_left_costs_nothing(spark, table):
    none = spark.read.parquet(table).where("day = 99")
    assert sc.scan_cost(none, ["a"]).collect() == []
    assert sc.within_budget(none, ["a"], 0).count() == 0
