"""H4: minority oversampling by interpolation between neighbours, to equal classes.

Within each key every class smaller than the largest one gets synthetic rows:
a row of the class, moved some way towards one of its ``k`` nearest neighbours of
the same class.  Which rows are drawn (all equally often, up to one), which
neighbour, and how far, come from md5 of (seed, key, class, date, copy), so the
rows do not depend on partitioning.

The neighbours are exact.  Only drawn rows search.  The rows of a class are sorted by
the sum of their features and cut into blocks; a block's drawn rows search their own
block first.  Two rows whose sums differ by s are at least s / sqrt(features) apart,
so a block then meets only the blocks whose sums lie within its farthest k-th
neighbour, and carries its best k from block to block.

Defined cases: rows with a null or NaN feature, key or class take no part; a class of one row is
repeated as it is; with fewer than ``k`` others all of them are neighbours; ties in
distance (to 9 digits) go to the earlier date; a key with one class gets nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path

BLOCK = 2048          # rows of a class whose distances are computed together


def _draw(*parts: Column | str | int) -> Column:
    """52 bits of an md5 of the parts, the same in any engine."""
    text = F.concat_ws(":", *[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def _nearest(q: np.ndarray, own: np.ndarray, c: np.ndarray, c_day: np.ndarray, c_row: np.ndarray, k: int):
    """Positions and rounded squared distances of the k nearest of ``c`` for each of ``q``, itself left out."""
    for at in range(0, len(q), 64):
        d = np.round(((q[at:at + 64, None, :] - c[None]) ** 2).sum(axis=2), 9)
        d[c_row[None, :] == own[at:at + 64, None]] = np.inf
        for i, row in enumerate(d):
            best = np.lexsort((c_row, c_day, row))[:k]
            yield at + i, best[np.isfinite(row[best])], row


def neighbours(spark: SparkSession, rows: DataFrame, keys: list[str], k: int, size: int) -> DataFrame:
    """(keys, row, rank, near_day, near_x) of the drawn rows of (keys, row, day, total, drawn, x)."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("total", "day", "row"))
    blocks = rows.withColumn("block", F.floor((place - 1) / BLOCK)).groupBy(*keys, "block").agg(
        F.min("total").alias("low"), F.max("total").alias("high"),
        F.collect_list(F.struct("row", "day", "drawn", "x")).alias("held"))                  # at most BLOCK
    path = scratch_path(spark, "oversample-blocks")
    blocks.write.parquet(path)
    blocks = spark.read.schema(blocks.schema).parquet(path)
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema.fields}
    key_schema = ", ".join(f"`{c}` {kinds[c]}" for c in keys)
    found = f"{key_schema}, block long, reach double, row long, far double, near_day date, near_row long, near_x array<double>"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                q = [x for x in r["asking"] if x["drawn"] > 0]
                if not q:
                    continue
                c = r["held"]
                at = [np.array([x["x"] for x in part], float).reshape(len(part), size) for part in (q, c)]
                day, row = np.array([x["day"].toordinal() for x in c]), np.array([x["row"] for x in c])
                best = list(_nearest(at[0], np.array([x["row"] for x in q]), at[1], day, row, k))
                reach = max((float(d[near[k - 1]]) if len(near) >= k else math.inf) for _, near, d in best)
                for i, near, d in best:
                    out += [(*(r[key] for key in keys), r["block"], reach, q[i]["row"], float(d[j]), c[j]["day"], c[j]["row"], c[j]["x"]) for j in near]
            names = [*keys, "block", "reach", "row", "far", "near_day", "near_row", "near_x"]
            yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(StructType.fromDDL(found))
    own = blocks.select(*keys, "block", F.col("held").alias("asking"), "held").mapInArrow(search, found)
    path = scratch_path(spark, "oversample-own")
    own.write.parquet(path)
    own = spark.read.parquet(path)
    # A block whose drawn rows have fewer than k neighbours in it has no reach yet: it meets every other block of its class.
    many = blocks.groupBy(*keys).agg(F.max("block").alias("last")).where("last > 0")
    reach = own.groupBy(*keys, "block").agg(F.max("reach").alias("reach"))
    asking = blocks.join(many, keys).join(reach, [*keys, "block"], "left").select(
        *keys, "block", "low", "high", F.sqrt(F.coalesce("reach", F.lit(math.inf)) * size).alias("wide"), F.col("held").alias("asking"))
    others = blocks.select(*keys, F.col("block").alias("other"), F.col("low").alias("o_low"), F.col("high").alias("o_high"), "held")
    pairs = asking.join(others, keys).where("other <> block AND o_low <= high + wide + 1e-6 AND o_high >= low - wide - 1e-6")
    every = own.unionByName(pairs.select(*keys, "block", "asking", "held").mapInArrow(search, found))
    rank = F.row_number().over(Window.partitionBy(*keys, "row").orderBy("far", "near_day", "near_row"))     # k for each block met
    return every.select(*keys, "row", rank.alias("rank"), "near_day", "near_x").where(F.col("rank") <= k)


def oversample(spark: SparkSession, df: DataFrame, cols: list[str], label: str = "target_direction", keys=("symbol",), day: str = "date",
               k: int = 5, seed: int = 42) -> DataFrame:
    """The synthetic rows: (keys, label, day, copy, neighbour_day, u, cols)."""
    group = [*keys, label]
    x = F.array(*[F.col(c).cast("double") for c in cols])
    rows = df.dropna(subset=group).withColumn("_x", x).where(F.forall("_x", lambda v: v.isNotNull() & ~F.isnan(v)))
    rows = rows.select(*group, F.col(day).alias("day"), F.col("_x").alias("x"), F.aggregate("_x", F.lit(0.0), lambda a, v: a + v).alias("total"))
    n = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    lack = n.join(n.groupBy(*keys).agg(F.max("n").alias("most")), list(keys)).select(*group, "n", (F.col("most") - F.col("n")).alias("lack")).where("lack > 0")
    order = Window.partitionBy(*group).orderBy(_draw(seed, *[F.col(c) for c in group], F.col("day")), "day", "total")
    rows = rows.join(lack, group).withColumn("row", F.row_number().over(order).cast("long"))
    rows = rows.withColumn("drawn", F.floor(F.col("lack") / F.col("n")) + F.when(F.col("row") <= F.col("lack") % F.col("n"), 1).otherwise(0))
    path = scratch_path(spark, "oversample-rows")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)

    near = neighbours(spark, rows.select(*group, "row", "day", "total", "drawn", "x"), group, k, len(cols))
    copies = rows.where("drawn > 0").select(*group, "row", "day", "x", "n", F.explode(F.sequence(F.lit(1), F.col("drawn").cast("int"))).alias("copy"))
    key = [seed, *[F.col(c) for c in group], F.col("day"), F.col("copy")]
    copies = copies.withColumns({"rank": (_draw(*key, "n") % F.greatest(F.least(F.lit(k), F.col("n") - 1), F.lit(1)) + 1).cast("int"),
                                 "u": (_draw(*key, "u").cast("double") + 0.5) / float(1 << 52)})
    both = copies.join(near, [*group, "row", "rank"], "left").withColumn("near_x", F.coalesce("near_x", "x"))
    return both.select(*group, F.col("day").alias(day), "copy", F.coalesce("near_day", "day").alias("neighbour_day"), "u",
                       *[(F.col("x")[i] + F.col("u") * (F.col("near_x")[i] - F.col("x")[i])).alias(c) for i, c in enumerate(cols)])
