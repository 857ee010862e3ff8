"""Attributions of tree ensembles: exact path-dependent Shapley values.

A stored ensemble is a table of nodes; a leaf's path is the interval of values that
each of its features may have, and the share of the fitted rows that take the path's
turns on that feature (its cover).  With some features of a path known and the others
not, the path is taken with probability: the known ones decide by their value, the
others by their cover.  A feature's value is its mean effect over all orders in which
features become known, summed over paths.

What a path gives depends on a row only through which of its features fit the path:
with d features there are 2**d cases, worked out once for each path (d is at most the
depth of the trees).  Rows are then looked up, in Arrow batches; the table of paths is
bounded by the model, not by the rows.

The values of a row and the base value (the score of a row of which nothing is known)
add up to the row's score.  Null and NaN features take left turns, as the booster's do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A node table: tree, node, feature (null at leaves), threshold, left, right, value, cover.
NODES = ["tree", "node", "feature", "threshold", "left", "right", "value", "cover"]


def booster_nodes(model: DataFrame) -> DataFrame:
    """The node table of a stored booster; values are parts of the log odds."""
    inner = F.col("feature").isNotNull()
    return model.select("tree", "node", "feature", "threshold", F.when(inner, F.col("node") * 2).alias("left"),
                        F.when(inner, F.col("node") * 2 + 1).alias("right"), "value", "cover")


def forest_nodes(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """The node table of a stored forest pipeline; values are each tree's share of P(up)."""
    stage = f"{path}/stages/1_*/data"
    data = spark.read.parquet(stage).select("treeID", "nodeData.*")
    stats = F.col("impurityStats")
    cover = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    trees = data.select(F.countDistinct("treeID")).scalar()
    names = F.array(*[F.lit(c) for c in cols])
    inner = F.col("leftChild") >= 0
    return data.select(F.col("treeID").alias("tree"), F.col("id").alias("node"), F.when(inner, F.element_at(names, F.col("split.featureIndex") + 1)).alias("feature"),
                       F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"), F.when(inner, F.col("leftChild")).alias("left"),
                       F.when(inner, F.col("rightChild")).alias("right"), (stats[1] / cover / trees).alias("value"), cover.alias("cover"))


def cases(cover: list[float], value: float) -> np.ndarray:
    """(2**d, d): what each feature of a path with the given covers adds, by the set of features (bits) that fit the path."""
    d = len(cover)
    out = np.zeros((1 << d, d))
    weight = [math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)]
    fits = (np.arange(1 << d)[:, None] >> np.arange(d)) & 1
    for i in range(d):
        known = np.zeros((1 << d, d))                                    # by how many of the others are known
        known[:, 0] = 1
        for j in range(d):
            if j != i:
                known[:, 1:] = known[:, 1:] * cover[j] + known[:, :-1] * fits[:, j, None]
                known[:, 0] *= cover[j]
        out[:, i] = value * (known @ weight) * (fits[:, i] - cover[i])
    return out


def paths(nodes: DataFrame, cols: list[str]) -> tuple[list[tuple], float]:
    """(features, from (exclusive), to (inclusive), cases) of every path that ends in a leaf, and the base value."""
    found, base = [], 0.0
    by_tree: dict[int, dict[int, tuple]] = {}
    for r in nodes.select(*NODES).collect():                             # bounded by the model
        by_tree.setdefault(r.tree, {})[r.node] = r
    place = {c: i for i, c in enumerate(cols)}
    for tree in by_tree.values():
        root = min(tree)
        todo = [(root, {}, 1.0)]
        while todo:
            at, held, share = todo.pop()
            n = tree[at]
            if n.feature is None:
                base += n.value * share
                if held:
                    features = sorted(held)
                    low, high, cover = zip(*(held[f] for f in features))
                    found.append((np.array(features), np.array(low), np.array(high), cases(list(cover), n.value)))
                continue
            f = place[n.feature]
            low, high, z = held.get(f, (-math.inf, math.inf, 1.0))
            for child, interval in ((n.left, (low, min(high, n.threshold))), (n.right, (max(low, n.threshold), high))):
                part = tree[child].cover / n.cover if n.cover else 0.5
                todo.append((child, {**held, f: (*interval, z * part)}, share * part))
    return found, base


def attributions(nodes: DataFrame, df: DataFrame, cols: list[str], out: str = "attributions") -> DataFrame:
    """``df`` with ``base_value`` and the array ``out``: what each of ``cols`` adds to the row's score."""
    shared = df.sparkSession.sparkContext.broadcast(paths(nodes, cols))
    names = list(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base = shared.value
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[-len(cols):]])
            x = np.where(np.isnan(x), np.finfo(float).min, x)
            total = np.zeros(x.shape)
            for features, low, high, table in known:
                own = x[:, features]
                case = (((own > low) & (own <= high)) << np.arange(len(features))).sum(axis=1)
                total[:, features] += table[case]
            new = [pa.array(np.full(len(x), base)), pa.array(list(total), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-len(cols)], *new], names=[*names, "base_value", out])

    wide = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(math.nan)).alias(f"_x{i}") for i, c in enumerate(cols)])
    return wide.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("base_value", T.DoubleType()),
                                              T.StructField(out, T.ArrayType(T.DoubleType()))]))


def mean_sizes(attributed: DataFrame, cols: list[str], out: str = "attributions") -> DataFrame:
    """(feature, mean_size, mean_signed) over the rows: the numbers behind a summary of attributions."""
    e = attributed.select(F.posexplode(out).alias("i", "v"))
    by = e.groupBy("i").agg(F.avg(F.abs("v")).alias("mean_size"), F.avg("v").alias("mean_signed"))
    return by.select(F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("i") + 1).alias("feature"), "mean_size", "mean_signed")
