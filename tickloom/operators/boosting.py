"""Boosted trees with second-order gains, from histograms of binned features.

Features are binned once, at the quantiles of the rows fitted.  The binned rows are
held as blocks of bytes; each level of a tree is one pass over them that adds up the
gradients and hessians of the logistic loss by (node, feature, bin), and only these
sums reach the driver, which picks the splits.  Gradients and hessians are integers
(multiples of 1 / UNIT), so the sums, and with them the trees, are the same however
Spark partitions the rows or adds them up.

Where one block could hold all rows (ROWS, some megabytes of bins) the sums of one task
are the whole sums, so that task goes on from level to level by itself.

A task needs the margins of its rows so far.  They follow from the trees and the block
alone, so any executor can work them out again; a Python worker remembers the margins
of the blocks it has seen and only adds the trees that are new to it.

A split sends a row left if its bin is at most the split's, that is if its value is at
most the threshold; null and NaN are in the lowest bin.  The gain is
``GL**2 / (HL + l2) + GR**2 / (HR + l2) - G**2 / (H + l2)``; ties go to the first feature,
then the lowest bin.  A leaf's value is ``-step * G / (H + l2)``.
"""

from __future__ import annotations

import math
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

UNIT = 1 << 24
ROWS = 1 << 16        # of a block; so few rows in all are boosted by one task, which then has all sums at hand
TASK_ROWS = 1 << 20   # that a task adds up where there are more tasks than processors
ACCURACY = 100_000    # of the quantile sketch: ranks are exact to rows / ACCURACY
FLAT = 32             # partitions whose sums go straight to the driver; more are added up in a tree

MODEL = "tree int, node int, feature string, threshold double, value double, gain double, cover double"

# Trees are arrays by tree and node.  Nodes are numbered 1, 2, 3, ...; the children of i are 2i and
# 2i + 1.  Feature -1 marks a leaf.
Trees = tuple[np.ndarray, np.ndarray, np.ndarray]                # feature, bin, value


def bin_edges(df: DataFrame, cols: list[str], bins: int) -> list[list[float]]:
    """For each feature at most ``bins - 1`` quantiles of the rows, ascending and distinct."""
    at = [(i + 1) / bins for i in range(bins - 1)]
    fine = [F.when(F.isnan(F.col(c).cast("double")), None).otherwise(F.col(c).cast("double")) for c in cols]
    found = df.agg(*[F.percentile_approx(f, at, ACCURACY).alias(f"c{i}") for i, f in enumerate(fine)]).first()
    return [sorted(set(x or [])) for x in found]


def bins_of(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """How many edges are below each value; 0 for NaN."""
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(np.array(e), np.where(np.isnan(x[:, j]), -np.inf, x[:, j]), side="left")
    return out


def blocks(spark: SparkSession, df: DataFrame, cols: list[str], label: str, edges: list[list[float]]) -> DataFrame:
    """(block, bins, labels): the binned rows, ROWS at a time, stored once."""
    narrow = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(math.nan)).alias(f"c{i}") for i, c in enumerate(cols)], F.col(label).cast("int").alias("y"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(held):
            t = pa.Table.from_batches(held)
            x = np.column_stack([c.to_numpy() for c in t.columns[:-1]])
            y = t.columns[-1].to_numpy().astype(np.uint8)
            return pa.RecordBatch.from_pydict({"block": [uuid.uuid4().hex], "bins": [bins_of(x, edges).tobytes()], "labels": [y.tobytes()]})
        held, n = [], 0
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                if n + part.num_rows > ROWS:
                    yield row(held)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield row(held)

    path = scratch_path(spark, "boosting-blocks")
    narrow.where("y is not null").mapInArrow(pack, "block string, bins binary, labels binary").write.parquet(path)
    return spark.read.parquet(path)


def walk(feature: np.ndarray, cut: np.ndarray, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node of a tree that each row reaches."""
    node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        f = feature[node]
        right = bins[rows, np.maximum(f, 0)] > cut[node]
        node = np.where(f >= 0, 2 * node + right, node)
    return node


def gradients(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-margin))
    return np.rint((p - y) * UNIT), np.rint(p * (1 - p) * UNIT)


def margins(fit: str, block: str, bins: np.ndarray, trees: Trees, depth: int) -> np.ndarray:
    """Of a block's rows after ``trees``; what this Python worker knows of them is not worked out again."""
    held = vars(sys.modules.setdefault("tickloom_margins", types.ModuleType("tickloom_margins")))
    if held.get("fit") != fit:
        held.update(fit=fit, known={})
    n, margin = held["known"].get(block, (0, np.zeros(len(bins))))
    for feature, cut, value in zip(*(x[n:] for x in trees)):
        margin = margin + value[walk(feature, cut, bins, depth)]
    held["known"][block] = (len(trees[0]), margin)
    return margin


def level_sums(rows: Iterator[tuple], fit: str, n_features: int, n_bins: int, trees: Trees, level: int, depth: int) -> np.ndarray:
    """(2, nodes of the level, features, bins): the gradients and hessians of the rows by the last tree's nodes."""
    first = 1 << level
    size = first * n_features * n_bins
    total = np.zeros((2, size), np.int64)
    done, now = tuple(x[:-1] for x in trees), (trees[0][-1], trees[1][-1])
    for block, bins, labels in rows:
        y = np.frombuffer(labels, np.uint8)
        bins = np.frombuffer(bins, np.uint8).reshape(len(y), n_features)
        node = walk(*now, bins, level) - first
        live = np.flatnonzero(node >= 0)
        at = ((node[live, None] * n_features + np.arange(n_features)) * n_bins + bins[live]).ravel()
        for s, x in enumerate(gradients(margins(fit, block, bins, done, depth), y)):
            total[s] += np.bincount(at, np.repeat(x[live], n_features), size).astype(np.int64)
    return total.reshape(2, first, n_features, n_bins)


def best_splits(total: np.ndarray, l2: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each node of a level: (gain, feature, bin, (G, H)); gain is -inf where no split leaves ``least`` hessian on both sides."""
    g, h = total[0] / UNIT, total[1] / UNIT
    left_g, left_h = (np.cumsum(x, axis=2)[:, :, :-1] / UNIT for x in total)
    sums = np.stack((g[:, 0].sum(axis=1), h[:, 0].sum(axis=1)), 1)
    right_g, right_h = sums[:, 0, None, None] - left_g, sums[:, 1, None, None] - left_h
    gain = left_g ** 2 / (left_h + l2) + right_g ** 2 / (right_h + l2) - (sums[:, 0] ** 2 / (sums[:, 1] + l2))[:, None, None]
    gain[(left_h < least) | (right_h < least)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)                                             # the first of equal ones
    return flat[np.arange(len(flat)), at], at // gain.shape[2], at % gain.shape[2], sums


def boost(sums: Callable[[Trees, int], np.ndarray], rounds: int, depth: int, step: float, l2: float, least: float) -> tuple[np.ndarray, ...]:
    """(feature, bin, value, gain, hessian) by tree and node.  ``sums(trees, level)`` gives the histograms of a level of the last tree."""
    size = 2 << depth
    feature, cut = np.full((rounds, size), -1, np.int16), np.zeros((rounds, size), np.uint8)
    value, gains, cover = (np.zeros((rounds, size)) for _ in range(3))
    for t in range(rounds):
        for level in range(depth):
            total = sums((feature[:t + 1], cut[:t + 1], value[:t + 1]), level)
            gain, best, at, both = best_splits(total, l2, least)
            grew = False
            for i, node in enumerate(range(1 << level, 2 << level)):
                if level == 0 or feature[t, node >> 1] >= 0:
                    value[t, node], cover[t, node] = -step * both[i, 0] / (both[i, 1] + l2), both[i, 1]
                    if gain[i] > 1e-9:
                        feature[t, node], cut[t, node], gains[t, node], grew = best[i], at[i], gain[i], True
                        left = total[:, i, best[i], :at[i] + 1].sum(axis=1) / UNIT
                        for child, (g, h) in ((2 * node, left), (2 * node + 1, both[i] - left)):
                            value[t, child], cover[t, child] = -step * g / (h + l2), h
            if not grew:
                break
    return feature, cut, value, gains, cover


def fit(spark: SparkSession, df: DataFrame, cols: list[str], label: str = "target_direction", rounds: int = 200, depth: int = 6,
        step: float = 0.01, bins: int = 64, l2: float = 1.0, least: float = 1.0) -> DataFrame:
    """The fitted trees as a table (tree, node, feature, threshold, value, gain, cover), a row for each node; of leaves,
    feature is null; cover is the hessian of the rows that reach the node.  ``least`` is the least hessian of a child.  A table without rows gives no trees."""
    edges = bin_edges(df, cols, bins)
    stored = blocks(spark, df, cols, label, edges)
    n, total = stored.select(F.count(F.lit(1)), F.coalesce(F.sum(F.length("labels")), F.lit(0))).first()
    name, n_features = uuid.uuid4().hex, len(cols)
    if total <= ROWS:
        def alone(rows):
            held = list(rows)                                            # at most ROWS rows in all
            yield boost(lambda trees, level: level_sums(held, name, n_features, bins, trees, level, depth), rounds, depth, step, l2, least)
        found = stored.coalesce(1).rdd.map(tuple).mapPartitions(alone).collect()[0] if n else boost(None, 0, depth, step, l2, least)
    else:
        tasks = min(n, max(spark.sparkContext.defaultParallelism, -(-total // TASK_ROWS)))
        held = stored.repartition(tasks).rdd.map(tuple).persist()

        def together(trees, level):
            def run(rows):
                yield level_sums(rows, name, n_features, bins, trees, level, depth)
            sums = held.mapPartitions(run)
            return sum(sums.collect()) if tasks <= FLAT else sums.treeReduce(np.add)
        try:
            found = boost(together, rounds, depth, step, l2, least)
        finally:
            held.unpersist()
    rows = []
    for t, (feature, cut, value, gain, cover) in enumerate(zip(*found)):
        for node in range(1, len(feature)):
            if node == 1 or feature[node >> 1] >= 0:
                f = int(feature[node])
                split = (cols[f], edges[f][cut[node]]) if f >= 0 else (None, None)
                rows.append((t, node, *split, float(value[node]), float(gain[node]), float(cover[node])))
    return spark.createDataFrame(rows, MODEL)


def store(trees: DataFrame, path: str) -> str:
    trees.coalesce(1).write.mode("overwrite").parquet(path)              # at most rounds * 2**(depth + 1) rows
    return path


def arrays(model: DataFrame, cols: list[str]) -> tuple[np.ndarray, ...]:
    """(feature, threshold, value) by tree and node of a stored model."""
    rows = model.collect()                                               # at most rounds * 2**(depth + 1)
    n, size = max((r.tree for r in rows), default=-1) + 1, 2 << max((r.node.bit_length() - 1 for r in rows), default=0)
    feature, threshold, value = np.full((n, size), -1, np.int64), np.zeros((n, size)), np.zeros((n, size))
    place = {c: i for i, c in enumerate(cols)}
    for r in rows:
        value[r.tree, r.node] = r.value
        if r.feature is not None:
            feature[r.tree, r.node], threshold[r.tree, r.node] = place[r.feature], r.threshold
    return feature, threshold, value


def predict(model: DataFrame, df: DataFrame, cols: list[str], threshold: float = 0.5) -> DataFrame:
    """``df`` with p_up and predicted_signal (p_up > threshold), from the stored trees."""
    shared = df.sparkSession.sparkContext.broadcast(arrays(model, cols))     # bounded by rounds and depth

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feature, cut, value = shared.value
        deep = feature.shape[1].bit_length() - 2
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[-len(cols):]])
            x = np.where(np.isnan(x), -np.inf, x)
            rows, margin = np.arange(len(x)), np.zeros(len(x))
            for t in range(len(feature)):
                node = np.ones(len(x), np.int64)
                for _ in range(deep):
                    f = feature[t, node]
                    right = x[rows, np.maximum(f, 0)] > cut[t, node]
                    node = np.where(f >= 0, 2 * node + right, node)
                margin = margin + value[t, node]
            yield pa.RecordBatch.from_arrays([*b.columns[:-len(cols)], pa.array(1 / (1 + np.exp(-margin)))], names=[*names, "p_up"])

    names = list(df.columns)
    wide = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(math.nan)).alias(f"_x{i}") for i, c in enumerate(cols)])
    out = wide.mapInArrow(score, T.StructType([*df.schema.fields, T.StructField("p_up", T.DoubleType())]))
    return out.withColumn("predicted_signal", (F.col("p_up") > threshold).cast("int"))


def importances(model: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, importance): each feature's share of all gain."""
    gain = model.where("feature is not null").groupBy("feature").agg(F.sum("gain").alias("gain"))
    every = model.sparkSession.createDataFrame([(c,) for c in cols], "feature string").join(gain, "feature", "left")
    total = gain.select(F.sum("gain")).scalar()
    return every.select("feature", F.coalesce(F.col("gain") / total, F.lit(0.0)).alias("importance"))
