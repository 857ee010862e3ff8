"""Centroid clustering by equal-average equal-variance nearest-neighbour search.

Vectors are integers (floor of SCALE times each component).  The centroids are
sorted by component mean.  A vector's search starts at the centroids next to its
own mean and goes outward, the nearer mean first.  With the difference of the
means m and of the deviations s from them (the lengths of the vectors less their
means), the squared distance is at least ``size * m**2 + s**2``: once the mean term
alone is above the best distance so far the search of that vector ends, and a
centroid whose whole bound is above it is rejected.  What remains gets its exact
squared distance in integers; ties go to the smaller number.

Each round is one pass: tasks assign their vectors and hand on one sum for each
centroid and component; Spark adds these, and at most ``k * (size + 1)`` numbers
reach the driver, which floors the means exactly.  Centroids without vectors
stay.  The vectors are written once to the shared folder and never shuffled.

Defined cases: vectors that are null, of another length, or hold a null or
non-finite component take no part; rows without an id are assigned, but start no
centroid; repeated rows are vectors each, and rows equal in id start in the order
of their components; fewer than ``k`` vectors give so many centroids; an empty
table gives an empty result; components beyond 2**62 in size count as that;
distances and sums of them beyond 64 bits are cut to that range in the result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written

K = 40
ROUNDS = 5
SIZE = 64
SCALE = 256
SEED = 2
CHUNK = 4096                # vectors searched together
LONGEST = 2 ** 63 - 1
DECIMAL = T.DecimalType(38, 0)


def quantised(df: DataFrame, vec_id: str, vector: str, size: int, scale: int) -> DataFrame:
    """(id, v): the usable vectors with components floor(scale * x)."""
    narrow = df.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    far = float(2 ** 62)
    return narrow.where((F.size("v") == size) & fine).select(
        "id", F.transform("v", lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(-far)), F.lit(far)))).alias("v"))


class Centroids:
    """Centroids in the order of their means, and the search among them."""

    def __init__(self, vectors: list[list[int]]):
        self.size = len(vectors[0]) if vectors else 0
        self.number = np.array(sorted(range(len(vectors)), key=lambda i: (sum(vectors[i]), i)), np.int64)
        self.exact = [vectors[i] for i in self.number]
        self.largest = max((abs(x) for v in vectors for x in v), default=0)

    def kind(self, x: np.ndarray):
        """64 bits where every square of a sum of differences fits them, else
        integers of any length."""
        most = max(self.largest, int(x.max(initial=0)), -int(x.min(initial=0)))
        return np.int64 if (2 * self.size * most) ** 2 < 2 ** 61 else object

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of each row's nearest centroid, and how many
        distances were computed."""
        kind = self.kind(x)
        x, c = x.astype(kind), np.array(self.exact, dtype=kind)
        total, c_total = x.sum(axis=1), c.sum(axis=1)
        k, n, computed = len(c), self.size, 0
        if kind is np.int64:
            spread, c_spread = (np.sqrt((n * (a * a).sum(axis=1) - t * t) / n) for a, t in ((x, total), (c, c_total)))
        best = np.full(len(x), -1, kind)                                # none yet
        number = np.full(len(x), -1, np.int64)
        high = np.searchsorted(c_total, total)
        low = high - 1
        rows = np.arange(len(x))
        while len(rows):
            lo, hi, t = low[rows], high[rows], total[rows]
            left, right = t - c_total[np.maximum(lo, 0)], c_total[np.minimum(hi, k - 1)] - t
            down = (hi >= k) | (lo >= 0) & (left <= right)
            gap = np.where(down, left, right)
            at = np.where(down, lo, hi)
            first = number[rows] < 0
            live = first | (gap * gap <= n * best[rows])                # else all further means are as far
            rows, gap, at, down, first = rows[live], gap[live], at[live], down[live], first[live]
            low[rows[down]] -= 1
            high[rows[~down]] += 1
            if kind is np.int64:
                bound = gap * gap / n + (spread[rows] - c_spread[at]) ** 2
                test = first | (bound * (1 - 1e-9) - 1 <= best[rows])
            else:
                test = np.ones(len(rows), bool)
            r, a = rows[test], at[test]
            apart = x[r] - c[a]
            d, own = (apart * apart).sum(axis=1), self.number[a]
            computed += len(r)
            better = (number[r] < 0) | (d < best[r]) | (d == best[r]) & (own < number[r])
            best[r[better]], number[r[better]] = d[better], own[better]
            rows = rows[(low[rows] >= 0) | (high[rows] < k)]
        return number, best, computed


def matrices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, matrix) of the vectors of batches of (id, v), CHUNK rows at a time."""
    for b in batches:
        for at in range(0, b.num_rows, CHUNK):
            part = b.slice(at, CHUNK)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, size)


def sums(vectors: DataFrame, centroids: list[list[int]]) -> dict[tuple[int, int], int]:
    """One pass: {(centroid, component): sum over its vectors}; component ``size`` counts them."""
    size = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        own = np.zeros((len(centroids), size + 1), object)
        for _, x in matrices(batches, size):
            number, _, _ = search.nearest(x)
            wide = x if search.kind(x) is np.int64 else x.astype(object)
            for c in np.unique(number):
                mine = wide[number == c]
                own[c, :size] += mine.sum(axis=0).astype(object)
                own[c, size] += len(mine)
        c, j = np.nonzero(own)
        values = pa.array([Decimal(int(x)) for x in own[c, j]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(j.astype(np.int32)), values], names=["c", "j", "s"])

    schema = T.StructType([T.StructField("c", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("s", DECIMAL)])
    added = vectors.mapInArrow(run, schema).groupBy("c", "j").agg(F.sum("s").alias("s"))
    return {(r.c, r.j): int(r.s) for r in added.collect()}               # at most k * (size + 1) rows


def moved(centroids: list[list[int]], found: dict[tuple[int, int], int]) -> list[list[int]]:
    """The floored means of the centroids' vectors; a centroid without vectors stays."""
    size = len(centroids[0])
    return [[found.get((c, j), 0) // n for j in range(size)] if (n := found.get((c, size), 0)) else v
            for c, v in enumerate(centroids)]


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(id, cluster, distance)."""
    size = len(centroids[0]) if centroids else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        for ids, x in matrices(batches, size):
            number, best, _ = search.nearest(x)
            cut = pa.array(np.minimum(best, LONGEST).astype(np.int64))
            yield pa.RecordBatch.from_arrays([ids, pa.array(number.astype(np.int32)), cut], names=["id", "cluster", "distance"])

    schema = T.StructType([vectors.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    return vectors.mapInArrow(run, schema)


def cluster(spark: SparkSession, df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
            size: int = SIZE, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), a row for each usable vector."""
    vectors = written(spark, quantised(df, vec_id, vector, size, scale), "clustering-vectors")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.where("id is not null").orderBy(drawn, "v").limit(k)
    centroids = [list(r.v) for r in first.collect()]                     # k rows
    for _ in range(rounds if centroids else 0):
        centroids = moved(centroids, sums(vectors, centroids))
    placed = written(spark, assigned(vectors, centroids) if centroids else vectors.limit(0).select(
        "id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), "clustering-assigned")
    by_cluster = {r.cluster: int(r.s) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast(DECIMAL)).alias("s")).collect()}
    whole = min(sum(by_cluster.values()), LONGEST)
    facts = [(c, min(s, LONGEST), whole, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
             for c, s in sorted(by_cluster.items())]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(known), "cluster").select(            # k rows
        F.col("id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_eenns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark, table(spark, sf_dir, "embeddings"))


def clustering_sql(k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED) -> str:
    """The same clustering in DuckDB SQL, every distance computed."""
    def assign(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (
          SELECT p.r, any_value(p.v) AS v, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(p.v, c.v),
                 lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), c := c.c)) AS best
          FROM kept p CROSS JOIN c{r} c GROUP BY p.r)"""

    def move(r: int) -> str:
        return f"""m{r} AS (
          SELECT best.c AS c, i, CAST(sum(v[i]) AS HUGEINT) AS s, count(*) AS n FROM a{r}, range(1, {size + 1}) t(i) GROUP BY best.c, i),
        c{r + 1} AS MATERIALIZED (
          SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM m{r} GROUP BY c
          UNION ALL SELECT c, v FROM c{r} WHERE c NOT IN (SELECT best.c FROM a{r}))"""

    steps = [x for r in range(rounds) for x in (assign(r), move(r))] + [assign(rounds)]
    return f"""
    WITH kept AS MATERIALIZED (
      SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    c0 AS MATERIALIZED (
      SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS c, v
      FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k})),
    {", ".join(steps)}
    SELECT vec_id, best.c AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
           CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM a{rounds} a JOIN kept USING (r) JOIN c{rounds} c ON c.c = a.best.c"""


OP11_SQL = clustering_sql()
