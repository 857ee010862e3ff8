"""Exact top-k inner products by no-random-access aggregation.

Each component gives one list of the candidates, sorted by what the component
adds to the score: by its value, from the top for queries whose own component is
positive and from the bottom for negative ones.  All lists are read in step.
After each reading a pair has an upper bound (what was read, and for lists not
yet reached the value last read there) and a lower bound (what was read, and the
least value of the other lists).  The k-th best lower bound of a query, or the
k-th best score it already has, is its threshold; pairs whose upper bound is
below it are out.  Reading stops when few pairs can still qualify, and these
are resolved to final scores.  Ties at the threshold are never dropped.

A task reads its candidates in chunks and carries the best k of each query from
chunk to chunk; the tasks' results are merged by a shuffle on the query.  The
queries are a stated share of the rows, so they grow with the table: they are
broadcast in blocks of at most BLOCK_VALUES components (8 MB), one pass over the
candidates for each block.

Defined cases: vectors that are null or hold a null or non-finite component take
no part, nor do rows without an id; vectors are compared with vectors of the
same length only; a row is no candidate for queries with its own id; repeated
rows are candidates each, while a repeated query id counts once (with the
smallest of its vectors); ties go to the smaller id; an empty table gives an
empty result; scores beyond
64 bits are cut to that range before ranking; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

K = 20
EVERY = 20
SCALE = 64
BLOCK_VALUES = 1 << 20              # components of the queries broadcast at once
CHUNK = 4096                        # candidates whose lists are read together
QUERIES_AT_ONCE = 512
DEPTHS = (0.25, 0.5, 0.7, 0.85)     # of a list, read before bounds are compared
FEW = 0.02                          # of the pairs: resolved without further reading


def quantised(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v): the usable vectors with components floor(SCALE * x)."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (df.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).where(fine)
            .select(F.col(vec_id).alias("id"), F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)).alias("v")))


class Lists:
    """The sorted lists of a chunk of candidates."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.sorted = np.sort(x, axis=0)

    def read(self, depth: float) -> tuple[np.ndarray, np.ndarray]:
        """What is known of each candidate for queries with positive and with
        negative components, after reading ``depth`` of every list from either
        end: (best, worst), each with the columns of both kinds side by side.
        An entry not read counts as the value last read, or the list's last."""
        n = len(self.x)
        t = max(1, min(n, int(np.ceil(depth * n))))
        high, low = self.sorted[n - t], self.sorted[t - 1]
        top, bottom = self.sorted[-1], self.sorted[0]
        best = np.hstack((np.maximum(self.x, high), np.minimum(self.x, low)))
        worst = np.hstack((np.where(self.x >= high, self.x, bottom), np.where(self.x <= low, self.x, top)))
        return best, worst


def resolve(q: np.ndarray, x: np.ndarray, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """Final scores of the pairs (qi, ci)."""
    out = np.zeros(len(qi), q.dtype)
    for at in range(0, len(qi), 1 << 16):
        s = slice(at, at + (1 << 16))
        out[s] = (q[qi[s]] * x[ci[s]]).sum(axis=1)
    return out


def best_of(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best rows of each owner: high score, then small id."""
    order = np.lexsort((ids, -score, owner))
    first = np.concatenate(([True], owner[order][1:] != owner[order][:-1])) if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < k]


def number_type(q: np.ndarray, x: np.ndarray):
    """The narrowest type in which every sum of products is exact."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1]) * 2
    return np.float32 if bound < 2 ** 24 else np.float64 if bound < 2 ** 53 else object


class Search:
    """The best k candidates so far of each query of a block (equal lengths)."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        order = np.argsort(ids)
        self.ids, self.q, self.k = ids[order], q[order], k
        self.owner = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.found = np.zeros(0, np.int64)

    def threshold(self) -> np.ndarray:
        """The k-th best score of each query, or minus infinity."""
        out = np.full(len(self.q), -np.inf)
        n = np.bincount(self.owner, minlength=len(self.q))
        least = np.full(len(self.q), np.inf)
        np.minimum.at(least, self.owner, self.score.astype(float))
        return np.where(n >= self.k, least, out)

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Search a chunk of candidates."""
        kind = number_type(self.q, x)
        lists, limit = Lists(ids, x.astype(kind)), self.threshold()
        readings: dict[float, tuple[np.ndarray, np.ndarray]] = {}
        at = np.searchsorted(self.ids, ids)
        own_c = np.flatnonzero(self.ids[np.minimum(at, len(self.ids) - 1)] == ids)
        own_q = at[own_c]
        for start in range(0, len(self.q), QUERIES_AT_ONCE):
            stop = min(start + QUERIES_AT_ONCE, len(self.q))
            q = self.q[start:stop].astype(kind)
            mine = (own_q >= start) & (own_q < stop)
            live = np.ones((len(q), len(ids)), bool)
            live[own_q[mine] - start, own_c[mine]] = False
            if kind is not object:
                self.bound(q, lists, live, limit[start:stop], readings)
            qi, ci = np.nonzero(live)
            score = resolve(q, lists.x, qi, ci)
            if kind is object:
                score = np.array([min(max(s, -2 ** 63), 2 ** 63 - 1) for s in score], object)
            owner = np.concatenate((self.owner, qi + start))
            score = np.concatenate((self.score, score.astype(np.int64)))
            found = np.concatenate((self.found, ids[ci]))
            keep = best_of(owner, score, found, self.k)
            self.owner, self.score, self.found = owner[keep], score[keep], found[keep]

    def bound(self, q, lists, live, limit, readings) -> None:
        """Read the lists of a chunk until few pairs of ``live`` can qualify."""
        signs = np.hstack((np.maximum(q, 0), np.minimum(q, 0)))
        for depth in DEPTHS:
            if depth not in readings:
                readings[depth] = lists.read(depth)
            best, worst = readings[depth]
            if live.shape[1] >= self.k:
                lower = np.where(live, signs @ worst.T, -np.inf)
                limit = np.maximum(limit, np.partition(lower, -self.k, axis=1)[:, -self.k])
            live &= signs @ best.T >= limit[:, None]
            if live.mean() <= FEW:
                return


def vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for each length of vector in a batch of (id, v)."""
    ids, col = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    size = np.diff(col.offsets.to_numpy())
    flat, start = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()[:-1]
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        yield ids[rows], flat[start[rows][:, None] + np.arange(n)[None, :]].reshape(len(rows), n)


def search_block(spark: SparkSession, candidates: DataFrame, queries: list, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best k of each task for a block of queries."""
    by_size: dict[int, list] = {}
    for r in queries:
        by_size.setdefault(len(r.v), []).append(r)
    block = {n: (np.array([r.id for r in rows], np.int64), np.array([r.v for r in rows], np.int64).reshape(len(rows), n))
             for n, rows in by_size.items()}
    shared = spark.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = {n: Search(ids, q, k) for n, (ids, q) in shared.value.items()}
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                for ids, x in vectors(b.slice(at, CHUNK)):
                    if x.shape[1] in searches:
                        searches[x.shape[1]].add(ids, x)
        for s in searches.values():
            yield pa.RecordBatch.from_arrays([pa.array(s.ids[s.owner]), pa.array(s.found), pa.array(s.score)],
                                             names=["query_id", "vec_id", "score"])

    return candidates.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(spark: SparkSession, df: DataFrame, is_query, vec_id: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates among all rows of
    ``df`` for each row where the column ``is_query`` (over ``id``) holds."""
    rows = written(spark, quantised(df, vec_id, vector), "topk-vectors")
    queries = written(spark, rows.where(is_query).groupBy("id").agg(F.min("v").alias("v")), "topk-queries")
    n, longest = queries.agg(F.count("*"), F.max(F.size("v"))).first()
    blocks = max(1, -(-n * max(1, longest or 1) // BLOCK_VALUES))
    parts = []
    for b in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        parts.append(search_block(spark, rows, own, k))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op4_topk_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark, table(spark, sf_dir, "embeddings"), F.col("id") % EVERY == 0)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), ranked AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pair
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
