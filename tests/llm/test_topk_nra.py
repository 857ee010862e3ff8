import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import topk_nra as tk


def brute(rows, k, every):
    usable = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in usable:
        if i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, v in queries.items():
        scored = sorted((-min(max(sum(a * b for a, b in zip(v, w)), -2 ** 63), 2 ** 63 - 1), i) for i, w in usable if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=20, every=20):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, id int")
    return sorted(map(tuple, tk.top_k(spark, df, F.col("id") % every == 0, k=k).collect()))


def f32(v):
    return [float(np.float32(x)) for x in v]


@pytest.mark.parametrize("seed", [0, 1])
def test_against_brute_force(spark, seed, monkeypatch):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(size=(4, 12))
    rows = [(int(i), f32(centre[i % 4] + 0.3 * rnd.normal(size=12))) for i in rnd.permutation(700)]
    rows += rows[:30] + [(40, f32(rnd.normal(size=12)))]          # repeated rows, one id with two vectors
    assert run(spark, rows, 5, 10) == brute(rows, 5, 10)


def test_ties_short_lists_and_unusable_vectors(spark):
    rows = [(0, [1.0, 0.0]), (3, [0.5, 0.5]), (2, [0.5, 0.25]), (1, [0.5, -9.0]), (20, [1.0, 0.0]), (21, None), (22, [None, 1.0]),
            (23, [float("nan"), 1.0]), (24, [float("inf"), 1.0]), (None, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (41, [0.1, 0.2, 0.3]),
            (60, []), (61, []), (80, [-1.5, 0.01]), (100, [3e17, 1.0]), (101, [3e17, -1.0])]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows) == brute(rows, 20, 20)
    assert run(spark, []) == []


def test_blocks_and_chunks_do_not_change_the_result(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    rows = [(i, f32(rnd.normal(size=8))) for i in range(900)]
    monkeypatch.setattr(tk, "BLOCK_VALUES", 160)
    monkeypatch.setattr(tk, "CHUNK", 64)
    assert run(spark, rows, 7, 10) == brute(rows, 7, 10)


def test_bounds_hold_at_every_depth():
    rnd = np.random.default_rng(4)
    x, q = rnd.integers(-30, 30, (300, 10)).astype(float), rnd.integers(-30, 30, (20, 10)).astype(float)
    signs, exact = np.hstack((np.maximum(q, 0), np.minimum(q, 0))), q @ x.T
    lists = tk.Lists(np.arange(300), x)
    for depth in (0.01, 0.3, 0.8, 1.0):
        best, worst = lists.read(depth)
        assert (signs @ worst.T <= exact).all() and (exact <= signs @ best.T).all()
    assert (signs @ worst.T == exact).all()


def test_pruning_leaves_few_pairs_to_resolve():
    rnd = np.random.default_rng(5)
    x = rnd.integers(-20, 20, (4096, 64)).astype(float)
    s = tk.Search(np.arange(100), x[:100].astype(np.int64), 20)
    live = np.ones((100, 4096), bool)
    s.bound(x[:100], tk.Lists(np.arange(4096), x), live, np.full(100, -np.inf), {})
    assert live.mean() < 0.25
