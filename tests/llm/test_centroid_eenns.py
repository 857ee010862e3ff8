import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import centroid_eenns as ce


def brute(rows, k, rounds, size, scale=256, seed=2):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    final = [(i, *nearest(v)) for i, v in kept]
    inertia = {n: sum(d for _, d, o in final if o == n) for n in range(len(centroids))}
    top = 2 ** 63 - 1
    return sorted(((i, n, min(d, top), min(inertia[n], top), min(sum(inertia.values()), top),
                    hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in final), key=repr)


def run(spark, rows, **given):
    df = spark.createDataFrame([(i, v, 7, 8) for i, v in rows], "vec_id long, embedding array<float>, cluster int, id int")
    return sorted((tuple(r) for r in ce.cluster(spark, df, **given).collect()), key=repr)


def f32(v):
    return [float(np.float32(x)) for x in v]


@pytest.mark.parametrize("seed", [0, 1])
def test_against_brute_force(spark, seed):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(size=(6, 8))
    rows = [(int(i), f32(centre[i % 6] * (1 + i % 3) + 0.4 * rnd.normal(size=8))) for i in rnd.permutation(500)]
    rows += rows[:40] + [(None, rows[0][1]), (3, f32(rnd.normal(size=8)))]
    assert run(spark, rows, k=9, rounds=4, size=8) == brute(rows, 9, 4, 8)


def test_ties_copies_and_unusable_vectors(spark):
    rows = [(i, [float(i % 3), -float(i % 2)]) for i in range(30)] + [(i, [0.25, 0.25]) for i in range(30, 400)]
    rows += [(900, None), (901, [1.0]), (902, [None, 1.0]), (903, [float("nan"), 0.0]), (904, [float("-inf"), 0.0]), (905, [])]
    for k in (1, 5, 40):
        assert run(spark, rows, k=k, rounds=3, size=2) == brute(rows, k, 3, 2)
    assert run(spark, rows[:3], k=40, rounds=2, size=2) == brute(rows[:3], 40, 2, 2)      # fewer vectors than centroids


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []


def test_large_components(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, f32(rnd.normal(size=4) * 10.0 ** rnd.integers(-3, 12))) for i in range(120)]
    assert run(spark, rows, k=6, rounds=3, size=4) == brute(rows, 6, 3, 4)


def test_search_rejects_without_a_distance():
    rnd = np.random.default_rng(3)
    centres = rnd.integers(-300, 300, (40, 1)) + rnd.integers(-5, 6, (40, 64)) * rnd.integers(1, 20, (40, 1))
    x = centres[rnd.integers(0, 40, 3000)] + rnd.integers(-4, 5, (3000, 64))
    number, best, computed = ce.Centroids(centres.tolist()).nearest(x)
    d = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (best == d.min(axis=1)).all() and (number == d.argmin(axis=1)).all()
    assert computed < 0.2 * d.size


def test_sql_twin(spark):
    import duckdb
    path = "/root/testdata/sf0.001/embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    want = sorted(con.execute("SELECT vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 FROM (" + ce.OP11_SQL + ")").fetchall())
    got = sorted(map(tuple, ce.op11_centroid_eenns(spark, "/root/testdata/sf0.001").collect()))
    assert got == want and len(got) == spark.read.parquet(path).where(F.size("embedding") == 64).count()
