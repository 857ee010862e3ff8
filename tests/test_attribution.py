import itertools
import math

import numpy as np
import pytest

from tickloom.operators import attribution as at
from tickloom.operators import boosting as bo
from tickloom.operators import models as md

COLS = ["a", "b", "c"]


def made(spark, n=300, seed=2):
    rnd = np.random.default_rng(seed)
    x = np.round(rnd.normal(size=(n, 3)), 2)
    y = ((x[:, 0] + x[:, 1] ** 2 + 0.5 * rnd.normal(size=n)) > 0.8).astype(int)
    rows = [(i, int(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, target_direction int, a double, b double, c double")


def expected(tree, node, row, known):
    n = tree[node]
    if n.feature is None:
        return n.value
    if n.feature in known:
        return expected(tree, n.left if row[n.feature] <= n.threshold else n.right, row, known)
    return sum(expected(tree, c, row, known) * tree[c].cover / n.cover for c in (n.left, n.right))


def by_subsets(nodes, row):
    """Shapley values by every subset of features."""
    trees = {}
    for r in nodes:
        trees.setdefault(r.tree, {})[r.node] = r
    out = []
    for f in COLS:
        others, total = [c for c in COLS if c != f], 0.0
        for k in range(3):
            w = math.factorial(k) * math.factorial(2 - k) / 6
            for s in itertools.combinations(others, k):
                total += w * sum(expected(t, min(t), row, {*s, f}) - expected(t, min(t), row, set(s)) for t in trees.values())
        out.append(total)
    return out, sum(expected(t, min(t), row, set()) for t in trees.values())


def check(nodes, df):
    held = nodes.collect()
    rows = at.attributions(nodes, df, COLS).collect()
    for r in rows[:40]:
        want, base = by_subsets(held, r)
        assert r.attributions == pytest.approx(want, abs=1e-10) and r.base_value == pytest.approx(base, abs=1e-10)
    return rows


def test_booster(spark):
    df = made(spark)
    model = bo.fit(spark, df, COLS, rounds=4, depth=3, step=0.3, bins=16)
    rows = check(at.booster_nodes(model), df)
    p = {r.id: r.p_up for r in bo.predict(model, df, COLS).collect()}
    for r in rows:
        assert 1 / (1 + math.exp(-(r.base_value + sum(r.attributions)))) == pytest.approx(p[r.id], abs=1e-10)


def test_forest(spark, tmp_path):
    df = made(spark)
    path = str(tmp_path / "forest")
    md.random_forest(COLS, weight=None, num_trees=4, max_depth=3).fit(df).write().save(path)
    rows = check(at.forest_nodes(spark, path, COLS), df)
    p = {r.id: r.p_up for r in md.predict(md.load(path), df).collect()}
    for r in rows:
        assert r.base_value + sum(r.attributions) == pytest.approx(p[r.id], abs=1e-10)
    sizes = at.mean_sizes(at.attributions(at.forest_nodes(spark, path, COLS), df, COLS), COLS).collect()
    assert {r.feature for r in sizes} == set(COLS)


def test_one_leaf_and_no_rows(spark):
    df = made(spark, 20).selectExpr("id", "target_direction", "0.0 AS a", "0.0 AS b", "0.0 AS c").selectExpr(
        "id", "target_direction", "cast(a as double) a", "cast(b as double) b", "cast(c as double) c")
    model = bo.fit(spark, df, COLS, rounds=1, depth=2)
    assert {tuple(r.attributions) for r in at.attributions(at.booster_nodes(model), df, COLS).collect()} == {(0.0, 0.0, 0.0)}
    assert at.attributions(at.booster_nodes(model), df.limit(0), COLS).collect() == []
