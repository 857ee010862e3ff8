import math

import numpy as np
import pytest

from tickloom.operators import boosting as bo

COLS = ["a", "b", "c"]


def made(n=1000, seed=0):
    rnd = np.random.default_rng(seed)
    x = np.round(rnd.normal(size=(n, 3)), 2)
    y = ((x[:, 0] + x[:, 1] ** 2 + 0.5 * rnd.normal(size=n)) > 0.8).astype(int)
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(int(t), *[None if v is None or math.isnan(v) else float(v) for v in r], 9) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "target_direction int, a double, b double, c double, p_up_ int").repartition(parts)


def slow(x, y, edges, rounds, depth, step=0.1, l2=1.0, least=1.0):
    """A booster that looks at every row for every split: {(tree, node): (feature, threshold, value)}."""
    margin, out = np.zeros(len(x)), {}
    for t in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * bo.UNIT) / bo.UNIT, np.rint(p * (1 - p) * bo.UNIT) / bo.UNIT
        todo = [(1, np.arange(len(x)), 0)]
        for node, rows, level in todo:
            sg, sh = g[rows].sum(), h[rows].sum()
            best = (1e-9, None, None)
            for f in range(x.shape[1] if level < depth else 0):
                for e in edges[f]:
                    left = rows[x[rows, f] <= e]
                    lg, lh = g[left].sum(), h[left].sum()
                    if lh >= least and sh - lh >= least:
                        gain = lg ** 2 / (lh + l2) + (sg - lg) ** 2 / (sh - lh + l2) - sg ** 2 / (sh + l2)
                        if gain > best[0] + 1e-12:
                            best = (gain, f, e)
            value = -step * sg / (sh + l2)
            out[t, node] = (best[1], best[2], value)
            if best[1] is None:
                margin[rows] += value
            else:
                right = x[rows, best[1]] > best[2]
                todo += [(2 * node, rows[~right], level + 1), (2 * node + 1, rows[right], level + 1)]
    return out, 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("parts", [1, 5])
def test_equals_a_slow_booster(spark, parts, monkeypatch):
    monkeypatch.setattr(bo, "ROWS", 170)
    x, y = made()
    df = frame(spark, x, y, parts)
    edges = bo.bin_edges(df, COLS, 12)
    model = bo.fit(spark, df, COLS, rounds=5, depth=3, step=0.1, bins=12)
    want, p = slow(x, y, edges, 5, 3)
    got = {(r.tree, r.node): (None if r.feature is None else COLS.index(r.feature), r.threshold, r.value) for r in model.collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][:2] == want[k][:2] and got[k][2] == pytest.approx(want[k][2], abs=1e-12)
    scored = bo.predict(model, df, COLS)
    mine = sorted((r.a, r.b, r.c, round(r.p_up, 9)) for r in scored.collect())
    assert mine == sorted((*map(float, r), round(float(q), 9)) for r, q in zip(x, p))
    assert scored.columns == [*df.columns, "p_up", "predicted_signal"]


def test_lower_loss_and_partitioning_does_not_matter(spark, tmp_path):
    x, y = made(3000, 1)
    x[::50, 1] = np.nan
    models = [sorted(map(tuple, bo.fit(spark, frame(spark, x, y, n), COLS, rounds=12, depth=4, step=0.3).collect()),
                     key=lambda r: r[:2]) for n in (1, 6)]
    assert models[0] == models[1]
    path = bo.store(spark.createDataFrame(models[0], bo.MODEL), str(tmp_path / "m"))
    rows = bo.predict(spark.read.parquet(path), frame(spark, x, y), COLS).select("target_direction", "p_up").collect()
    loss = -np.mean([math.log(p if t else 1 - p) for t, p in rows])
    base = y.mean()
    assert loss < 0.75 * -(base * math.log(base) + (1 - base) * math.log(1 - base))


def test_edge_cases(spark):
    x, y = made(40)
    none = frame(spark, x[:1], y[:1]).limit(0)
    assert bo.fit(spark, none, COLS, rounds=3).count() == 0
    assert [r.p_up for r in bo.predict(bo.fit(spark, none, COLS, rounds=3), frame(spark, x[:2], y[:2]), COLS).collect()] == [0.5, 0.5]
    flat = frame(spark, np.zeros((40, 3)), y)                            # nothing to split on: one leaf
    model = bo.fit(spark, flat, COLS, rounds=2, depth=3, step=1.0)
    assert [(r.tree, r.node, r.feature) for r in model.collect()] == [(0, 1, None), (1, 1, None)]
    importance = bo.importances(bo.fit(spark, frame(spark, *made()), COLS, rounds=3), COLS).collect()
    assert sum(r.importance for r in importance) == pytest.approx(1)
