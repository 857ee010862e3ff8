import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import models as md
from tickloom.operators import sequence_model as sm

SCHEMA = "symbol string, date date, seq array<struct<date: date, x: array<double>>>, label int, part string"


def test_gradients():
    rnd = np.random.default_rng(0)
    net = sm.Net(3, (5, 4), 6).drawn(1)
    x, y = rnd.normal(size=(7, 4, 3)), rnd.integers(0, 2, 7).astype(float)
    masks = sm.masks_of(net, np.arange(7), 0.3, 5)
    odds, kept = sm.forward(net, x, masks)
    g, gx = sm.backward(net, kept, sm.sigmoid(odds) - y, masks)
    values = net.values

    def loss(v, x):
        net.values = v
        return sm.losses(sm.forward(net, x, masks)[0], y).sum()
    for i in rnd.integers(0, len(values), 60):
        e = np.zeros(len(values))
        e[i] = 1e-5
        assert g[i] == pytest.approx((loss(values + e, x) - loss(values - e, x)) / 2e-5, abs=1e-6)
    for _ in range(20):
        e = np.zeros(x.shape)
        e[tuple(rnd.integers(0, s) for s in x.shape)] = 1e-5
        assert (gx * e).sum() / 1e-5 == pytest.approx((loss(values, x + e) - loss(values, x - e)) / 2e-5, abs=1e-6)


def test_masks_follow_the_row():
    net = sm.Net(2, (8,), 4)
    rows = np.arange(1000) * 7919
    a, b = sm.masks_of(net, rows, 0.25, 3), sm.masks_of(net, rows[::-1], 0.25, 3)
    assert (a[0] == b[0][::-1]).all() and [m.shape for m in a] == [(1000, 8), (1000, 4)]
    assert abs((a[0] == 0).mean() - 0.25) < 0.03 and (sm.masks_of(net, rows, 0.25, 4)[0] != a[0]).any()


def made(spark, n=600, seed=0):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, 5, 2))
    y = (x[:, 1, 0] + x[:, 4, 0] - x[:, 2, 1] > 0).astype(int)
    day = dt.date(2024, 1, 1)
    rows = [("A", day + dt.timedelta(days=i), [(day, [float(v) for v in s]) for s in x[i]], int(y[i]), "fit" if i < 0.8 * n else "val") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_learns_and_repeats(spark, tmp_path):
    df = made(spark)
    given = dict(hidden=(12,), dense=6, epochs=14, batch=60, rate=0.02, dropout=0.1)
    net, history = sm.fit(spark, df, 2, **given)
    again, other = sm.fit(spark, df.repartition(5), 2, **given)
    assert [h[0] for h in history] == list(range(len(history)))
    assert np.allclose([h[1:3] for h in history], [h[1:3] for h in other], atol=1e-9) and np.allclose(net.values, again.values, atol=1e-8)
    assert min(h[2] for h in history) < 0.45 < history[0][2]
    loaded = sm.load(spark, sm.store(spark, net, str(tmp_path / "m")))
    p = sm.predict(loaded, df).where("part = 'val'")
    assert p.columns == [*df.columns, "p_up", "predicted_signal"]
    rows = p.collect()
    assert np.mean([r.predicted_signal == r.label for r in rows]) > 0.8
    x = np.array([[s.x for s in r.seq] for r in rows])
    assert np.allclose([r.p_up for r in rows], sm.sigmoid(sm.forward(net, x)[0]))


def test_early_stop_and_rate(spark):
    df = made(spark, 80).withColumn("label", F.expr("cast(hash(date) % 2 = 0 as int)"))          # nothing to learn
    _, history = sm.fit(spark, df, 2, hidden=(4,), dense=3, epochs=40, batch=80, rate=0.2, dropout=0.0, patience=4, stall=1)
    losses = [h[2] for h in history]
    best = int(np.argmin(losses))
    assert len(history) == 40 or len(history) == best + 5
    assert len({h[3] for h in history}) > 1
    with pytest.raises(ValueError):
        sm.fit(spark, df.limit(0), 2)


def test_attributions_add_up(spark):
    df = made(spark, 60)
    net, _ = sm.fit(spark, df, 2, hidden=(6,), dense=4, epochs=6, batch=30, rate=0.05, dropout=0.0)
    base = sm.background(df, ["symbol", "date"], 2, 5)
    a = sm.attributions(net, df, base, points=24)
    rows = a.withColumn("mean", md.collapse_steps("attributions", 2)).collect()
    for r in rows:
        total = sum(sum(s.x) for s in r.attributions)
        assert total == pytest.approx(r.log_odds - r.base_value, abs=0.02)
        assert sum(r["mean"]) * 5 == pytest.approx(total)
    assert max(abs(r.log_odds - r.base_value) for r in rows) > 0.3


def test_one_gradient_reaches_the_driver(spark, monkeypatch):
    monkeypatch.setattr(sm, "FLAT", 3)
    parts = spark.sparkContext.parallelize(range(10), 10).map(lambda k: (k, (float(k), 1, np.full(4, 0.1 * k))))
    loss, n, total = sm.summed(parts, 10)
    assert (loss, n) == (45.0, 10) and np.allclose(total, 4.5)
    assert sm.summed(parts.filter(lambda p: p[0] == 0).coalesce(1), 1)[1] == 1
