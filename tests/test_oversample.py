import datetime as dt
import hashlib
import random

import pytest

from tickloom.operators import oversample as ov

COLS = ["a", "b", "c"]
DAY = dt.date(2024, 1, 1)


def draw(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16)


def brute(rows, k, seed=42):
    """rows: (symbol, label, day, x) with distinct days."""
    out = []
    for s in {r[0] for r in rows}:
        classes = {}
        for r in rows:
            if r[0] == s:
                classes.setdefault(r[1], []).append(r)
        most = max(map(len, classes.values()))
        for label, own in classes.items():
            lack = most - len(own)
            order = sorted(own, key=lambda r: draw(seed, s, label, r[2]))
            for i, (_, _, day, x) in enumerate(order):
                near = sorted((round(sum((p - q) ** 2 for p, q in zip(x, o[3])), 9), o[2], o[3]) for o in own if o[2] != day)[:k]
                for copy in range(1, lack // len(own) + (i < lack % len(own)) + 1):
                    u = (draw(seed, s, label, day, copy, "u") + 0.5) / 2 ** 52
                    _, near_day, y = near[draw(seed, s, label, day, copy, "n") % len(near)] if near else (0, day, x)
                    out.append((s, label, day, copy, near_day, round(u, 12), *[round(p + u * (q - p), 9) for p, q in zip(x, y)]))
    return sorted(out)


def run(spark, rows, k=5):
    df = spark.createDataFrame([(s, l, d, *x, 1) for s, l, d, x in rows], "symbol string, target_direction int, date date, a double, b double, c double, n int")
    return sorted((*r[:5], round(r[5], 12), *[round(x, 9) for x in r[6:]]) for r in ov.oversample(spark, df, COLS, k=k).collect())


def made(rnd, symbol, label, n, shift=0.0):
    return [(symbol, label, DAY + dt.timedelta(days=7 * i + label), [rnd.gauss(shift, 1 + j) for j in range(3)]) for i in range(n)]


@pytest.mark.parametrize("block", [2048, 7])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ov, "BLOCK", block)
    rnd = random.Random(block)
    rows = made(rnd, "A", 1, 90) + made(rnd, "A", 0, 40, 3.0) + made(rnd, "B", 0, 33) + made(rnd, "B", 1, 30)
    want = brute(rows, 5)
    assert run(spark, rows) == want and len(want) == 50 + 3


def test_small_classes(spark):
    rnd = random.Random(1)
    rows = made(rnd, "A", 1, 9) + made(rnd, "A", 0, 1) + made(rnd, "B", 1, 8) + made(rnd, "B", 0, 3) + made(rnd, "C", 1, 4)
    got = run(spark, rows)
    assert got == brute(rows, 5)
    lone = next(r for r in rows if r[0] == "A" and r[1] == 0)
    assert [g for g in got if g[0] == "A"] == [("A", 0, lone[2], i, lone[2], g[5], *[round(x, 9) for x in lone[3]])
                                               for i, g in zip(range(1, 9), [g for g in got if g[0] == "A"])]
    assert not [g for g in got if g[0] == "C"]


def test_nulls_ties_and_empty(spark):
    rows = [("A", 1, DAY + dt.timedelta(days=i), [0.0, 0.0, float(i)]) for i in range(0, 20, 2)]
    rows += [("A", 0, DAY + dt.timedelta(days=i), [1.0, 1.0, 1.0]) for i in range(1, 13, 2)]          # all alike: ties by day
    assert run(spark, rows, 2) == brute(rows, 2)
    odd = [("A", 0, DAY, [None, 1.0, 1.0]), ("A", 0, DAY, [float("nan"), 1.0, 1.0]), (None, 0, DAY, [1.0, 1.0, 1.0])]
    assert run(spark, rows + odd, 2) == brute(rows, 2)
    assert run(spark, []) == []
