import itertools
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import simhash_pivots as sp

WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]


def slow_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(ids, prints, k):
    label = list(range(len(ids)))
    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, j in itertools.combinations(range(len(ids)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= k:
            label[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            r = root(i)
            least[r] = min(d, least.get(r, d))
    return [least.get(root(i)) for i in range(len(ids))]


def fixture():
    rnd = random.Random(5)
    texts = [None, "", " \t\n", "one", "One", "two words", " odd space A", "ÀB c D", "x " * 30000]
    for _ in range(12):
        base = [rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(rnd.randrange(4, 300))]
        for _ in range(rnd.randrange(1, 6)):
            copy = list(base)
            copy[rnd.randrange(len(copy))] = "edit"
            texts.append(" ".join(copy))
        texts.append(" ".join(base).upper())
    return [(i * 7 % 101, t) for i, t in enumerate(texts)] + [(None, "one"), (None, "only here"), (3, texts[10]), (3, texts[10])]


def test_whole_operator_against_brute_force(spark):
    rows = fixture()
    docs = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, fp string, component_id long")
    got = sorted(map(tuple, sp.simhash_components(spark, docs).collect()), key=str)
    prints = [slow_print(t) for _, t in rows]
    comp = slow_components([i for i, _ in rows], prints, 2)
    want = sorted([(i, sp.signed(p), c) for (i, _), p, c in zip(rows, prints, comp)], key=str)
    assert got == want
    kept = sp.keep_one(spark, docs, max_bits=2)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for c in comp if c is not None})
    assert ids.count(None) == len({p for p, c in zip(prints, comp) if c is None})


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sp.simhash_components(spark, docs).collect() == []
    assert sp.keep_one(spark, docs).collect() == []


def test_pivots_tell_band_contents_apart():
    for width in (10, 11):
        every = np.arange(1 << width, dtype=np.uint64)
        table = np.stack([np.bitwise_count(every ^ np.uint64(r)).astype(int) - np.bitwise_count(every) for r in sp.resolving(width)])
        assert len(np.unique(table, axis=1).T) == 1 << width


def test_dense_ball_keeps_every_component(spark):
    """Thousands of prints within a few bits of each other: buckets above SPLIT."""
    rnd = random.Random(3)
    centre = rnd.getrandbits(64)
    ball = {centre}
    while len(ball) < 6000:
        x = centre
        for _ in range(rnd.randrange(1, 5)):
            x ^= 1 << rnd.randrange(22)
        ball.add(x)
    fps = sorted(sp.signed(x) for x in ball)
    a, b = sp.bucket_links(np.array(fps, np.int64).view(np.uint64), np.zeros(len(fps), np.int64), 2, np.zeros(1, np.uint64))
    label = {x: x for x in ball}
    def root(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x
    for x, y in zip(a.tolist(), b.tolist()):
        assert bin(x ^ y).count("1") <= 44
        label[root(x)] = root(y)
    flips = [1 << i for i in range(22)] + [1 << i | 1 << j for i, j in itertools.combinations(range(22), 2)]
    for x in ball:
        for f in flips:
            if x ^ f in label:
                assert root(x) == root(x ^ f)


def test_plan_has_no_cross_join(spark):
    prints = spark.range(10).select(F.xxhash64("id").alias("fp"))
    plan = sp.links(prints)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
