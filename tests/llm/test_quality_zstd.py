import random
import zlib

import numpy as np

from tickloom.llm import logistic
from tickloom.llm import quality_zstd as qz


def corpus(n, seed=1):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9))) for _ in range(400)]
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randrange(5, 300)))
        good = rnd.random() < 0.7
        rows.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split()), int(good)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y, None) for i, _, y in rows], "doc_id long, quality int, text string")
    model = qz.fit(spark, docs, labels)
    got = {r.doc_id: r.score for r in qz.scores(docs, model).collect()}
    held = [(got[i] >= 0.3, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 100 and np.mean([p == bool(y) for p, y in held]) > 0.95
    # labels of held-out rows are not read
    wrong = spark.createDataFrame([(i, y if zlib.crc32(str(i).encode()) % 5 else 1 - y, None) for i, _, y in rows],
                                  "doc_id long, quality int, text string")
    again = {r.doc_id: r.score for r in qz.scores(docs, qz.fit(spark, docs, wrong)).collect()}
    assert again == got


def test_odd_rows(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "a b"), (999, None), (999, ""), (5, "z " * 200000)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (2, None), (999, 0), (3, 7), (4, 1), (4, 1)],
                                   "doc_id long, quality int")
    got = qz.scores(docs, qz.fit(spark, docs, labels)).collect()
    assert len(got) == 304 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 999}) == 1
    one = labels.where("quality = 1")
    assert qz.scores(docs, qz.fit(spark, docs, one)).count() == 304
    none = qz.scores(docs, qz.fit(spark, docs, labels.limit(0))).collect()
    assert {r.score for r in none} == {0.5}
    assert qz.scores(docs.limit(0), qz.fit(spark, docs.limit(0), labels)).collect() == []


def test_whole_text_counts():
    measure = qz.Sizes(b"good words here " * 50, b"BAD WORDS HERE!! " * 50)
    head = "good words here " * 500
    good, bad, n = measure(head + "BAD WORDS HERE!! " * 3000)
    assert n > 50000 and good > bad
    assert measure("")[2] == 0 and qz.features(measure(""))[2] == 0


def test_logistic_recovers_weights():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(20000, 2))
    p = 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 1] + 0.5)))
    w = logistic.fit(x, (rnd.random(20000) < p).astype(float))
    assert np.abs(w - [1.5, -1, 0.5]).max() < 0.1


def test_score_does_not_depend_on_the_sample_of_each_class(spark):
    # texts say nothing, so a score is the share of good labels, 6 in 7, whatever the sample
    docs = spark.range(4200).selectExpr("id as doc_id", "'some words that say nothing' as text")
    labels = spark.range(4200).selectExpr("id as doc_id", "cast(id % 7 > 0 as int) as quality")
    for sample in (300, 6000):
        score = qz.scores(docs.limit(1), qz.fit(spark, docs, labels, sample=sample)).first().score
        assert abs(score - 6 / 7) < 0.03, (sample, score)


def test_copies_of_an_id_count_once(spark):
    docs = spark.range(5100).selectExpr("if(id < 5000, 1, id) as doc_id", "concat('text ', id % 2) as text")
    labels = spark.createDataFrame([(1, 1), (1, 1), (5005, 0), (5006, 1)], "doc_id long, quality int")
    docs = docs.unionByName(spark.createDataFrame([(2, "b"), (2, "a")], docs.schema))
    more = labels.unionByName(spark.createDataFrame([(i, i % 2) for i in range(2, 60)], labels.schema))
    rows, weight = qz.labelled(docs, more, "doc_id", "text", "quality", 100)
    kept = rows.collect()
    assert len(kept) == len({(r.y, r.h) for r in kept}) <= 4
    assert {r.text for r in kept} <= {"text 0", "text 1", "a"} and weight == {0: 1.0, 1: 1.0}
