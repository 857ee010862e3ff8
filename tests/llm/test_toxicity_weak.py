import random
import zlib

import numpy as np

from tickloom.llm import toxicity_weak as tw

BAD = ["grubbel", "vexolin", "mordat", "slurpen"]


def corpus(n, seed=1):
    """Toxic texts hold two or more words that begin with one of BAD."""
    rnd = random.Random(seed)
    parts = ["ta", "mi", "lo", "ren", "gu", "sche", "tion", "ble"]
    word = lambda: "".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rnd.randrange(3, 200))]
        toxic = rnd.random() < 0.2
        for _ in range(rnd.randrange(2, 6) if toxic else 0):
            words[rnd.randrange(len(words))] = rnd.choice(BAD) + rnd.choice(["", "en", word()])
        rows.append((i, " ".join(words), int(any(w.startswith(tuple(BAD)) for w in words))))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t, _ in rows], "doc_id long, text string, y string, score double")
    labels = spark.createDataFrame([(i, y, "z") for i, _, y in rows if i is not None and i % 5], "doc_id long, toxic int, text string")
    return docs, labels


def test_held_out_accuracy(spark):
    rows = corpus(1500)
    docs, labels = frames(spark, rows)
    model = tw.fit(spark, docs, labels)
    got = {r.doc_id: r.score for r in tw.scores(docs, model).collect()}
    held = [(got[i] >= 0.3, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 250 and np.mean([p == bool(y) for p, y in held]) > 0.97
    kept = {r.doc_id for r in tw.keep_clean(spark, docs, labels).collect()}
    assert kept == {i for i, s in got.items() if s < tw.THRESHOLD} and tw.keep_clean(spark, docs, labels).columns == docs.columns
    # labels of held-out rows are not read
    wrong = spark.createDataFrame([(i, y if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - y, "z") for i, _, y in rows if i % 5],
                                  "doc_id long, toxic int, text string")
    assert {r.doc_id: r.score for r in tw.scores(docs, tw.fit(spark, docs, wrong)).collect()} == got


def test_odd_rows(spark):
    rows = corpus(400)
    docs, labels = frames(spark, rows + [(None, "grubbel", 1), (900, None, 0), (900, "", 0), (901, "grubbel " * 100000, 1), (901, "grubbel " * 100000, 1)])
    more = labels.unionByName(spark.createDataFrame([(None, 1, "z"), (3, None, "z"), (4, 9, "z"), (6, 1, "z"), (900, 0, "z")], labels.schema))
    got = tw.scores(docs, tw.fit(spark, docs, more)).collect()
    assert len(got) == 405 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 900}) == 1 and all(r.score > 0.3 for r in got if r.doc_id == 901)
    assert {r.score for r in tw.scores(docs, tw.fit(spark, docs, labels.where("toxic = 0"))).collect()} == {0.0}
    assert tw.fit(spark, docs, labels.limit(0)) is None
    assert tw.keep_clean(spark, docs, labels.limit(0)).count() == 405
    assert tw.scores(docs.limit(0), tw.fit(spark, docs, labels)).collect() == []


def test_votes_cover_the_whole_text():
    voters = tw.Voters(["=bad", "wor"])
    far = voters("clean " * 50000 + "bad words worse")
    assert far[:4].tolist() == [1, 1, 0, 1]        # each occurs, the second one twice
    assert voters("").sum() == 0 and voters("nothing").sum() == 0


def joint(model, votes, label):
    """P(label, votes) by the chain of the tree, one voter at a time."""
    p = model.prior if label else 1 - model.prior
    for j, v in enumerate(votes):
        up = votes[model.parent[j]] if model.parent[j] >= 0 else 0
        r = model.rate[label, up, j]
        p *= r if v else 1 - r
    return p


def test_label_model_learns_rates_and_correlation():
    rnd = np.random.default_rng(0)
    n = 6000
    y = (rnd.random(n) < 0.3).astype(int)
    fire = lambda hit, false: np.where(y == 1, rnd.random(n) < hit, rnd.random(n) < false).astype(np.uint8)
    a, b, c = fire(0.8, 0.1), fire(0.7, 0.05), fire(0.6, 0.2)
    copy = np.where(rnd.random(n) < 0.95, a, 1 - a).astype(np.uint8)      # an echo of a
    votes = np.stack([a, b, c, copy], axis=1)
    known = np.where(rnd.random(n) < 0.3, y, -1)
    model = tw.LabelModel(votes, known)
    assert model.parent[3] == 0 or model.parent[0] == 3
    assert abs(model.prior - 0.3) < 0.05
    post = model.posterior(votes)
    for i in range(0, n, 500):
        on, off = joint(model, votes[i], 1), joint(model, votes[i], 0)
        assert abs(post[i] - on / (on + off)) < 1e-9
    assert ((post > 0.5) == y)[known < 0].mean() > 0.85
    left = [j for j in range(4) if model.parent[j] < 0]
    assert len(left) >= 2


def test_score_does_not_depend_on_the_sample_of_each_class(spark):
    # texts say nothing, so a score is the share of toxic labels, 1 in 9, whatever the sample
    docs = spark.range(4500).selectExpr("id as doc_id", "'some words that say nothing' as text")
    labels = spark.range(3600).selectExpr("id as doc_id", "cast(id % 9 = 0 as int) as toxic")
    for most in (200, 4000):
        score = tw.scores(docs.limit(1), tw.fit(spark, docs, labels, most=most)).first().score
        assert abs(score - 1 / 9) < 0.03, (most, score)


def test_targets_come_from_estimated_accuracies_and_correlations():
    rnd = np.random.default_rng(4)
    n = 4000
    y = (rnd.random(n) < 0.3).astype(int)
    fire = lambda hit, false: np.where(y == 1, rnd.random(n) < hit, rnd.random(n) < false).astype(np.uint8)
    a = fire(0.8, 0.2)
    echoes = [np.where(rnd.random(n) < 0.97, a, 1 - a).astype(np.uint8) for _ in range(3)]
    votes = np.stack([a, *echoes, fire(0.9, 0.02), fire(0.5, 0.4)], axis=1)
    times, known = np.ones(n), np.where(rnd.random(n) < 0.2, y, -1)

    def scored(change):
        model = tw.LabelModel(votes, known)
        change(model)
        return tw.logistic.predict(votes.astype(float), tw.classifier(votes, model, times))

    def alike(model):                     # one accuracy for all voters
        model.parent[:] = -1
        model.rate = np.broadcast_to(model.rate.mean(axis=2, keepdims=True), model.rate.shape).copy()

    def apart(model):                     # no correlations
        model.parent[:] = -1
        model.learn(votes, np.where(known >= 0, known, 0.0), (known >= 0).astype(float))
    whole, same_rates, no_tree = scored(lambda m: None), scored(alike), scored(apart)
    assert ((whole >= 0.3) != (same_rates >= 0.3)).mean() > 0.02 and np.abs(whole - no_tree).max() > 0.05
    right = lambda p: ((p >= 0.5) == y).mean()
    assert right(whole) >= max(right(same_rates), right(no_tree)) - 0.005
    # a label anchors the model; the classifier's target of its row is the posterior all the same
    model = tw.LabelModel(votes, known)
    assert np.abs(model.posterior(votes)[known >= 0] - known[known >= 0]).max() > 0.1


def test_hot_id_counts_once_and_texts_are_whole(spark):
    rows = corpus(500) + [(7001, "clean words " * 9000 + " grubbel" * 3, 1)] * 300
    docs, labels = frames(spark, rows)
    sample, _ = tw.sample(spark, docs, labels.dropDuplicates(["doc_id"]), "doc_id", "text", "toxic", 6000)
    assert sample.where("length(text) > 50000").count() <= 1
    may = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert sample.count() == len(may)


def test_lexicon_against_plain_counts(spark):
    rows = [(y, t) for _, t, y in corpus(300, 5)] + [(1, "x" * 70 + " end")] * 5
    df = spark.createDataFrame(rows, "y int, text string")
    n = {c: sum(y == c for y, _ in rows) for c in (0, 1)}
    want = []
    for term in set().union(*[tw.terms_of(t) for _, t in rows]):
        k, clean = (sum(y == c and term in tw.terms_of(t) for y, t in rows) for c in (1, 0))
        odds = np.log((k + 0.5) / (n[1] + 1)) - np.log((clean + 0.5) / (n[0] + 1))
        if k >= tw.LEAST_TEXTS and odds > 2:
            want.append((-round(float(odds * np.log1p(k)), 9), -len(term), term, k))
    got = [(t, k) for t, _, k in tw.candidates(df, 160)]
    assert got == [(t, k) for _, _, t, k in sorted(want)[:3200]] and ("=" + "x" * 70, 5) in got
