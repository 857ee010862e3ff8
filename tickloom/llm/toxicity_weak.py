"""Toxicity by weak supervision.

Many voters look at a text: one for each term of a lexicon (whole words, and
beginnings of words) and one for each of some patterns of writing.  A generative
label model gives every voter its rate of firing on toxic and on clean texts,
and accounts for correlated voters: each voter may depend on one other voter
besides the label (the tree with the largest conditional mutual information).
Expectation-maximisation estimates these rates; texts with a label anchor it,
texts without one take the posterior.  A linear classifier is then trained on
the posterior labels, of all rows alike, and scores every text.

The lexicon is found in the labelled texts: the terms that speak most strongly
for a toxic text.  Fitting takes a bounded sample: SAMPLE labelled rows of each
class and SAMPLE rows without a label that may be learnt from, the ones with the
smallest hash of their id, each id once (the smallest of its texts).  Their whole
texts are read by Spark tasks; only counts of terms, the best candidates' toxic rows, and
counted patterns of votes reach the driver.  Label model and classifier weigh each
class by its number of rows in the whole table, so a score means the same at every
size.  Scoring covers the whole of every text.

Defined cases: null and empty texts have no vote and get the score of that;
null labels or ids take no part in fitting; without labels of both classes every
score is 0; repeated rows are scored each, and a repeated id counts once in the
sample; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import logistic
from .common import class_weights, fresh, in_small_batches, map_texts, same, table, train_rows, written

SAMPLE = 6000        # rows of each class, and without a label
TERMS = 160          # of the lexicon, at most
LEAST_TEXTS = 4      # toxic sample texts that a term must occur in
BEGINNINGS = range(3, 9)   # lengths of beginnings of words
OFTEN = 200
ROUNDS = 30          # of expectation-maximisation
THRESHOLD = 0.3
FOLDS, HELD = 4, 2

WORD = re.compile(r"\w+")
# Patterns of writing; voters like any other, their rates are estimated.
PATTERNS = [re.compile(p) for p in (
    r"!{3,}", r"[A-Z]{12,}", r"[#$%&*@]{3,}", r"(?i)\b(?:you|tu|du|eres) (?:are|es|bist|un|una|ein|eine|a|an)\b",
    r"(.)\1{4,}", r"(?i)\b(?:shut up|get lost|go away|hate)\b", r"\w[*$#@]{2,}\w", r"\?!")]


def terms_of(text: str) -> set[str]:
    """Words (``=word``) and beginnings of words (``beg``) of a text, lower case."""
    words = set(WORD.findall(text.lower()))
    found = {"=" + w for w in words}
    for n in BEGINNINGS:
        found.update(w[:n] for w in words if len(w) >= n)
    return found


def mapped(rows: DataFrame, schema: str, work: Callable[[Iterator[tuple[int, str]]], Iterator[tuple]]) -> DataFrame:
    """What ``work`` makes of a task's (label, whole text) rows."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = work(pair for b in batches for pair in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        while part := list(islice(made, 4096)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), arrow)], schema=arrow)
    return in_small_batches(rows.select("y", "text")).mapInArrow(run, schema)


def candidates(rows: DataFrame, most: int) -> list[tuple[str, float, int]]:
    """(term, log odds, toxic texts) of the terms that set toxic texts apart most, over the labelled rows (y, text)."""
    def count(pairs):
        counts = {1: Counter(), 0: Counter()}
        for y, text in pairs:
            counts[y].update(terms_of(text))
        for term in counts[1].keys() | counts[0].keys():
            yield term, counts[1][term], counts[0][term]
    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n1, n0 = max(1, n.get(1, 0)), max(1, n.get(0, 0))
    terms = mapped(rows, "term string, k long, clean long", count).groupBy("term").agg(F.sum("k").alias("k"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("k") + 0.5) / (n1 + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1))
    good = terms.where(F.col("k") >= LEAST_TEXTS).withColumn("odds", odds).where("odds > 2")
    ranked = good.orderBy(F.desc(F.round(F.col("odds") * F.log1p("k"), 9)), F.desc(F.length("term")), "term").limit(20 * most)
    return [(r.term, r.odds, r.k) for r in ranked.collect()]


def lexicon(rows: DataFrame, most: int = TERMS) -> dict[str, float]:
    """Terms that set toxic texts apart, with their log odds, over the labelled rows (y, text).  Terms are taken
    by how many toxic texts they cover that terms before them did not, weighed by
    their odds, so that one frequent stem does not crowd out others."""
    ranked = candidates(rows, most)
    place = {term: i for i, (term, _, _) in enumerate(ranked)}

    def mark(pairs):
        for _, text in pairs:
            if found := sorted(place[t] for t in terms_of(text) if t in place):
                yield (found,)
    toxic = [r.at for r in mapped(rows.where("y = 1"), "at array<int>", mark).orderBy("at").collect()]     # at most a class's sample
    where: list[list[int]] = [[] for _ in ranked]
    for i, found in enumerate(toxic):
        for t in found:
            where[t].append(i)
    seen = np.zeros(len(toxic))
    chosen: dict[str, float] = {}
    left = list(range(len(ranked)))
    while left and len(chosen) < most:
        gain = [ranked[t][1] ** 2 * (0.6 ** seen[where[t]]).sum() for t in left]
        best = int(np.argmax(gain))
        if gain[best] < 1.0 * LEAST_TEXTS:
            break
        t = left.pop(best)
        chosen[ranked[t][0]] = ranked[t][1]
        seen[where[t]] += 1
    return chosen


class Voters:
    """Votes on a text, as one row of 0 and 1.  Each term has three voters: it
    occurs, it occurs again, it occurs more often than once in OFTEN words.  Each
    pattern has one, and so has each number of different terms (1, 2, 3 or more)."""

    def __init__(self, terms: list[str]):
        self.whole = {t[1:]: i for i, t in enumerate(terms) if t[0] == "="}
        begin = {t: i for i, t in enumerate(terms) if t[0] != "="}
        self.by_length = [(n, {t: i for t, i in begin.items() if len(t) == n}) for n in sorted({len(t) for t in begin})]
        self.n = len(terms)
        self.columns = 3 * self.n + len(PATTERNS) + 3

    def counts(self, words: list[str]) -> np.ndarray:
        found = np.zeros(self.n, np.int64)
        times = Counter(words)
        for w in self.whole.keys() & times.keys():
            found[self.whole[w]] = times[w]
        for n, begin in self.by_length:
            for w in times:
                i = begin.get(w[:n])
                if i is not None:
                    found[i] += times[w]
        return found

    def __call__(self, text: str) -> np.ndarray:
        row = np.zeros(self.columns, np.uint8)
        if not text:
            return row
        words = WORD.findall(text.lower())
        found = self.counts(words)
        row[:self.n] = found > 0
        row[self.n:2 * self.n] = found > 1
        row[2 * self.n:3 * self.n] = found * OFTEN > len(words)
        at = 3 * self.n
        for j, p in enumerate(PATTERNS):
            row[at + j] = p.search(text) is not None
        hits = int((found > 0).sum())
        for j in range(3):
            row[at + len(PATTERNS) + j] = hits > j
        return row


class LabelModel:
    """P(label) and P(vote | label, one other vote) over 0/1 votes."""

    def __init__(self, votes: np.ndarray, known: np.ndarray, rounds: int = ROUNDS, times: np.ndarray | None = None):
        """``known``: 1, 0, or -1 where the label must be inferred; ``times``: what
        each row of votes counts for."""
        times = np.ones(len(votes)) if times is None else times.astype(float)
        self.parent = np.full(votes.shape[1], -1)
        y = np.where(known >= 0, known, 0.0).astype(float)
        weight = times * (known >= 0)
        self.learn(votes, y, weight)               # from the anchored rows alone
        self.parent = self.tree(votes, y, weight)
        self.learn(votes, y, weight)
        for _ in range(rounds):
            y = np.where(known >= 0, known, self.posterior(votes))
            self.learn(votes, y, times)

    def learn(self, votes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        self.prior = (weight @ y + 1) / (weight.sum() + 2)
        self.rate = np.empty((2, 2, votes.shape[1]))          # label, parent's vote, voter
        for label, w in ((1, weight * y), (0, weight * (1 - y))):
            for up in (0, 1):
                given = w[:, None] * self.up(votes, up)
                self.rate[label, up] = ((given * votes).sum(axis=0) + 0.5) / (given.sum(axis=0) + 1)

    def up(self, votes: np.ndarray, value: int) -> np.ndarray:
        rooted = self.parent < 0
        out = (votes[:, np.maximum(self.parent, 0)] == value).astype(float)
        out[:, rooted] = 1.0
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        score = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        parent = votes[:, np.maximum(self.parent, 0)] * (self.parent >= 0)
        for up in (0, 1):
            on = np.log(self.rate[1, up]) - np.log(self.rate[0, up])
            off = np.log1p(-self.rate[1, up]) - np.log1p(-self.rate[0, up])
            score += ((parent == up) * np.where(votes, on, off)).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(score, -35, 35)))

    @staticmethod
    def tree(votes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Parents of the maximum spanning forest by mutual information of two
        votes given the label; correlations too weak to matter are left out."""
        v, k = votes.astype(float), votes.shape[1]
        info = np.zeros((k, k))
        for w in (weight * y, weight * (1 - y)):
            total = w.sum()
            if total < 1:
                continue
            both = (v * w[:, None]).T @ v / total
            one = np.diag(both)
            for a in (0, 1):
                for b in (0, 1):
                    p = {(1, 1): both, (1, 0): one[:, None] - both, (0, 1): one[None, :] - both,
                         (0, 0): 1 - one[:, None] - one[None, :] + both}[a, b]
                    q = (one if a else 1 - one)[:, None] * (one if b else 1 - one)[None, :]
                    p = np.maximum(p, 0)
                    info += total / max(weight.sum(), 1) * np.where((p > 1e-12) & (q > 1e-12),
                                                                     p * np.log(np.maximum(p, 1e-12) / np.maximum(q, 1e-12)), 0)
        np.fill_diagonal(info, 0)
        parent, left = np.full(k, -1), np.ones(k, bool)
        if not k:
            return parent
        best, source = np.full(k, -1.0), np.full(k, -1)
        at = 0
        while True:
            left[at] = False
            closer = left & (info[at] > best)
            best[closer], source[closer] = info[at][closer], at
            if not left.any():
                return parent
            at = int(np.argmax(np.where(left, best, -2)))
            if best[at] > 0.002:
                parent[at] = source[at]


def sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str,
           most: int) -> tuple[DataFrame, dict[int, float]]:
    """(y: label or -1, text) of a bounded sample of the rows that may be learnt from, stored once; and what a
    row of each class counts for (rows without a label count once)."""
    may = F.col(doc_id).isNotNull() & train_rows(doc_id, FOLDS, HELD)
    marked = labels.where(may & F.col(label).isin(0, 1)).select(doc_id, F.col(label).cast("int").alias("y"), F.xxhash64(doc_id).alias("h"))
    rest = (docs.where(may).select(doc_id).join(labels.where(F.col(label).isNotNull()).select(doc_id), doc_id, "left_anti").distinct()
            .select(doc_id, F.lit(-1).alias("y"), F.xxhash64(doc_id).alias("h")))
    chosen = [df.orderBy("h", doc_id).limit(most) for df in (marked.where("y = 1"), marked.where("y = 0"), rest)]
    narrow = chosen[0].unionByName(chosen[1]).unionByName(chosen[2])
    named = docs.select(doc_id, F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = named.join(F.broadcast(narrow), doc_id).groupBy(doc_id, "y").agg(F.min("text").alias("text"))      # 3 * most narrow rows
    return written(spark, rows.select("y", "text"), "toxicity-sample"), {-1: 1.0, **class_weights(marked, "y", most)}


def vote_patterns(rows: DataFrame, terms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(votes, label, rows) of the distinct pairs of votes and label: no more than the sample has rows."""
    def cast(pairs):
        voters, seen = Voters(terms), Counter()                          # most texts share their votes
        for y, text in pairs:
            seen[voters(text).tobytes(), y] += 1
        for (votes, y), n in seen.items():
            yield votes, y, n
    found = mapped(rows, "votes binary, y int, n long", cast).groupBy("votes", "y").agg(F.sum("n").alias("n")).orderBy("votes", "y").collect()
    return np.array([np.frombuffer(r.votes, np.uint8) for r in found]), np.array([r.y for r in found]), np.array([r.n for r in found])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", most: int = SAMPLE) -> tuple[list[str], np.ndarray] | None:
    """The lexicon and the weights of the linear classifier over its votes; None
    without labels of both classes."""
    rows, weight = sample(spark, docs, labels, doc_id, text, label, most)
    if rows.where("y >= 0").select("y").distinct().count() < 2:
        return None
    terms = list(lexicon(rows.where("y >= 0")))
    votes, known, n = vote_patterns(rows, terms)
    times = n * np.array([weight[y] for y in known.tolist()])
    return terms, classifier(votes, LabelModel(votes, known, times=times), times)


def classifier(votes: np.ndarray, model: LabelModel, times: np.ndarray) -> np.ndarray:
    """The linear classifier that comes closest to the label model's posteriors."""
    return logistic.fit(votes.astype(float), model.posterior(votes), times, ridge=0.5)


def scores(docs: DataFrame, model: tuple[list[str], np.ndarray] | None, doc_id: str = "doc_id", text: str = "text",
           keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """``keep`` (the id) and the score of every row."""
    def make():
        if model is None:
            return lambda texts: [[0.0] * len(texts)]
        voters = Voters(model[0])
        return lambda texts: [logistic.predict(np.array([voters(t) for t in texts], float).reshape(-1, voters.columns), model[1])]
    return map_texts(docs, keep or [doc_id], text, T.StructType([T.StructField(name, T.DoubleType())]), make)


def keep_clean(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, unchanged."""
    score = fresh(docs, "score")
    scored = scores(docs, fit(spark, docs, labels), keep=docs.columns, name=score)
    return same(scored.where(F.col(score) < threshold), docs.columns)


def op3_toxicity_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scores(docs, fit(spark, docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (~train_rows("doc_id", FOLDS, HELD)).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
