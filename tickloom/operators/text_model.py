"""G1, learnt: a sentiment classifier fitted from labelled texts, stored as a table, and
scored in batches with the model loaded once by each Python worker.

A text is its words, in windows of ``WINDOW`` words (the longest input the model takes).
The fit sees each window once, with the text's label, and weights that give every text
the same say and both classes the same sum.  A stored model is a table of (term, weight),
the intercept under the empty term: at most ``VOCABULARY`` + 1 rows, which bounds what
is collected and broadcast.

By default a long text is scored window by window, its log odds being the windows'
weighted by their words, so the whole text counts; ``truncate=True`` scores the first
window only, as a model with a limited input does by itself.
"""

from __future__ import annotations

import math

import regex
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .sentiment import ScoreFn

WINDOW = 512
VOCABULARY = 20_000
WORD = r"\p{L}+"


def windows(text: str | Column, size: int = WINDOW) -> Column:
    """The text's lower-case words as an array of windows (one empty window for a text without words, or NULL)."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))), F.lit(WORD), F.lit(0))
    last = F.greatest(F.ceil(F.size(words) / size).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(words, i * size + 1, F.lit(size)))


def fit(labelled: DataFrame, path: str, text: str = "text", label: str = "label", vocabulary: int = VOCABULARY,
        min_texts: int = 2, ridge: float = 0.01, rounds: int = 50) -> str:
    """Fit on all rows whose ``label`` is 0 or 1 (others take no part) and store the model at ``path``.
    With one class only there is nothing to tell apart: an error."""
    spark = labelled.sparkSession
    w = labelled.where(F.col(label).isin(0, 1)).select(F.col(label).cast("double").alias("label"), windows(text).alias("_w"))
    sizes = {r["label"]: r["n"] for r in w.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        raise ValueError("the labelled texts hold fewer than two classes")
    share = F.when(F.col("label") == 1, 0.5 / sizes[1.0]).otherwise(0.5 / sizes[0.0]) * sum(sizes.values())
    rows = w.select("label", (share / F.size("_w")).alias("weight"), F.explode("_w").alias("words"))
    # the windows are stored once: the vocabulary, the vectors and the fit read them, not the texts
    held = scratch_path(spark, "text-windows")
    rows.write.parquet(held)
    rows = spark.read.parquet(held)
    steps = [CountVectorizer(inputCol="words", outputCol="features", vocabSize=vocabulary, minDF=float(min_texts), binary=True),
             LogisticRegression(labelCol="label", weightCol="weight", regParam=ridge, standardization=False, maxIter=rounds)]
    terms, line = Pipeline(stages=steps).fit(rows).stages
    pairs = [("", float(line.intercept)), *zip(terms.vocabulary, [float(x) for x in line.coefficients.toArray()])]
    spark.createDataFrame(pairs, "term string, weight double").coalesce(1).write.parquet(path)
    return path


def read(spark: SparkSession, path: str, most: int = VOCABULARY) -> dict[str, float]:
    """The stored model; more than ``most`` terms is an error, so that what is broadcast is bounded."""
    rows = spark.read.parquet(path).limit(most + 2).collect()
    if len(rows) > most + 1:
        raise ValueError(f"the model at {path} has more than {most} terms")
    return {r["term"]: r["weight"] for r in rows}


class LinearScorer:
    """(label, share) of texts by a term table.  A text without a word can't be scored: an error, which the
    caller isolates (G10)."""

    def __init__(self, weights: dict[str, float], window: int = WINDOW, truncate: bool = False):
        self.weights, self.window, self.truncate = weights, window, truncate
        self.base = weights.get("", 0.0)
        self.word = regex.compile(WORD)

    def odds(self, text: str) -> float:
        words = self.word.findall(text.lower())
        if not words:
            raise ValueError("a text without words")
        if self.truncate:
            words = words[:self.window]
        total = 0.0
        for i in range(0, len(words), self.window):
            part = words[i:i + self.window]
            total += len(part) * (self.base + sum(self.weights.get(t, 0.0) for t in sorted(set(part))))
        return total / len(words)

    def __call__(self, texts) -> list[tuple[str, float]]:
        out = []
        for t in texts:
            up = 1 / (1 + math.exp(-max(-500.0, min(500.0, self.odds(t)))))
            out.append(("positive", up) if up >= 0.5 else ("negative", 1 - up))
        return out


class Loader:
    """Makes the scorer of a stored model in a Python worker.  The term table travels as a broadcast variable;
    ``loads`` (an accumulator) counts how often a worker made its scorer."""

    def __init__(self, spark: SparkSession, path: str, truncate: bool = False):
        self.key = f"{path} {'first' if truncate else 'all'}"
        self.truncate = truncate
        self.weights = spark.sparkContext.broadcast(read(spark, path))
        self.loads = spark.sparkContext.accumulator(0)

    def __call__(self) -> ScoreFn:
        self.loads.add(1)
        return LinearScorer(self.weights.value, truncate=self.truncate)
