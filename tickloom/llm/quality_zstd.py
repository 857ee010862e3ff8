"""Compression classifier of text quality.

Two zstandard dictionaries are built, one from good and one from bad labelled
texts.  A text is compressed with both, in blocks (each starts from the
dictionary again, so the whole of a long text is judged); the difference of the
two compressed sizes, divided by the size of the text, is calibrated to a
probability by logistic regression on labelled texts that no dictionary saw.

Fitting takes a bounded sample: SAMPLE labelled ids of each class, the ones
with the smallest hash (a repeated id counts once, with the smallest of its
texts); half give PARTS passages of PART characters
each to the dictionaries, half calibrate.  The calibration weighs each class by
its number of rows in the whole table, so a score means the same at every size.
Scoring covers every row.

Defined cases: null and empty texts have difference zero and get the calibrated
score of that; a null label or id takes no part in fitting; with no label of a
class its dictionary is empty; without any label every score is 0.5; repeated
rows are scored each; further columns, also of the names used here, are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import logistic
from .common import class_weights, map_texts, table, train_rows

SAMPLE = 6000          # labelled rows of each class
PARTS, PART = 3, 2000  # passages of a sampled text, characters of each
DICTIONARY = 1 << 17   # bytes
BLOCK = 1024           # bytes compressed at a time
LEVEL = 3
THRESHOLD = 0.3
FOLDS, HELD = 5, 0


def build_dictionary(passages: list[str], size: int = DICTIONARY) -> bytes:
    """Content of a dictionary trained on ``passages``; where there are too few
    to train on, the passages themselves."""
    raw = [p.encode() for p in passages if p]
    joined = b"".join(raw)
    if len(raw) < 50 or len(joined) < 8 * 1024:
        return joined[-size:]
    size = min(size, max(1024, len(joined) // 4))
    try:
        return zstandard.train_dictionary(size, raw).as_bytes()
    except zstandard.ZstdError:            # e.g. all passages alike
        return joined[-size:]


class Sizes:
    """Compressed sizes of a text with either dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.with_good, self.with_bad = self.compressor(good), self.compressor(bad)

    @staticmethod
    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if len(content) < 8:
            return zstandard.ZstdCompressor(**plain)
        data = zstandard.ZstdCompressionDict(content)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=data, **plain)

    def __call__(self, text: str) -> tuple[int, int, int]:
        raw = memoryview(text.encode())
        good = bad = 0
        for at in range(0, len(raw), BLOCK):
            block = raw[at:at + BLOCK]
            good += len(self.with_good.compress(block))
            bad += len(self.with_bad.compress(block))
        return good, bad, len(raw)


def features(sizes: tuple[int, int, int]) -> list[float]:
    """The normalised difference, and how much text it rests on."""
    good, bad, n = sizes
    d, much = (bad - good) / max(n, 1), math.log1p(n) / 10
    return [d, d * much, much]


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, sample: int) -> tuple[DataFrame, dict[int, float]]:
    """(y, h, text): a bounded sample of the rows that may be learnt from; and what
    a row of each class counts for."""
    marked = (labels.where(F.col(label).isin(0, 1) & train_rows(doc_id, FOLDS, HELD) & F.col(doc_id).isNotNull())
              .select(F.col(doc_id), F.col(label).cast("int").alias("y"), F.xxhash64(doc_id).alias("h")).distinct())
    chosen = marked.where("y = 1").orderBy("h", doc_id).limit(sample).unionByName(
        marked.where("y = 0").orderBy("h", doc_id).limit(sample))
    rows = docs.select(F.col(doc_id), F.coalesce(F.col(text), F.lit("")).alias("text")).join(
        F.broadcast(chosen), doc_id)      # at most 2 * sample narrow rows
    rows = rows.groupBy(doc_id, "y", "h").agg(F.min("text").alias("text")).select("y", "h", "text")     # copies of an id count once
    return rows, class_weights(marked, "y", sample)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", sample: int = SAMPLE) -> tuple[bytes, bytes, np.ndarray]:
    """Both dictionaries and the calibration."""
    rows, weight = labelled(docs, labels, doc_id, text, label, sample)
    first = F.pmod(F.shiftright("h", 1), F.lit(2)) == 0
    starts = [F.pmod(F.xxhash64("h", F.lit(i)), F.greatest(F.lit(1), F.char_length("text") - PART)) + 1 for i in range(PARTS)]
    parts = rows.where(first).select("y", F.array(*[F.substring("text", s.cast("int"), F.lit(PART)) for s in starts]).alias("parts"))
    by_class: dict[int, list[str]] = {0: [], 1: []}
    for r in sorted(parts.collect(), key=lambda r: r.parts):       # bounded: SAMPLE * PARTS * PART characters a class
        by_class[r.y] += r.parts
    good, bad = build_dictionary(by_class[1]), build_dictionary(by_class[0])
    seen = sorted((r.y, r.good, r.bad, r.n) for r in sizes(rows.where(~first), ["y"], "text", good, bad).collect())
    if not seen:
        return good, bad, np.zeros(4)
    x = np.array([features(s[1:]) for s in seen])
    return good, bad, logistic.fit(x, np.array([s[0] for s in seen], float), np.array([weight[s[0]] for s in seen]))


def sizes(df: DataFrame, keep: list[str], text: str, good: bytes, bad: bytes) -> DataFrame:
    """``keep`` and the compressed sizes ``good`` and ``bad`` and the size ``n``."""
    def make():
        measure = Sizes(good, bad)
        return lambda texts: [list(c) for c in zip(*map(measure, texts))]
    return map_texts(df, keep, text, T.StructType([T.StructField(c, T.LongType()) for c in ("good", "bad", "n")]), make)


def scores(df: DataFrame, model: tuple[bytes, bytes, np.ndarray], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row."""
    good, bad, w = model

    def make():
        measure = Sizes(good, bad)
        return lambda texts: [logistic.predict(np.array([features(measure(t)) for t in texts]).reshape(-1, 3), w)]
    return map_texts(df, [doc_id], text, T.StructType([T.StructField("score", T.DoubleType())]), make)


def op9_quality_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scores(docs, fit(spark, docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (~train_rows("doc_id", FOLDS, HELD)).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
