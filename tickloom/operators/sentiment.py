"""Sentiment scoring and aggregation.

Scoring (G1) is either the default word-list scorer, written entirely in
Catalyst higher-order functions (no Python per row, no shuffle), or an injected
batch scorer run with ``mapInArrow``, fed in slices of Arrow batches, with per-row failure
isolation (G10).  ``loader`` makes the scorer once in each Python worker, which
keeps it for its later tasks (``text_model`` holds a learnt one).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import col

# Default word lists of the lexicon scorer (English, Spanish).
POSITIVE_WORDS = [
    "good", "great", "excellent", "best", "better", "positive", "gain", "gains", "growth", "strong",
    "profit", "win", "up", "bullish", "happy", "love", "success", "improve", "bueno", "buena", "mejor",
    "excelente", "ganancia", "subida", "crecimiento", "fuerte", "alcista", "positivo",
]
NEGATIVE_WORDS = [
    "bad", "poor", "worst", "worse", "negative", "loss", "losses", "decline", "weak", "risk", "fail",
    "down", "bearish", "sad", "hate", "crash", "drop", "malo", "mala", "peor", "perdida", "caida",
    "debil", "riesgo", "bajista", "negativo",
]
# Labels of the three-class output and their numeric mapping.
LABEL_MAP = {"Positive": 1, "Neutral": 0, "Negative": -1}
ANSWER_STATES = ["positivo", "negativo", "neutro"]
WORD_SPLIT = r"[^\p{L}]+"
SLICE = 256           # rows of an Arrow batch that are Python strings at once

ScoreFn = Callable[[Sequence[str]], Sequence[tuple[str, float]]]


def _in_list(words: list[str]):
    """Membership test; a literal list longer than 10 items becomes a
    hash-set lookup (InSet) in Catalyst."""
    return lambda w: w.isin(*words)


def lexicon_score(text: str | Column) -> Column:
    """G1 default scorer: counts of positive / negative words over the whole
    text; label = the larger side (neutral on a tie), score = its share of the
    matched words (0.5 + 0.5 * |pos - neg| / (pos + neg), 1.0 when one-sided)."""
    words = F.split(F.lower(F.coalesce(col(text), F.lit(""))), WORD_SPLIT)
    pos = F.size(F.filter(words, _in_list(POSITIVE_WORDS)))
    neg = F.size(F.filter(words, _in_list(NEGATIVE_WORDS)))
    tot = pos + neg
    label = F.when(pos > neg, "positive").when(neg > pos, "negative").otherwise("neutral")
    score = F.when(tot == 0, F.lit(0.5)).otherwise(F.lit(0.5) + F.lit(0.5) * F.abs(pos - neg) / tot)
    return F.struct(label.alias("label"), score.alias("score"), pos.alias("n_pos"), neg.alias("n_neg"))


def _worker_scorer(loader) -> ScoreFn:
    """The scorer that this Python worker keeps between its tasks, made if it is of another model.  It is kept
    beside the interpreter's modules, as this module travels to each task by value."""
    import sys
    if getattr(sys, "_tickloom_scorer", (None,))[0] != loader.key:
        sys._tickloom_scorer = (loader.key, loader())
    return sys._tickloom_scorer[1]


def isolated(score: ScoreFn, texts: list[str], batch_size: int) -> list[tuple[str, float]]:
    """(label, score) of each text, in batches; the rows of a failing batch one by one."""
    out = []
    for i in range(0, len(texts), batch_size):
        chunk = texts[i:i + batch_size]
        try:
            res = list(score(chunk))
            if len(res) != len(chunk):
                raise ValueError("scorer returned a different number of results")
        except Exception:  # noqa: BLE001 - isolate the failing row
            res = []
            for t in chunk:
                try:
                    res.append(tuple(score([t])[0]))
                except Exception:  # noqa: BLE001
                    res.append(("ERROR", 0.0))
        out += res
    return out


def score_texts(df: DataFrame, text: str = "text", scorer: ScoreFn | None = None,
                batch_size: int = 16, loader: Callable[[], ScoreFn] | None = None) -> DataFrame:
    """G1 + G10: append (label, score).  With ``scorer`` (a picklable callable
    taking a list of texts and returning (label, score) pairs) the work runs in
    ``mapInArrow``; a failing batch is retried row by row and a failing row
    becomes ("ERROR", 0.0).  ``loader`` (picklable, with a ``key`` that names the
    model) makes the scorer in the worker instead; if that fails, the task does."""
    if scorer is None and loader is None:
        s = lexicon_score(text)
        return df.withColumns({"label": s["label"], "score": s["score"].cast("double")})

    out_schema = T.StructType(df.schema.fields + [T.StructField("label", T.StringType()),
                                                  T.StructField("score", T.DoubleType())])

    at, names = df.columns.index(text), out_schema.names

    def run(batches):
        score = scorer if loader is None else _worker_scorer(loader)
        for b in batches:
            # small slices: a worker holds the texts of one as Python strings, not those of a whole batch
            for first in range(0, b.num_rows, SLICE):
                part = b.slice(first, SLICE)
                texts = ["" if t is None else str(t) for t in part.column(at).to_pylist()]
                done = isolated(score, texts, batch_size)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([r[0] for r in done], pa.string()),
                                                  pa.array([float(r[1]) for r in done], pa.float64())], names=names)

    return df.mapInArrow(run, out_schema)


def continuous_score(label: str | Column = "label", score: str | Column = "score", digits: int = 4) -> Column:
    """Pos / label_2 -> 0.5 + s/2; neg / label_0 -> 0.5 - s/2; else 0.5; rounded."""
    lab = F.lower(col(label))
    s = col(score)
    v = (F.when(lab.contains("pos") | lab.contains("label_2"), F.lit(0.5) + s * 0.5)
         .when(lab.contains("neg") | lab.contains("label_0"), F.lit(0.5) - s * 0.5)
         .otherwise(F.lit(0.5)))
    m = float(10 ** digits)
    return F.round(v * m, 0) / m


def normalise_label(label: str | Column = "label") -> Column:
    """Positive / negative / neutral."""
    lab = F.lower(col(label))
    return (F.when(lab.contains("pos") | lab.contains("label_2"), "positive")
            .when(lab.contains("neg") | lab.contains("label_0"), "negative").otherwise("neutral"))


def daily_sentiment(scored: DataFrame, keys=("symbol",), day: str = "fecha_limpia",
                    score: str = "puntuacion_sentimiento") -> DataFrame:
    """Per symbol and day: count of non-null scores, mean, sample std with
    NULL -> 0.  Null days are dropped first (pandas groupby drops null keys).
    A partial + final hash aggregate: a hot symbol-day is combined map-side."""
    return scored.where(F.col(day).isNotNull()).groupBy(*keys, day).agg(
        F.count(score).alias("volumen_posts"),
        F.avg(score).alias("sentimiento_medio"),
        F.coalesce(F.stddev_samp(score), F.lit(0.0)).alias("sentimiento_std"))


def sentiment_summary(daily: DataFrame, keys=("symbol",)) -> DataFrame:
    """Mean daily volume, mean of daily means; 0.5 when there is none."""
    return daily.groupBy(*keys).agg(
        F.avg("volumen_posts").alias("volumen_medio"),
        F.coalesce(F.avg("sentimiento_medio"), F.lit(0.5)).alias("sentimiento_global"))


def top_n_per_day(posts: DataFrame, n: int = 300, keys=("symbol", "fecha_limpia"),
                  rank_by: Sequence[Column] | None = None, id_col: str = "tweet_id",
                  salt_buckets: int = 16) -> DataFrame:
    """The n best posts per symbol-day, by engagement (favoritos +
    retweets) then id.  Skew-safe two-phase top-n: rank inside (key, salt)
    sub-groups first, keep n from each, then rank the survivors per key.  The
    result is exact - every global top-n row is within the top n of its
    sub-group - and no single task sorts a hot key's full row set."""
    from pyspark.sql import Window
    order = list(rank_by) if rank_by else [
        (F.coalesce(F.col("favoritos"), F.lit(0)) + F.coalesce(F.col("retweets"), F.lit(0))).desc(),
        F.col(id_col).asc()]
    salted = posts.withColumn("_salt", F.pmod(F.xxhash64(F.col(id_col)), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    first = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= n)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (first.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= n)
            .drop("_salt", "_r"))


def label_value(label: str | Column) -> Column:
    """Capitalised label -> 1 / 0 / -1; any other label -> NULL."""
    m = F.create_map(*[x for k, v in LABEL_MAP.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, col(label))


def answer_label(answer: str | Column) -> Column:
    """First of positivo / negativo / neutro contained in the lower-cased
    answer (capitalised); blank text -> Vacio; otherwise Indeterminado."""
    a = F.lower(F.trim(F.coalesce(col(answer), F.lit(""))))
    out = F.when(a == "", "Vacio")
    for s in ANSWER_STATES:
        out = out.when(a.contains(s), s.capitalize())
    return out.otherwise("Indeterminado")


def align_batch_answers(answers: str | Column, batch_size: str | Column) -> Column:
    """Split a comma-separated batch answer, trim and capitalise each part;
    pad with "Error" when short, cut when long -> exactly batch_size labels."""
    parts = F.transform(F.split(col(answers), ","),
                        lambda s: F.concat(F.upper(F.substring(F.trim(s), 1, 1)),
                                           F.lower(F.substr(F.trim(s), F.lit(2)))))
    n = col(batch_size).cast("int")
    padded = F.concat(parts, F.array_repeat(F.lit("Error"), F.greatest(n - F.size(parts), F.lit(0))))
    return F.slice(padded, 1, n)


def throughput(df: DataFrame, name: str = "scoring") -> tuple[DataFrame, Callable[[], dict]]:
    """Rows, seconds and rows/s of an action over ``df``.  Rows come from
    ``observe`` (counted on the executors as the data flows)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    t0 = time.time()

    def report() -> dict:
        secs = time.time() - t0
        rows = obs.get["rows"]
        return {"rows": rows, "seconds": secs, "rows_per_sec": rows / secs if secs > 0 else 0.0}
    return observed, report

