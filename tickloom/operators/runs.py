"""I9 over time: runs, metrics and alias moves as one append-only table of events, read as of any moment.

An event is one of

* ``run``: a version of a model was made, of a ``kind`` and stored at ``path``;
* ``metric``: ``name`` of that version was measured as ``value``;
* ``alias``: the alias ``name`` of the model now points at ``version`` (NULL: taken away).

Nothing is changed in place, so what was champion at a moment can always be told: it is the
newest event up to it.  Events of one moment count in the order of ``seq``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType([
    T.StructField("at", T.TimestampType()), T.StructField("seq", T.LongType()), T.StructField("event", T.StringType()),
    T.StructField("model", T.StringType()), T.StructField("version", T.IntegerType()), T.StructField("name", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("kind", T.StringType()), T.StructField("path", T.StringType())])


def record(events: DataFrame, store: str) -> None:
    """Append events (missing columns as NULL).  Events without a moment or model have no place in time: an error."""
    names = events.columns
    rows = events.select(*[(F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENTS.fields])
    needed = F.when(F.col("at").isNull() | F.col("model").isNull() | F.col("event").isNull(),
                    F.raise_error(F.lit("an event needs at, model and event"))).otherwise(F.col("event"))
    rows.withColumn("event", needed).write.mode("append").parquet(store)


def events(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(store)


def _as_of(marks: DataFrame, moments: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Each moment with the newest mark of its keys up to it (NULL before the first).  Moments and marks are
    sorted together by key, a mark before a moment of the same time: one shuffle, no range join."""
    both = moments.select(*keys, "at", F.lit(1).alias("_asks"), F.lit(0).cast("bigint").alias("_seq"), F.lit(None).alias("_v")).unionByName(
        marks.select(*keys, "at", F.lit(0).alias("_asks"), F.coalesce("seq", F.lit(0)).cast("bigint").alias("_seq"), F.struct(*values).alias("_v")))
    w = Window.partitionBy(*keys).orderBy("at", "_asks", "_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where(F.col("_asks") == 1)
    return found.select(*keys, "at", *[F.col("_v")[v].alias(v) for v in values])


def champion_as_of(log: DataFrame, moments: DataFrame, priority: list[str], default: str, alias: str = "champion",
                   metric: str = "accuracy") -> DataFrame:
    """For each distinct ``at`` of ``moments``: the first model in ``priority`` that held the alias, its version and that
    version's newest metric by then.  If none held it, the default model's newest version, with metric 0.
    ``priority`` is a short list, so a moment is looked up once for each of its models."""
    asked = moments.select("at").where(F.col("at").isNotNull()).distinct().select("at", F.explode(F.array(*[F.lit(m) for m in dict.fromkeys([*priority, default])])).alias("model"))
    holds = _as_of(log.where((F.col("event") == "alias") & (F.col("name") == alias)), asked, ["model"], ["version"])
    made = _as_of(log.where(F.col("event") == "run"), asked, ["model"], ["version"]).withColumnRenamed("version", "_newest")
    order = F.array_position(F.array(*[F.lit(m) for m in priority]), F.col("model"))
    held = F.col("version").isNotNull() & (order > 0)
    best = holds.join(made, ["model", "at"]).groupBy("at").agg(
        F.min(F.when(held, F.struct(order.alias("place"), "model", "version"))).alias("_held"),
        F.max(F.when(F.col("model") == default, F.col("_newest"))).alias("_newest"))
    chosen = best.select("at", F.coalesce("_held.model", F.lit(default)).alias("model"), F.coalesce("_held.version", "_newest").alias("version"),
                         F.col("_held").isNotNull().alias("by_alias"))
    measured = _as_of(log.where((F.col("event") == "metric") & (F.col("name") == metric)), chosen.where("by_alias AND version IS NOT NULL"),
                      ["model", "version"], ["value"])
    joined = chosen.join(measured, ["model", "version", "at"], "left")
    return joined.select("at", F.col("model").alias("champion"), "version", F.coalesce("value", F.lit(0.0)).alias(metric), "by_alias")


def stored_model(log: DataFrame, model: str, version: int) -> tuple[str, str]:
    """(kind, path) of a version, from its newest ``run`` event; an unknown version is an error."""
    mine = log.where((F.col("event") == "run") & (F.col("model") == model) & (F.col("version") == version))
    last = mine.agg(F.max_by(F.struct("kind", "path"), F.struct("at", "seq")).alias("r")).first()["r"]
    if last is None:
        raise LookupError(f"no run of {model} version {version}")
    return last["kind"], last["path"]


def score_with(log: DataFrame, model: str, version: int, scorers: dict[str, Callable[[str], DataFrame]]) -> DataFrame:
    """The scores by a stored version: ``scorers`` has for each kind of model the function that loads it from its path and scores."""
    kind, path = stored_model(log, model, version)
    if kind not in scorers:
        raise LookupError(f"no way to score a model of kind {kind!r}")
    return scorers[kind](path)
