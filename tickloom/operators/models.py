"""Models and classification metrics (I1-I12) on ``pyspark.ml``.

Training is a ``Pipeline`` (VectorAssembler -> tree ensemble); Spark fits the
trees by aggregating split statistics per level across partitions.  Metrics
are single aggregates (``count_if`` arithmetic) over (model, ...) groups.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def random_forest(features: list[str], label: str = "target_direction", weight: str | None = "weight",
                  num_trees: int = 100, max_depth: int = 5, seed: int = 42, min_leaf: int = 1) -> Pipeline:
    """Random forest (100 trees, depth 5, seed 42, balanced weights)."""
    # cacheNodeIds keeps each row's current node per tree between levels
    # instead of re-walking every tree (an execution setting: same model;
    # more than twice as fast for deep forests).
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                                seed=seed, minInstancesPerNode=min_leaf, cacheNodeIds=True)
    if weight:
        rf.setWeightCol(weight)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), rf])


def boosted_trees(features: list[str], label: str = "target_direction", weight: str | None = "weight",
                  max_iter: int = 200, max_depth: int = 6, step: float = 0.01, seed: int = 42) -> Pipeline:
    """Gradient-boosted trees (200 rounds, depth 6, learning rate 0.01)."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, seed=seed)
    if weight:
        gbt.setWeightCol(weight)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), gbt])


def load(path: str) -> PipelineModel:
    """A stored pipeline.  The stored copy carries no training summary, whose
    reference to the session would otherwise travel inside the scoring closure."""
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """I4: P(up) from the probability vector, class = P(up) > threshold."""
    out = model.transform(df)
    p_up = vector_to_array("probability")[1]
    return out.withColumns({"p_up": p_up, "predicted_signal": (p_up > threshold).cast("int")}).drop(
        "features", "rawPrediction", "probability", "prediction")


def classification_metrics(df: DataFrame, keys=("model",), label: str = "label",
                           pred: str = "predicted_signal") -> DataFrame:
    """Accuracy, precision and F1 of the positive class; zero denominators give 0."""
    y, p = F.col(label), F.col(pred)
    tp = F.count_if((y == 1) & (p == 1))
    fp = F.count_if((y == 0) & (p == 1))
    fn = F.count_if((y == 1) & (p == 0))
    n = F.count(F.lit(1))
    m = df.groupBy(*keys).agg((F.count_if(y == p) / n).alias("accuracy"), tp.alias("_tp"), fp.alias("_fp"),
                              fn.alias("_fn"))
    prec = F.when(F.col("_tp") + F.col("_fp") == 0, 0.0).otherwise(F.col("_tp") / (F.col("_tp") + F.col("_fp")))
    f1 = F.when(2 * F.col("_tp") + F.col("_fp") + F.col("_fn") == 0, 0.0).otherwise(
        2 * F.col("_tp") / (2 * F.col("_tp") + F.col("_fp") + F.col("_fn")))
    return m.select(*keys, "accuracy", prec.alias("precision"), f1.alias("f1"))


def confusion(df: DataFrame, keys=("model",), label: str = "label", pred: str = "predicted_signal") -> DataFrame:
    """Confusion matrix as counts per (true, predicted)."""
    return df.groupBy(*keys, F.col(label).alias("true_label"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def best_model(metrics: DataFrame, keys=()) -> DataFrame:
    """I8: the model with the highest (accuracy, F1); of equal ones the smallest name."""
    g = metrics.groupBy(*keys) if keys else metrics.groupBy()
    return g.agg(F.min_by("model", F.struct(-F.col("accuracy"), -F.col("f1"), F.col("model"))).alias("best_model"),
                 F.max(F.struct("accuracy", "f1")).alias("_b")).select(*keys, "best_model",
                                                                       F.col("_b.accuracy").alias("accuracy"),
                                                                       F.col("_b.f1").alias("f1"))


def champion(runs: DataFrame, priority: list[str], default: str, mark: str = "is_champion") -> DataFrame:
    """The first model carrying the champion mark in a fixed priority
    order, else the default (a query on the runs table, no registry client)."""
    order = F.array_position(F.array(*[F.lit(m) for m in priority]), F.col("model"))
    c = runs.where(F.col(mark) & (order > 0)).agg(F.min_by("model", order).alias("m"))
    return c.select(F.coalesce("m", F.lit(default)).alias("champion"))


def feature_importance(spark: SparkSession, model: PipelineModel, features: list[str], top: int = 15) -> DataFrame:
    """The fitted ensemble's feature importances, top n (one value per feature)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(features, [float(v) for v in imp])), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(top)


def signal_summary(signals: DataFrame, keys=("model", "symbol")) -> DataFrame:
    """Total days, buy signals, other signals, and the last date / signal / confidence."""
    last = F.max_by(F.struct("predicted_signal", "confidence"), "date")
    return signals.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("predicted_signal") == 1).alias("buys"),
        F.count_if(F.col("predicted_signal") != 1).alias("others"), F.max("date").alias("last_date"),
        last.alias("_l")).select(*keys, "total", "buys", "others", "last_date",
                                 F.col("_l.predicted_signal").alias("last_signal"),
                                 F.col("_l.confidence").alias("last_confidence"))


def collapse_steps(seq: str | Column, n_features: int) -> Column:
    """Signed mean over the step axis of per-step values (array of
    structs with an ``x`` feature array) -> one value per feature."""
    s = F.col(seq) if isinstance(seq, str) else seq

    def add(j):
        return lambda acc, step: acc + step["x"][j]
    return F.array(*[F.aggregate(s, F.lit(0.0), add(j)) / F.size(s) for j in range(n_features)])
