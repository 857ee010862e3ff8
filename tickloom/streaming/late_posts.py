"""M3: the daily sentiment kept as state, so that a late post re-opens its day.

Each symbol-day's state is the count, mean and squared deviations of its posts, the
number of deliveries that brought it some, and whether it is closed.  Posts are folded
into partial sums before the shuffle, so a hot symbol-day sends one row for each Arrow
batch, whatever its number of posts; partial sums merge exactly (Chan et al.), so no
stored post is ever read again and none is too late.

A day that has had no post for ``quiet`` is closed by a timer and says so; a late post opens
it again.  Time here is the time of arrival (of the micro-batch), which a watermark follows: no post
arrives late, so none is dropped, and a batch that is run again has the time it had.  The state of a symbol-day is a few numbers and is kept, so it grows with the calendar.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators.upsert import drop_versions, read_table_version, upsert_table
from .daily_sentiment import KEYS, VERSIONS_KEPT

# Keyed state with timers needs this store of Spark's.
STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTIAL = "symbol string, fecha_limpia date, n bigint, mean double, squares double"
DAY = PARTIAL + ", deliveries int, closed boolean"
STATE = "n bigint, mean double, squares double, deliveries int"


def merge(a: tuple[int, float, float], b: tuple[int, float, float]) -> tuple[int, float, float]:
    """Count, mean and squared deviations of two disjoint sets of scores, from those of each."""
    n = a[0] + b[0]
    if n == 0:
        return 0, 0.0, 0.0
    apart = b[1] - a[1]
    return n, a[1] + apart * b[0] / n, a[2] + b[2] + apart * apart * a[0] * b[0] / n


def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each symbol-day of a batch.  A NULL score makes no count; a NULL symbol is a symbol of its own."""
    for b in batches:
        g = b.groupby(["symbol", "fecha_limpia"], dropna=False)["puntuacion_sentimiento"]
        out = pd.DataFrame({"n": g.count(), "mean": g.mean().fillna(0.0)})
        out["squares"] = (g.var(ddof=0).fillna(0.0) * out["n"]).to_numpy()
        yield out.reset_index()[["symbol", "fecha_limpia", "n", "mean", "squares"]]


class OpenDays(StatefulProcessor):
    """Merges the partial sums of a symbol-day into its state, and closes it by a timer."""

    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", STATE)

    def row(self, key: tuple, closed: bool) -> pd.DataFrame:
        n, mean, squares, deliveries = self.sums.get()
        return pd.DataFrame({"symbol": [key[0]], "fecha_limpia": [key[1]], "n": [n], "mean": [mean], "squares": [squares],
                             "deliveries": [deliveries], "closed": [closed]})

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        n, mean, squares, deliveries = self.sums.get() if self.sums.exists() else (0, 0.0, 0.0, 0)
        arrived = 0
        for part in rows:
            arrived = max(arrived, int(part["arrived"].max().timestamp() * 1000))
            for x in zip(part["n"], part["mean"], part["squares"]):
                n, mean, squares = merge((n, mean, squares), (int(x[0]), float(x[1]), float(x[2])))
        self.sums.update((n, mean, squares, deliveries + 1))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(arrived + self.quiet_ms)
        yield self.row(key, closed=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        yield self.row(key, closed=True)

    def close(self) -> None:
        pass


def deviation(n: str = "n", squares: str = "squares"):
    """Sample standard deviation of the state, 0 for fewer than two scores."""
    return F.when(F.col(n) > 1, F.sqrt(F.col(squares) / (F.col(n) - 1))).otherwise(F.lit(0.0))


def late_daily_sentiment(spark: SparkSession, source_dir: str, schema: T.StructType, work_dir: str, quiet_ms: int = 3_600_000,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the stream over everything available now; return the daily table (KEYS, volumen_posts, sentimiento_medio,
    sentimiento_std, deliveries, closed).  Posts without a day take no part; a day whose scores are all
    NULL has volume 0 and a NULL mean.  A micro-batch that is run again merges into the state before it and
    writes the same rows."""
    table, checkpoint = f"{work_dir}/daily_late", f"{work_dir}/_checkpoint_m3"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    posts = reader.parquet(source_dir).where(F.col("fecha_limpia").isNotNull()).select(*KEYS, "puntuacion_sentimiento")
    days = (posts.mapInPandas(partial_sums, PARTIAL).withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "0 seconds")
            .groupBy(*KEYS).transformWithStateInPandas(OpenDays(quiet_ms), DAY, outputMode="Update", timeMode="EventTime"))

    def process(batch: DataFrame, epoch_id: int) -> None:
        # a timer and a post may both speak for a day in one batch: the post opens it
        last = batch.groupBy(*KEYS).agg(F.max_by(F.struct("n", "mean", "squares", "deliveries", "closed"),
                                                 F.struct("deliveries", ~F.col("closed"))).alias("d")).select(*KEYS, "d.*")
        out = last.select(*KEYS, F.col("n").alias("volumen_posts"), F.when(F.col("n") > 0, F.col("mean")).alias("sentimiento_medio"),
                          deviation().alias("sentimiento_std"), "deliveries", "closed", F.lit(epoch_id).alias("batch_seq"))
        upsert_table(batch.sparkSession, table, out, KEYS)
        drop_versions(batch.sparkSession, table, VERSIONS_KEPT)

    before = spark.conf.get(STORE_SETTING, None)
    spark.conf.set(STORE_SETTING, STORE)
    try:
        q = (days.writeStream.outputMode("update").foreachBatch(process).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(STORE_SETTING)
        else:
            spark.conf.set(STORE_SETTING, before)
    return read_table_version(spark, table).drop("batch_seq")
