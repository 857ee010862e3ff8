"""Structured Streaming maintenance of the daily sentiment table (M1, M2).

M1 - exact incremental: a file stream of scored posts is processed with
``foreachBatch``.  Each micro-batch is evaluated once, to store it under its own
epoch folder (overwrite, so a retried epoch is idempotent), in files sorted by
day: their day ranges prune the reads, and their number does not grow with the
days.  The days it touches are re-aggregated from the stored posts of those
days, and replace these days' rows in the next version of the daily table.  A
late post re-opens its day, as in the reference.

M2 - event time: the same daily aggregate as a windowed streaming
aggregation with a watermark; state for a day is dropped once the watermark
passes it, so posts later than the watermark are ignored (the bounded
variant of "a late post re-opens its day").
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sentiment import daily_sentiment
from ..operators.upsert import drop_versions, read_table_version, upsert_table

KEYS = ["symbol", "fecha_limpia"]
VERSIONS_KEPT = 2


def incremental_daily_sentiment(spark: SparkSession, source_dir: str, schema: T.StructType, work_dir: str,
                                max_files_per_trigger: int | None = None) -> DataFrame:
    """M1: run the stream over everything available now; return the daily table."""
    store, table, ckpt = f"{work_dir}/posts_store", f"{work_dir}/daily", f"{work_dir}/_checkpoint_m1"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    stored_schema = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])

    def process(batch: DataFrame, epoch_id: int) -> None:
        s = batch.sparkSession
        batch.sortWithinPartitions("fecha_limpia").write.mode("overwrite").parquet(f"{store}/epoch={epoch_id}")
        stored = s.read.schema(stored_schema).parquet(store)
        touched = stored.where(F.col("epoch") == epoch_id).select("fecha_limpia").distinct()
        span = touched.agg(F.min("fecha_limpia").alias("first"), F.max("fecha_limpia").alias("last")).first()
        # the range prunes files and pages by their statistics, the semi-join keeps the touched days
        posts = (stored.where(F.col("fecha_limpia").between(F.lit(span["first"]), F.lit(span["last"])))
                 .join(touched, "fecha_limpia", "left_semi"))
        upsert_table(s, table, daily_sentiment(posts).withColumn("batch_seq", F.lit(epoch_id)), KEYS)
        drop_versions(s, table, VERSIONS_KEPT)

    q = (stream.writeStream.foreachBatch(process).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_table_version(spark, table).drop("batch_seq")


def event_time_daily_sentiment(spark: SparkSession, source_dir: str, schema: T.StructType, work_dir: str,
                               watermark: str = "2 days") -> DataFrame:
    """M2: windowed daily aggregate with a watermark, update mode; every
    micro-batch's updated windows are merged newest-wins into a versioned
    table.  Returns the table (one row per symbol and day)."""
    table, ckpt = f"{work_dir}/daily_event_time", f"{work_dir}/_checkpoint_m2"
    stream = spark.readStream.schema(schema).parquet(source_dir)
    agg = (stream.withWatermark("fecha_utc", watermark)
           .groupBy(F.window("fecha_utc", "1 day").alias("w"), "symbol")
           .agg(F.count("puntuacion_sentimiento").alias("volumen_posts"),
                F.avg("puntuacion_sentimiento").alias("sentimiento_medio"),
                F.stddev_samp("puntuacion_sentimiento").alias("_std")))

    def process(batch: DataFrame, epoch_id: int) -> None:
        out = batch.select("symbol", F.to_date("w.start").alias("fecha_limpia"), "volumen_posts", "sentimiento_medio",
                           F.coalesce("_std", F.lit(0.0)).alias("sentimiento_std"),
                           F.lit(epoch_id).alias("batch_seq"))
        upsert_table(batch.sparkSession, table, out, KEYS)
        drop_versions(batch.sparkSession, table, VERSIONS_KEPT)

    q = (agg.writeStream.outputMode("update").foreachBatch(process).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_table_version(spark, table).drop("batch_seq")
