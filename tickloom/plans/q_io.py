"""File sources and sinks, exercised as write / read round trips in the
shared folder over data derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import rnd
from ..session import scratch_path
from ..sources import files as io
from ..sources import fixtures as fx
from ..sources import paged
from .oracle import with_views
from .q_sentiment import POSTS_CTES, clean_posts
from .registry import register

FILES_PER_FOLDER = 8

BARS_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("symbol", T.StringType()), ("date", T.DateType()), ("close", T.DoubleType()), ("high", T.DoubleType()),
    ("low", T.DoubleType()), ("open", T.DoubleType()), ("volume", T.LongType())]])


@register("a1_read_csv_declared_schema", with_views(["bars"], "SELECT symbol, date, close, high, low, open, volume FROM bars"))
def q_a1(spark, sf):
    path = scratch_path(spark, "bars_csv")
    io.write_csv(fx.bars(spark, sf).select(*BARS_SCHEMA.fieldNames()), path)
    return io.read_csv(spark, path, BARS_SCHEMA)


@register("a2_read_csv_string_id", with_views(["posts"], """
    SELECT CAST(id + 100000000000000000 AS VARCHAR) AS tweet_id, symbol FROM posts"""))
def q_a2(spark, sf):
    """Ids beyond 2^53 survive a CSV round trip only when declared as strings."""
    p = fx.raw_posts(spark, sf).select((F.col("id") + 10 ** 17).cast("string").alias("tweet_id"), "symbol")
    path = scratch_path(spark, "ids_csv")
    io.write_csv(p, path)
    schema = T.StructType([T.StructField("tweet_id", T.StringType()), T.StructField("symbol", T.StringType())])
    return io.read_csv(spark, path, schema)


@register("a3_read_folders_union_by_name", with_views(["batches"], """
    SELECT symbol, date, close, volume, NULL::DOUBLE AS high FROM batches WHERE batch_seq = 1
    UNION ALL SELECT symbol, date, close, NULL::BIGINT AS volume, high FROM batches WHERE batch_seq = 2"""))
def q_a3(spark, sf):
    b = fx.batches(spark, sf)
    p1, p2 = scratch_path(spark, "batch1_csv"), scratch_path(spark, "batch2_csv")
    io.write_csv(b.where("batch_seq = 1").select("symbol", "date", "close", "volume"), p1)
    io.write_csv(b.where("batch_seq = 2").select("symbol", "high", "date", "close"), p2)
    s1 = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()),
                       T.StructField("close", T.DoubleType()), T.StructField("volume", T.LongType())])
    s2 = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("high", T.DoubleType()),
                       T.StructField("date", T.DateType()), T.StructField("close", T.DoubleType())])
    u = io.read_csv_union(spark, [(p1, s1), (p2, s2)])
    return u.select("symbol", "date", "close", "volume", "high")


@register("a4_write_table_roundtrip", with_views(["vix"], "SELECT date, close FROM vix"))
def q_a4(spark, sf):
    path = scratch_path(spark, "vix_parquet")
    io.write_table(fx.vix(spark, sf), path)
    return spark.read.parquet(path).select("date", "close")


@register("a5_partition_posts_by_day", with_views(["posts"], """
    SELECT CAST(substr(ts_text, 1, 10) AS DATE) AS solo_fecha, count(*) AS n,
           CAST(sum(length(text)) AS BIGINT) AS text_chars,
           (SELECT count(*) FROM posts WHERE try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') IS NULL) AS dropped
    FROM posts WHERE try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') IS NOT NULL GROUP BY 1"""))
def q_a5(spark, sf):
    raw = fx.raw_posts(spark, sf).select(F.col("id").cast("string").alias("ID_Tweet"), F.col("ts_text").alias("Fecha_UTC"),
                                     F.col("text").alias("Contenido_Texto"))
    path = scratch_path(spark, "posts_by_day")
    dropped = io.partition_by_day(raw, path, "Fecha_UTC", "yyyy-MM-dd HH:mm:ss")
    back = spark.read.option("header", True).option("multiLine", True).csv(path)
    return back.groupBy("solo_fecha").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum(F.length("Contenido_Texto")).alias("text_chars"),
                                          F.lit(dropped).cast("bigint").alias("dropped"))


@register("a6_raw_post_normalisation", with_views(["posts"], """
    SELECT CAST(id AS VARCHAR) AS ID_Tweet, coalesce(ts_text, '') AS Fecha_UTC,
           coalesce(CASE WHEN id % 7 = 0 THEN NULL ELSE text END, '') AS Contenido_Texto,
           coalesce(CAST(retweets AS VARCHAR), '0') AS Retweets, coalesce(CAST(favoritos AS VARCHAR), '0') AS Favoritos
    FROM posts"""))
def q_a6(spark, sf):
    p = fx.raw_posts(spark, sf).select(
        F.col("id"), F.col("ts_text").alias("published_time"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("text")).alias("text"),
        F.col("retweets").alias("reposts"), F.col("favoritos").alias("likes"))
    return io.normalise_raw_posts(p)


@register("a7_range_file_pruning", with_views(["bars"], """
    SELECT symbol, date, close, symbol || '_1997-03-14_1997-03-14' AS range_name FROM bars
    WHERE date >= DATE '1997-03-14' AND date < DATE '1997-03-15'
    UNION ALL
    SELECT symbol, date, close, symbol || '_1998-01-01_1998-02-01' FROM bars
    WHERE date >= DATE '1998-01-01' AND date < DATE '1998-02-01'"""))
def q_a7(spark, sf):
    b = fx.bars(spark, sf)
    out = None
    for s, e in (("1997-03-14", "1997-03-14"), ("1998-01-01", "1998-02-01")):
        part = b.where(io.in_range("date", s, e)).select(
            "symbol", "date", "close", io.range_name(F.col("symbol"), s, e).alias("range_name"))
        out = part if out is None else out.unionByName(part)
    return out


@register("a8_append_only_collection", with_views(["batches"], "SELECT symbol, date, close, batch_seq FROM batches"))
def q_a8(spark, sf):
    b = fx.batches(spark, sf).select("symbol", "date", "close", "batch_seq")
    path = scratch_path(spark, "appended_csv")
    io.append_rows(b.where("batch_seq = 1"), path)
    io.append_rows(b.where("batch_seq = 2"), path)
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()),
                           T.StructField("close", T.DoubleType()), T.StructField("batch_seq", T.IntegerType())])
    return io.read_csv(spark, path, schema)


@register("a9_params_from_file_name", with_views(["posts"], """
    SELECT symbol || '_X' AS ticker, min(fecha_limpia) AS start_date, max(fecha_limpia) AS end_date,
           lower(symbol) || '_x' AS safe_name, count(*) AS n
    FROM clean GROUP BY symbol""", POSTS_CTES))
def q_a9(spark, sf):
    """Posts written one folder per symbol named social_raw_TICKER_start_end
    (the ticker contains '_'); the parameters are recovered from each row's
    input file path."""
    c = clean_posts(spark, sf, labelled=False)
    rng = c.groupBy("symbol").agg(F.min("fecha_limpia").alias("s"), F.max("fecha_limpia").alias("e"))
    # one range for each symbol of the universe: a map in a scalar subquery, so the posts are not joined
    ranges = rng.select(F.map_from_entries(F.collect_list(F.struct("symbol", F.struct("s", "e"))))).scalar()
    own = F.try_element_at(ranges, F.col("symbol"))
    named = c.withColumn(
        "file_name", F.concat_ws("_", F.lit("social"), F.lit("raw"), F.concat(F.col("symbol"), F.lit("_X")),
                                 F.date_format(own["s"], "yyyyMMdd"), F.date_format(own["e"], "yyyyMMdd")))
    path = scratch_path(spark, "raw_named")
    salt = F.pmod(F.xxhash64("tweet_id"), F.lit(FILES_PER_FOLDER))
    (named.select("tweet_id", "file_name").repartition("file_name", salt).write.mode("overwrite")
     .partitionBy("file_name").parquet(path))
    back = spark.read.parquet(path).withColumn(
        "p", io.params_from_name(F.regexp_replace(io.source_file_dir(1), "^file_name=", "")))
    return back.groupBy("p.ticker", "p.start_date", "p.end_date", "p.safe_name").agg(F.count(F.lit(1)).alias("n"))


@register("a1_bars_numeric_roundtrip", with_views(["bars"], """
    SELECT symbol, round(sum(close), 2) AS sum_close, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY 1"""))
def q_a1b(spark, sf):
    path = scratch_path(spark, "bars_csv2")
    io.write_csv(fx.bars(spark, sf).select(*BARS_SCHEMA.fieldNames()), path)
    b = io.read_csv(spark, path, BARS_SCHEMA)
    return b.groupBy("symbol").agg(rnd(F.sum("close"), 2).alias("sum_close"), F.sum("volume").alias("volume"))


@register("a8_paged_collection", with_views(["posts"], """
    SELECT strftime(day, '%Y-%m-%d') AS day, CAST(id AS VARCHAR) AS id, text, CAST(favoritos AS VARCHAR) AS likes FROM (
      SELECT id, text, favoritos, DATE '1996-01-01' + CAST(floor(id / 25) AS INTEGER) AS day FROM posts)"""))
def q_a8b(spark, sf):
    """The posts served in pages of ten a day and collected again by following the cursors."""
    path = scratch_path(spark, "pages")
    p = fx.raw_posts(spark, sf)
    day = F.date_add(F.lit("1996-01-01").cast("date"), F.floor(F.col("id") / 25).cast("int")).cast("string")
    p = p.select(day.alias("day"), F.col("id").cast("string").alias("id"), F.col("ts_text").alias("published_time"), "text",
                 F.col("retweets").cast("string").alias("reposts"), F.col("favoritos").cast("string").alias("likes"))
    paged.write_pages(p, path, 10, [F.col("id").cast("bigint")])
    paged.register(spark)
    return spark.read.format("paged_posts").option("path", path).load().select("day", "id", "text", "likes")
