import datetime as dt

from tickloom.session import scratch_path
from tickloom.streaming import daily_sentiment as sd

SCHEMA = "tweet_id string, symbol string, fecha_utc timestamp, fecha_limpia date, puntuacion_sentimiento double"


def posts(spark, rows):
    data = [(str(i), "S", dt.datetime(2026, 3, d, 12), dt.date(2026, 3, d), s) for i, d, s in rows]
    return spark.createDataFrame(data, SCHEMA)


def as_map(df):
    return {r["fecha_limpia"].day: (r["volumen_posts"], round(r["sentimiento_medio"], 6)) for r in df.collect()}


def test_incremental_reopens_a_day(spark):
    work = scratch_path(spark, "t_m1")
    src = f"{work}/landing"
    first = posts(spark, [(1, 1, 0.2), (2, 1, 0.4), (3, 10, 0.9)])
    first.write.mode("append").parquet(src)
    t1 = as_map(sd.incremental_daily_sentiment(spark, src, first.schema, work))
    assert t1 == {1: (2, 0.3), 10: (1, 0.9)}
    late = posts(spark, [(4, 1, 0.9), (5, 11, 0.1)])        # a late post for day 1
    late.write.mode("append").parquet(src)
    t2 = as_map(sd.incremental_daily_sentiment(spark, src, first.schema, work))
    assert t2 == {1: (3, 0.5), 10: (1, 0.9), 11: (1, 0.1)}


def test_event_time_drops_posts_behind_the_watermark(spark):
    work = scratch_path(spark, "t_m2")
    src = f"{work}/landing"
    first = posts(spark, [(1, 1, 0.2), (2, 10, 0.4)])
    first.write.mode("append").parquet(src)
    sd.event_time_daily_sentiment(spark, src, first.schema, work, watermark="2 days")
    # watermark is now day 10 - 2 days; a post for day 1 is too late, day 9 is not
    posts(spark, [(3, 1, 0.9), (4, 9, 0.6)]).write.mode("append").parquet(src)
    t = as_map(sd.event_time_daily_sentiment(spark, src, first.schema, work, watermark="2 days"))
    assert t[1] == (1, 0.2)
    assert t[9] == (1, 0.6) and t[10] == (1, 0.4)


def test_incremental_files_do_not_grow_with_the_days(spark):
    import glob
    work = scratch_path(spark, "t_m1_files")
    src = f"{work}/landing"
    for part in (0, 1):
        df = spark.range(600).selectExpr("cast(id as string) AS tweet_id", "'S' AS symbol", "timestamp'2026-01-01 12:00:00' AS fecha_utc",
                                         "date_add(date'2026-01-01', cast(id % 300 as int)) AS fecha_limpia",
                                         f"cast(id % 2 + {part} as double) AS puntuacion_sentimiento")
        df.coalesce(2).write.mode("append").parquet(src)
        t = sd.incremental_daily_sentiment(spark, src, df.schema, work)
    assert t.count() == 300 and {r[0] for r in t.select("volumen_posts").distinct().collect()} == {4}
    assert len(glob.glob(f"{work}/posts_store/**/*.parquet", recursive=True)) <= 8
    assert len(glob.glob(f"{work}/daily/**/*.parquet", recursive=True)) < 100
