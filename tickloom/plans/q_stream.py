"""M1-M2: streaming maintenance of the daily sentiment table; each query
lands the scored posts as files in two deliveries and runs the stream after
each delivery (state and checkpoints carry over), then returns the table.
The oracle is the batch aggregate: stream equals batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import rnd as R
from ..session import scratch_path
from ..streaming import daily_sentiment as sd
from ..streaming import late_posts as lp
from .q_sentiment import POSTS_CTES, clean_posts
from .oracle import with_views
from .registry import register

G4_SQL = with_views(["posts"], """
    SELECT symbol, fecha_limpia, volumen_posts, round(sentimiento_medio, 6) AS sentimiento_medio,
           round(sentimiento_std, 6) AS sentimiento_std FROM social""", POSTS_CTES)

SPLIT_DAY = "1996-01-20"


def _scored(spark, sf):
    return clean_posts(spark, sf).select("tweet_id", "symbol", "fecha_utc", "fecha_limpia", "puntuacion_sentimiento")


def _out(df):
    return df.select("symbol", "fecha_limpia", "volumen_posts", R("sentimiento_medio", 6).alias("sentimiento_medio"),
                     R("sentimiento_std", 6).alias("sentimiento_std"))


@register("m1_incremental_daily_sentiment", G4_SQL)
def q_m1(spark, sf):
    """Second delivery = later days plus late posts (odd ids) of earlier
    days: those days are re-opened and recomputed exactly."""
    posts = _scored(spark, sf)
    work = scratch_path(spark, "m1")
    src = f"{work}/landing"
    first = (F.col("fecha_limpia") <= SPLIT_DAY) & (F.col("tweet_id").cast("bigint") % 2 == 0)
    posts.where(first).write.mode("append").parquet(src)
    sd.incremental_daily_sentiment(spark, src, posts.schema, work, max_files_per_trigger=4)
    posts.where(~first).write.mode("append").parquet(src)
    return _out(sd.incremental_daily_sentiment(spark, src, posts.schema, work, max_files_per_trigger=4))


@register("m2_event_time_daily_sentiment", G4_SQL)
def q_m2(spark, sf):
    """Deliveries in event-time order (nothing is later than the watermark)."""
    posts = _scored(spark, sf)
    work = scratch_path(spark, "m2")
    src = f"{work}/landing"
    early = F.col("fecha_limpia") <= SPLIT_DAY
    posts.where(early).write.mode("append").parquet(src)
    sd.event_time_daily_sentiment(spark, src, posts.schema, work)
    posts.where(~early).write.mode("append").parquet(src)
    return _out(sd.event_time_daily_sentiment(spark, src, posts.schema, work))


@register("m3_late_posts_by_state", with_views(["posts"], f"""
    SELECT symbol, fecha_limpia, volumen_posts, round(sentimiento_medio, 6) AS sentimiento_medio, round(sentimiento_std, 6) AS sentimiento_std,
           CAST(deliveries AS INTEGER) AS deliveries
    FROM social JOIN (SELECT symbol, fecha_limpia, count(DISTINCT fecha_limpia <= DATE '{SPLIT_DAY}' AND CAST(tweet_id AS BIGINT) % 2 = 0) AS deliveries
                      FROM clean GROUP BY 1, 2) USING (symbol, fecha_limpia)""", POSTS_CTES))
def q_m3(spark, sf):
    """M1's two deliveries, with the late posts merged into each day's state: no stored post is read
    again, and a day says how many deliveries brought it posts."""
    posts = _scored(spark, sf)
    work = scratch_path(spark, "m3")
    src = f"{work}/landing"
    first = (F.col("fecha_limpia") <= SPLIT_DAY) & (F.col("tweet_id").cast("bigint") % 2 == 0)
    posts.where(first).write.mode("append").parquet(src)
    lp.late_daily_sentiment(spark, src, posts.schema, work)
    posts.where(~first).write.mode("append").parquet(src)
    t = lp.late_daily_sentiment(spark, src, posts.schema, work)
    return t.select("symbol", "fecha_limpia", "volumen_posts", R("sentimiento_medio", 6).alias("sentimiento_medio"),
                    R("sentimiento_std", 6).alias("sentimiento_std"), "deliveries")
