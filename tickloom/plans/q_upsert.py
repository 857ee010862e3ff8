"""Incremental maintenance - newest-wins merges, stored upserts,
touched-symbol recompute, run replacement and day checkpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import rnd
from ..operators import indicators as ind
from ..operators import upsert as up
from ..operators.backtest import backtest_metrics, order_book
from ..operators.contracts import TRADING_SIGNALS
from ..session import scratch_path
from ..sources import fixtures as fx
from .oracle import with_views
from .q_backtest import metrics_ctes, ob_ctes
from .q_indicators import IND_CTES
from .q_sentiment import POSTS_CTES, clean_posts, daily_social
from .registry import register

BAR_COLS = ["open", "high", "low", "close", "volume"]


@register("c1_newest_batch_wins", with_views(["batches"], """
    SELECT symbol, date, arg_max(open, batch_seq) AS open, arg_max(high, batch_seq) AS high,
           arg_max(low, batch_seq) AS low, arg_max(close, batch_seq) AS close, arg_max(volume, batch_seq) AS volume,
           max(batch_seq) AS batch_seq
    FROM batches GROUP BY 1, 2"""))
def q_c1(spark, sf):
    m = up.newest_wins(fx.batches(spark, sf), ["symbol", "date"], "batch_seq", keep_seq=True)
    return m.select("symbol", "date", *BAR_COLS, "batch_seq")


def vix_batches(spark, sf):
    v = fx.vix(spark, sf)
    d = F.datediff("date", F.lit("1995-01-01").cast("date"))
    b1 = v.where(d % 3 != 0).withColumn("batch_seq", F.lit(1))
    b2 = v.where(d % 3 != 1).withColumn("close", F.when(d % 7 == 0, F.col("close") + 1).otherwise(F.col("close"))) \
          .withColumn("batch_seq", F.lit(2))
    return b1.unionByName(b2)


@register("c2_index_upsert", with_views(["vix"], """
    SELECT date, arg_max(close, batch_seq) AS close, max(batch_seq) AS batch_seq FROM (
      SELECT date, close, 1 AS batch_seq FROM vix WHERE date_diff('day', DATE '1995-01-01', date) % 3 <> 0
      UNION ALL
      SELECT date, CASE WHEN date_diff('day', DATE '1995-01-01', date) % 7 = 0 THEN close + 1 ELSE close END, 2
      FROM vix WHERE date_diff('day', DATE '1995-01-01', date) % 3 <> 1) GROUP BY date"""))
def q_c2(spark, sf):
    m = up.newest_wins(vix_batches(spark, sf), ["date"], "batch_seq", keep_seq=True)
    return m.select("date", "close", "batch_seq")


@register("c3_daily_sentiment_upsert", with_views(["posts"], """
    SELECT symbol, fecha_limpia, arg_max(volumen_posts, batch_seq) AS volumen_posts,
           round(arg_max(sentimiento_medio, batch_seq), 6) AS sentimiento_medio, max(batch_seq) AS batch_seq FROM (
      SELECT *, 1 AS batch_seq FROM social WHERE fecha_limpia <= DATE '1996-01-25'
      UNION ALL SELECT symbol, fecha_limpia, volumen_posts, sentimiento_medio + 0.01, sentimiento_std, 2
      FROM social WHERE fecha_limpia >= DATE '1996-01-20') GROUP BY 1, 2""", POSTS_CTES))
def q_c3(spark, sf):
    """Two daily-sentiment batches merged into a stored table (history
    absent at first -> plain write; then newest wins on (symbol, day))."""
    d = daily_social(spark, sf)
    b1 = d.where(F.col("fecha_limpia") <= "1996-01-25").withColumn("batch_seq", F.lit(1))
    b2 = (d.where(F.col("fecha_limpia") >= "1996-01-20")
          .withColumn("sentimiento_medio", F.col("sentimiento_medio") + 0.01).withColumn("batch_seq", F.lit(2)))
    root = scratch_path(spark, "daily_sentiment")
    up.upsert_table(spark, root, b1, ["symbol", "fecha_limpia"], unreadable_is_absent=True)
    t = up.upsert_table(spark, root, b2, ["symbol", "fecha_limpia"], unreadable_is_absent=True)
    return t.select("symbol", "fecha_limpia", "volumen_posts", rnd("sentimiento_medio", 6).alias("sentimiento_medio"),
                    "batch_seq")


@register("c4_signals_upsert_contract", with_views(["preds"], """
    SELECT model, symbol, date, round(arg_max(price_close, batch_seq), 6) AS price_close,
           arg_max(predicted_signal, batch_seq) AS predicted_signal,
           round(arg_max(confidence, batch_seq), 6) AS confidence FROM (
      SELECT model, symbol, date, price_close, predicted_signal, confidence, 1 AS batch_seq
      FROM preds WHERE date <= DATE '1999-12-31'
      UNION ALL
      SELECT model, symbol, date, price_close, CAST(1 - confidence > 0.5 AS INTEGER), 1 - confidence, 2
      FROM preds WHERE date >= DATE '1999-06-01') GROUP BY 1, 2, 3"""))
def q_c4(spark, sf):
    p = fx.preds(spark, sf).select("model", "symbol", "date", "price_close", "predicted_signal", "confidence")
    b1 = p.where(F.col("date") <= "1999-12-31").withColumn("batch_seq", F.lit(1))
    b2 = (p.where(F.col("date") >= "1999-06-01").withColumn("confidence", 1 - F.col("confidence"))
          .withColumn("predicted_signal", (F.col("confidence") > 0.5).cast("int")).withColumn("batch_seq", F.lit(2)))
    root = scratch_path(spark, "signals")
    keys = ["model", "symbol", "date"]
    up.upsert_table(spark, root, b1, keys, contract=TRADING_SIGNALS, stage="daily signals")
    t = up.upsert_table(spark, root, b2, keys, contract=TRADING_SIGNALS, stage="daily signals")
    return t.select("model", "symbol", "date", rnd("price_close", 6).alias("price_close"), "predicted_signal",
                    rnd("confidence", 6).alias("confidence"))


TOUCHED = ("AUTOMOBILE", "BUILDING")
_C5_MERGED = f"""
    SELECT symbol, date, arg_max(open, batch_seq) AS open, arg_max(high, batch_seq) AS high,
           arg_max(low, batch_seq) AS low, arg_max(close, batch_seq) AS close, arg_max(volume, batch_seq) AS volume
    FROM (SELECT * FROM batches WHERE batch_seq = 1
          UNION ALL SELECT * FROM batches WHERE batch_seq = 2 AND symbol IN {TOUCHED})
    WHERE symbol IN (SELECT DISTINCT symbol FROM batches WHERE batch_seq = 2 AND symbol IN {TOUCHED})
    GROUP BY 1, 2"""


@register("c5_recompute_touched_symbols", with_views(["batches"], """
    SELECT symbol, date, round(RSI, 6) AS RSI, round(SMA_10, 6) AS SMA_10, target_direction FROM ind""",
        [("merged", _C5_MERGED)] + [(n, q.replace("FROM bars", "FROM merged")) for n, q in IND_CTES]))
def q_c5(spark, sf):
    b = fx.batches(spark, sf)
    new = b.where((F.col("batch_seq") == 2) & F.col("symbol").isin(*TOUCHED))
    hist = up.newest_wins(b.where(F.col("batch_seq") == 1).unionByName(new), ["symbol", "date"])
    r = up.recompute_touched(hist, new, ind.with_indicators)
    return r.select("symbol", "date", rnd("RSI", 6).alias("RSI"), rnd("SMA_10", 6).alias("SMA_10"), "target_direction")


@register("c6_replace_matching_runs", with_views(["preds"], """
    SELECT model, symbol, start_date, end_date, round(strategy_return, 6) AS strategy_return,
           CASE WHEN model = 'm2' THEN 2 ELSE 1 END AS run
    FROM (SELECT met.*, s.start_date, s.end_date FROM met
          JOIN (SELECT min(date) AS start_date, max(date) AS end_date FROM preds) s ON true)""",
        ob_ctes(100_000.0, False) + metrics_ctes(100_000.0)))
def q_c6(spark, sf):
    """A comparison table of runs; a new run of one model replaces the rows
    with the same (model, symbol, start, end) and is appended."""
    p = fx.preds(spark, sf)
    start, end = p.select(F.min("date")).scalar(), p.select(F.max("date")).scalar()
    m = backtest_metrics(order_book(p, 100_000.0, first_row_position=False), 100_000.0)
    runs = m.select("model", "symbol", start.alias("start_date"), end.alias("end_date"),
                    rnd("strategy_return", 6).alias("strategy_return"))
    old = runs.withColumn("run", F.lit(1))
    new = runs.where(F.col("model") == "m2").withColumn("run", F.lit(2))
    return up.replace_matching(old, new, ["model", "symbol", "start_date", "end_date"])


@register("c7_skip_processed_days", with_views(["posts"], """
    SELECT symbol, fecha_limpia, count(*) AS posts FROM clean GROUP BY 1, 2""", POSTS_CTES))
def q_c7(spark, sf):
    """Day chunks with a checkpoint per day: the first pass writes the days
    up to 1996-01-20; the second run processes only the days without a
    chunk (anti-join) and adds them with dynamic partition overwrite."""
    c = clean_posts(spark, sf, labelled=False).select("tweet_id", "symbol", "fecha_limpia")
    path = scratch_path(spark, "day_chunks")
    up.write_days(c.where(F.col("fecha_limpia") <= "1996-01-20"), path)
    done = spark.read.parquet(path).select("fecha_limpia").distinct()
    todo = up.pending_days(c.select("fecha_limpia").distinct(), done, ["fecha_limpia"])
    up.write_days(c.join(todo, "fecha_limpia", "left_semi"), path)
    back = spark.read.parquet(path)
    return back.groupBy("symbol", "fecha_limpia").agg(F.count(F.lit(1)).alias("posts"))


@register("c8_consolidate_day_chunks", with_views(["posts"], """
    SELECT tweet_id, symbol, fecha_limpia FROM clean
    WHERE fecha_limpia BETWEEN DATE '1996-01-05' AND DATE '1996-01-25'""", POSTS_CTES))
def q_c8(spark, sf):
    c = clean_posts(spark, sf, labelled=False).select("tweet_id", "symbol", "fecha_limpia")
    path = scratch_path(spark, "chunks")
    up.write_days(c, path)
    r = up.consolidate(spark, path, "1996-01-05", "1996-01-25")
    return r.select("tweet_id", "symbol", "fecha_limpia")
