"""Contracts, column hygiene and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import rnd
from ..operators import contracts as ct
from ..operators import features as fe
from ..operators import quality as qu
from ..sources import fixtures as fx
from ..sources.tables import read_table
from .oracle import with_views
from .q_features import indicator_table
from .q_indicators import IND_CTES
from .q_sentiment import POSTS_CTES, daily_social
from .registry import register


@register("b1_required_columns", with_views(["bars"], """
    SELECT symbol, m.given, m.missing, count(*) AS rows FROM bars
    CROSS JOIN (VALUES ('all', ''), ('no volume', 'volume'), ('no high, close', 'close, high')) m(given, missing) GROUP BY 1, 2, 3"""))
def q_b1(spark, sf):
    """The missing-column report of three frames: each frame's rows per symbol
    with the columns its check names as missing."""
    b = fx.bars(spark, sf)
    out = None
    for given, gone in (("all", []), ("no volume", ["volume"]), ("no high, close", ["high", "close"])):
        frame = b.drop(*gone)
        try:
            ct.require_columns(frame, ct.STOCK_PROCESSED, "silver bars")
            missing = []
        except ct.ContractError:
            missing = ct.missing_columns(frame, ct.STOCK_PROCESSED)
        part = frame.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")).select(
            "symbol", F.lit(given).alias("given"), F.lit(", ".join(sorted(missing))).alias("missing"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


RAW_POSTS_SQL = """
    SELECT CAST(id AS VARCHAR) AS ID_Tweet, ts_text AS Fecha_UTC, text AS Contenido_Texto,
           CASE WHEN id % 11 = 0 THEN 'n/a' WHEN id % 2 = 0 THEN CAST(retweets AS VARCHAR) || '.0'
                ELSE CAST(retweets AS VARCHAR) END AS Retweets,
           CASE WHEN id % 13 = 0 THEN CAST(favoritos AS VARCHAR) || '.5' ELSE CAST(favoritos AS VARCHAR) END AS Favoritos
    FROM posts"""


def raw_posts(spark, sf):
    p = fx.raw_posts(spark, sf)
    i = F.col("id")
    rt = (F.when(i % 11 == 0, F.lit("n/a")).when(i % 2 == 0, F.concat(F.col("retweets").cast("string"), F.lit(".0")))
          .otherwise(F.col("retweets").cast("string")))
    fv = F.when(i % 13 == 0, F.concat(F.col("favoritos").cast("string"), F.lit(".5"))).otherwise(
        F.col("favoritos").cast("string"))
    return p.select(i.cast("string").alias("ID_Tweet"), F.col("ts_text").alias("Fecha_UTC"),
                    F.col("text").alias("Contenido_Texto"), rt.alias("Retweets"), fv.alias("Favoritos"))


@register("b2_row_contract_violations", with_views(["posts"], """
    SELECT 'raw posts' AS stage, c AS column, CAST(n AS BIGINT) AS bad_rows FROM (
      SELECT 'ID_Tweet' AS c, count(*) FILTER (WHERE ID_Tweet IS NULL) AS n FROM raw
      UNION ALL SELECT 'Fecha_UTC', count(*) FILTER (WHERE Fecha_UTC IS NULL) FROM raw
      UNION ALL SELECT 'Contenido_Texto', 0
      UNION ALL SELECT 'Retweets', count(*) FILTER (WHERE Retweets IS NULL OR try_cast(Retweets AS DOUBLE) IS NULL
                                                     OR try_cast(Retweets AS DOUBLE) <> floor(try_cast(Retweets AS DOUBLE))) FROM raw
      UNION ALL SELECT 'Favoritos', count(*) FILTER (WHERE Favoritos IS NULL OR try_cast(Favoritos AS DOUBLE) IS NULL
                                                      OR try_cast(Favoritos AS DOUBLE) <> floor(try_cast(Favoritos AS DOUBLE))) FROM raw)""",
        [("raw", RAW_POSTS_SQL)]))
def q_b2(spark, sf):
    """Lax row-level typing: "5" and "5.0" pass as integers, "5.5" and "n/a"
    fail; one aggregate pass gives the violations per column."""
    return ct.violations(raw_posts(spark, sf), ct.SOCIAL_RAW, "raw posts")


@register("b3_lower_headers", with_views(["bars"], "SELECT symbol, date, close FROM bars"))
def q_b3(spark, sf):
    b = fx.bars(spark, sf).select(F.col("symbol").alias(" Symbol "), F.col("date").alias("DATE"),
                                  F.col("close").alias("Close "))
    return qu.lower_headers(b)


@register("b4_map_columns_add_missing", with_views(["posts"], """
    SELECT CAST(id AS VARCHAR) AS tweet_id, text AS contenido_texto, NULL::TIMESTAMP AS fecha_utc,
           NULL::BIGINT AS retweets, NULL::BIGINT AS favoritos, NULL::DATE AS fecha_limpia FROM posts"""))
def q_b4(spark, sf):
    p = fx.raw_posts(spark, sf).select(F.col("id").cast("string").alias("ID_Tweet"), F.col("text").alias("Contenido_Texto"))
    m = qu.map_columns(p, {"ID_Tweet": "tweet_id", "Contenido_Texto": "contenido_texto"}, ct.SOCIAL_PROCESSED)
    return m.select("tweet_id", "contenido_texto", "fecha_utc", "retweets", "favoritos", "fecha_limpia")


@register("b5_b6_b7_clean_posts", with_views(["posts"], """
    SELECT ID_Tweet AS tweet_id, try_strptime(Fecha_UTC, '%Y-%m-%d %H:%M:%S') AS fecha_utc,
           CAST(try_strptime(Fecha_UTC, '%Y-%m-%d %H:%M:%S') AS DATE) AS fecha_limpia,
           coalesce(try_cast(trunc(try_cast(Retweets AS DOUBLE)) AS BIGINT), 0) AS retweets,
           coalesce(try_cast(trunc(try_cast(Favoritos AS DOUBLE)) AS BIGINT), 0) AS favoritos
    FROM raw WHERE ID_Tweet IS NOT NULL AND Contenido_Texto IS NOT NULL
      AND try_strptime(Fecha_UTC, '%Y-%m-%d %H:%M:%S') IS NOT NULL""", [("raw", RAW_POSTS_SQL)]))
def q_b5_b7(spark, sf):
    r = raw_posts(spark, sf).withColumn("fecha_utc", qu.coerce_timestamp("Fecha_UTC", "yyyy-MM-dd HH:mm:ss"))
    r = qu.drop_null_keys(r, ["ID_Tweet", "fecha_utc", "Contenido_Texto"])
    return r.select(F.col("ID_Tweet").alias("tweet_id"), "fecha_utc", F.to_date("fecha_utc").alias("fecha_limpia"),
                    qu.counter("Retweets").alias("retweets"), qu.counter("Favoritos").alias("favoritos"))


@register("b8_text_one_line", """
    SELECT doc_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS n_chars
    FROM (SELECT doc_id, trim(regexp_replace(text, '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g')) AS t FROM documents)""")
def q_b8(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", qu.one_line("text").alias("t"))
    return d.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").alias("n_chars"))


@register("b9_count_from_label", with_views(["posts"], """
    SELECT id, coalesce(nullif(split(trim(coalesce(lbl, '')), ' ')[1], ''), '0') AS retweet_count
    FROM (SELECT id, CASE WHEN retweets IS NULL THEN '' ELSE '  ' || CAST(retweets AS VARCHAR) || ' retweets' END AS lbl FROM posts)"""))
def q_b9(spark, sf):
    p = fx.raw_posts(spark, sf)
    lbl = F.when(F.col("retweets").isNull(), F.lit("")).otherwise(
        F.concat(F.lit("  "), F.col("retweets").cast("string"), F.lit(" retweets")))
    return p.select("id", qu.count_from_label(lbl).alias("retweet_count"))


@register("b10_id_from_url", "SELECT page_id, string_split(url, '/')[-1] AS url_id FROM pages")
def q_b10(spark, sf):
    p = read_table(spark, sf, "pages").select("page_id", "url")
    return p.select("page_id", qu.id_from_url("url").alias("url_id"))


@register("b11_first_seen_dedup", """
    SELECT conv_id, arg_min(turn, turn) AS turn, arg_min(role, turn) AS role FROM conversations GROUP BY conv_id""")
def q_b11(spark, sf):
    c = read_table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return qu.first_seen(c, "conv_id", "turn").select("conv_id", "turn", "role")


@register("b12_drop_sparse_columns", with_views(["bars", "vix", "posts"], """
    SELECT symbol, date, close, VIX FROM (
      SELECT b.symbol, b.date, b.close, v.close AS VIX FROM bars b LEFT JOIN vix v ON b.date = v.date)
    WHERE close IS NOT NULL AND VIX IS NOT NULL""", POSTS_CTES))
def q_b12(spark, sf):
    a = fe.align_full(fx.bars(spark, sf), daily_social(spark, sf), fx.vix(spark, sf))
    return qu.drop_sparse_then_incomplete(a, 0.5).select("symbol", "date", "close", "VIX")


@register("b13_drop_incomplete_count", with_views(["bars"], """
    SELECT symbol, count(*) FILTER (WHERE RSI IS NOT NULL AND daily_return IS NOT NULL AND SMA_10 IS NOT NULL
                                     AND SMA_50 IS NOT NULL AND volatilidad_10d IS NOT NULL) AS kept,
           count(*) FILTER (WHERE RSI IS NULL OR daily_return IS NULL OR SMA_10 IS NULL
                                 OR SMA_50 IS NULL OR volatilidad_10d IS NULL) AS removed
    FROM ind GROUP BY symbol""", IND_CTES))
def q_b13(spark, sf):
    t = indicator_table(spark, sf)
    kept, removed = qu.drop_incomplete_with_count(t)
    k = kept.groupBy("symbol").agg(F.count(F.lit(1)).alias("kept"))
    r = t.groupBy("symbol").agg(removed.alias("removed"))
    return k.join(r, "symbol")


@register("b16_dataset_profile", with_views(["bars"], """
    SELECT symbol, min(date) AS start, max(date) AS "end", count(*) AS rows,
           round(datediff('day', min(date), max(date)) / 365.0, 6) AS years FROM bars GROUP BY 1"""))
def q_b16(spark, sf):
    p = qu.profile(fx.bars(spark, sf))
    return p.select("symbol", "start", "end", "rows", rnd("years", 6).alias("years"))


@register("b17_describe_close", with_views(["bars"], """
    SELECT symbol, count(close) AS count, round(avg(close), 4) AS mean, round(stddev_samp(close), 4) AS std,
           min(close) AS min, round(quantile_cont(close, 0.25), 4) AS p25, round(quantile_cont(close, 0.5), 4) AS p50,
           round(quantile_cont(close, 0.75), 4) AS p75, max(close) AS max FROM bars GROUP BY 1"""))
def q_b17(spark, sf):
    d = qu.describe(fx.bars(spark, sf), "close")
    return d.select("symbol", "count", rnd("mean", 4).alias("mean"), rnd("std", 4).alias("std"), "min",
                    rnd("p25", 4).alias("p25"), rnd("p50", 4).alias("p50"), rnd("p75", 4).alias("p75"), "max")

