"""The news-tone query and its silver / dedup passes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import rnd as R
from ..operators import news as nw
from ..operators.contracts import GDELT_SENTIMENT, validate
from ..session import scratch_path
from ..sources.files import write_csv
from ..sources import scan_cost as sc
from ..sources import fixtures as fx
from .oracle import with_views
from .registry import register

START, END, KEYWORD = "2024-01-01", "2024-01-31", "Org 1"

TONE_SQL = """
    SELECT date AS fecha, count(1) AS volumen_noticias,
           round(avg(try_cast(split(v2tone, ',')[1] AS DOUBLE)), 3) AS sentimiento_promedio,
           round(avg(try_cast(split(v2tone, ',')[2] AS DOUBLE)), 3) AS puntuacion_positiva,
           round(avg(try_cast(split(v2tone, ',')[3] AS DOUBLE)), 3) AS puntuacion_negativa,
           round(avg(try_cast(split(v2tone, ',')[4] AS DOUBLE)), 3) AS polaridad_promedio,
           round(stddev_samp(try_cast(split(v2tone, ',')[1] AS DOUBLE)), 3) AS volatilidad_sentimiento,
           round(avg(try_cast(split(v2tone, ',')[5] AS DOUBLE)), 3) AS uso_primera_persona
    FROM news
    WHERE date BETWEEN DATE '{start}' AND DATE '{end}' AND lower(orgs) LIKE '%{kw}%' AND translationinfo IS NULL
    GROUP BY 1"""


def tone_cte(name="tone", start=START, end=END, kw=KEYWORD):
    return (name, TONE_SQL.format(start=start, end=end, kw=kw.lower()))


COMPANY_TONE = ("tone_s", TONE_SQL.split("FROM news")[0].replace("SELECT date AS fecha,", "SELECT symbol, date,") + """
    FROM company_news JOIN organisations ON contains(lower(orgs), lower(org))
    WHERE translationinfo IS NULL GROUP BY 1, 2""")


def company_tone(spark, sf):
    """Daily tone of each company's news over the bars' calendar."""
    rows = nw.company_rows(fx.company_news(spark, sf), fx.ORGANISATIONS)
    return nw.daily_tone(rows, keys=("symbol",))


def daily(spark, sf, start=START, end=END, kw=KEYWORD):
    return nw.daily_tone(nw.filter_news(fx.news(spark, sf), start, end, kw))


TONE_OUT = "SELECT * FROM tone"


@register("f1_f5_daily_news_tone", with_views(["news"], TONE_OUT, [tone_cte()]))
def q_f1_f5(spark, sf):
    return daily(spark, sf)


@register("f2_bound_parameter_sql", with_views(["news"], TONE_OUT, [tone_cte()]))
def q_f2(spark, sf):
    """The same query as SQL text with named, bound parameters."""
    return nw.daily_tone_sql(spark, fx.news(spark, sf), START, END, KEYWORD)


@register("f1_partition_pruned_scan", with_views(["news"], """
    SELECT date, count(*) AS n FROM news WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY 1"""))
def q_f1(spark, sf):
    """News stored partitioned by day in the shared folder; the range filter
    becomes a PartitionFilter, so only eight day directories are listed and read."""
    path = scratch_path(spark, "news_by_day")
    fx.news(spark, sf).write.mode("overwrite").partitionBy("date").parquet(path)
    back = spark.read.parquet(path)
    f = back.where(F.col("date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-12").cast("date")))
    return f.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@register("f1_scan_cost", with_views(["news"], """
    SELECT scope, count(DISTINCT date) AS days, true AS below_files, scope = 'range' AS in_budget FROM (
      SELECT 'table' AS scope, date FROM news UNION ALL
      SELECT 'range', date FROM news WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12') GROUP BY scope"""))
def q_f1c(spark, sf):
    """What the range's scan would read against the whole table's: the days its files belong to, whether the two columns are
    fewer bytes than the files, and whether it keeps a budget of half the table."""
    path = scratch_path(spark, "news_by_day")
    fx.news(spark, sf).write.mode("overwrite").partitionBy("date").parquet(path)
    whole, cols = spark.read.parquet(path), ["date", "v2tone"]
    ranged = whole.where(F.col("date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-12").cast("date")))
    budget = sc.scan_cost(whole, cols).agg(F.sum("column_bytes")).first()[0] // 2
    out = None
    for scope, scan in (("table", whole), ("range", ranged)):
        cost = sc.scan_cost(scan, cols).agg(
            F.count_distinct(F.regexp_extract("path", "date=([0-9-]+)", 1)).alias("days"),
            (F.sum("column_bytes") < F.sum("file_bytes")).alias("below_files"), (F.sum("column_bytes") <= budget).alias("in_budget"))
        cost = cost.select(F.lit(scope).alias("scope"), "days", "below_files", "in_budget")
        out = cost if out is None else out.unionByName(cost)
    return out


@register("f3_untranslated_only", with_views(["news"], """
    SELECT date, count(*) FILTER (WHERE translationinfo IS NULL) AS untranslated, count(*) AS total
    FROM news GROUP BY 1"""))
def q_f3(spark, sf):
    n = fx.news(spark, sf)
    return n.groupBy("date").agg(F.count_if(F.col("translationinfo").isNull()).alias("untranslated"),
                                 F.count(F.lit(1)).alias("total"))


@register("f4_safe_tone_split", with_views(["news"], """
    SELECT date, orgs, round(try_cast(split(v2tone, ',')[1] AS DOUBLE), 6) AS tone,
           round(try_cast(split(v2tone, ',')[2] AS DOUBLE), 6) AS pos,
           round(try_cast(split(v2tone, ',')[3] AS DOUBLE), 6) AS neg,
           round(try_cast(split(v2tone, ',')[4] AS DOUBLE), 6) AS polarity,
           round(try_cast(split(v2tone, ',')[5] AS DOUBLE), 6) AS selfref,
           round(try_cast(split(v2tone, ',')[9] AS DOUBLE), 6) AS missing_field
    FROM news"""))
def q_f4(spark, sf):
    n = fx.news(spark, sf)
    parts = {k: R(nw.tone_part("v2tone", i), 6).alias(k) for k, i in nw.TONE_FIELDS.items()}
    return n.select("date", "orgs", *parts.values(), R(nw.tone_part("v2tone", 8), 6).alias("missing_field"))


@register("f6_silver_pass", with_views(["news"], TONE_OUT, [tone_cte()]))
def q_f6(spark, sf):
    """Raw daily tone written as CSV with padded mixed-case headers and a
    timestamp day, read back, header stripped / lower-cased, day -> date, and
    the contract checked (missing columns and rows that break it raise; an empty
    result raises)."""
    raw = daily(spark, sf)
    raw = raw.select(F.col("fecha").cast("timestamp").alias(" Fecha "),
                     *[F.col(c).alias(c.capitalize()) for c in raw.columns if c != "fecha"])
    path = scratch_path(spark, "raw_tone_csv")
    write_csv(raw, path, bom=True)
    back = spark.read.option("header", True).option("inferSchema", False).csv(path)
    s = nw.silver(back)
    s = s.select("fecha", F.col("volumen_noticias").cast("bigint").alias("volumen_noticias"),
                 *[F.col(c).cast("double").alias(c) for c in nw.DAILY_COLS[1:]])
    validate(s, GDELT_SENTIMENT, "processed news tone")
    if s.isEmpty():
        raise ValueError("news tone query returned no rows")
    return s


@register("f7_dedup_keep_first", with_views(["news"], """
    SELECT fecha, arg_min(volumen_noticias, file_seq) AS volumen_noticias,
           arg_min(sentimiento_promedio, file_seq) AS sentimiento_promedio, min(file_seq) AS file_seq
    FROM (SELECT *, 1 AS file_seq FROM t1 UNION ALL SELECT *, 2 AS file_seq FROM t2) GROUP BY fecha""",
        [tone_cte("t1", "2024-01-01", "2024-01-20", "Org 1"), tone_cte("t2", "2024-01-10", "2024-01-31", "Org 2")]))
def q_f7(spark, sf):
    a = daily(spark, sf, "2024-01-01", "2024-01-20", "Org 1").withColumn("file_seq", F.lit(1))
    b = daily(spark, sf, "2024-01-10", "2024-01-31", "Org 2").withColumn("file_seq", F.lit(2))
    d = nw.dedup_keep_first(a.unionByName(b), "fecha", "file_seq")
    return d.select("fecha", "volumen_noticias", "sentimiento_promedio", "file_seq")
