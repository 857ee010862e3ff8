"""News-tone query.

The reference runs one SQL text against a date-partitioned news table.  Here it
is a Catalyst plan: the date range is a partition filter (pruned at the scan
when the table is stored partitioned by date), the keyword is a bound
parameter, and the daily aggregate is a partial + final hash aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Positions inside the comma-separated tone field, and what the day's row holds of
# them: (column, aggregate, field).
TONE_FIELDS = {"tone": 0, "pos": 1, "neg": 2, "polarity": 3, "selfref": 4}
DAILY_TONE = [
    ("sentimiento_promedio", F.avg, "tone"),
    ("puntuacion_positiva", F.avg, "pos"),
    ("puntuacion_negativa", F.avg, "neg"),
    ("polaridad_promedio", F.avg, "polarity"),
    ("volatilidad_sentimiento", F.stddev_samp, "tone"),
    ("uso_primera_persona", F.avg, "selfref"),
]
DAILY_COLS = ["volumen_noticias", *[name for name, _, _ in DAILY_TONE]]


def tone_part(v: str | Column, i: int) -> Column:
    """safe split / index / cast - NULL when the field is missing or not a number."""
    c = F.col(v) if isinstance(v, str) else v
    return F.get(F.split(c, ","), i).try_cast("double")


def filter_news(news: DataFrame, start: str, end: str, keyword: str) -> DataFrame:
    """Date range (partition predicate), case-insensitive organisation
    substring, and no machine-translated copies."""
    kw = F.lit(keyword.lower())
    return news.where(
        F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        & F.lower(F.col("orgs")).contains(kw)
        & F.col("translationinfo").isNull())


def company_rows(news: DataFrame, organisations: list[tuple[str, str]]) -> DataFrame:
    """The untranslated news of each company: a row for each ``symbol`` whose
    organisation it names (case-insensitive substring).  ``organisations`` is a
    parameter list (symbol, name); it is tested per row, without a join."""
    known = F.array(*[F.struct(F.lit(s).alias("symbol"), F.lit(o.lower()).alias("org")) for s, o in organisations])
    named = F.transform(F.filter(known, lambda x: F.lower(F.col("orgs")).contains(x["org"])), lambda x: x["symbol"])
    return news.where(F.col("translationinfo").isNull()).select("*", F.explode(named).alias("symbol"))


def daily_tone(news: DataFrame, digits: int = 3, keys=()) -> DataFrame:
    """per day (and key): count(*), 5 rounded means and a rounded sample std of the tone."""
    def rd(c):
        m = float(10 ** digits)
        return F.round(c * m, 0) / m
    t = news.select(*keys, F.col("date").alias("fecha"), *[tone_part("v2tone", i).alias(n) for n, i in TONE_FIELDS.items()])
    return t.groupBy(*keys, "fecha").agg(F.count(F.lit(1)).alias(DAILY_COLS[0]),
                                         *[rd(aggregate(field)).alias(name) for name, aggregate, field in DAILY_TONE])


def daily_tone_sql(spark: SparkSession, news: DataFrame, start: str, end: str, keyword: str) -> DataFrame:
    """the rows chosen by SQL text with bound parameters, then the same daily aggregate."""
    chosen = spark.sql("SELECT * FROM {news} WHERE date BETWEEN :first AND :last AND lower(orgs) LIKE :name AND translationinfo IS NULL",
                       news=news, args={"first": dt.date.fromisoformat(start), "last": dt.date.fromisoformat(end), "name": f"%{keyword.lower()}%"})
    return daily_tone(chosen)


def silver(raw: DataFrame) -> DataFrame:
    """header strip/lower-case and timestamp -> date."""
    df = raw.toDF(*[c.lstrip("\ufeff").strip().lower() for c in raw.columns])
    return df.withColumn("fecha", F.to_date(F.col("fecha")))


def dedup_keep_first(df: DataFrame, key: str = "fecha", order: str = "file_seq") -> DataFrame:
    """several overlapping files sorted by date, first occurrence of a date
    wins.  ``min_by`` over a struct is a partial aggregate: copies of a hot
    date are combined map-side before the shuffle."""
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*cols), F.col(order)).alias("_r")).select(key, "_r.*")
