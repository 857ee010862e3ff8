"""Joins and feature assembly.

The volatility index is keyed by date only (one row per day, bounded by the
calendar): it joins every symbol's bars on ``date``.  The join strategy is left
to AQE, which turns the shuffle join into a broadcast join from the runtime
size of the finished small side (a checked size, not a guess).  News tone and
social sentiment are keyed by (symbol, date).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import nan_to_null, series_window

# News-tone sentiment columns (+ the score alias).
NEWS_COLS = ["volumen_noticias", "sentimiento_promedio", "puntuacion_positiva", "puntuacion_negativa",
             "polaridad_promedio", "volatilidad_sentimiento", "uso_primera_persona"]
SENTIMENT_COLS = ["sentimiento_promedio", "volumen_noticias", "volatilidad_sentimiento", "sentiment_score",
                  "puntuacion_positiva", "puntuacion_negativa", "polaridad_promedio", "uso_primera_persona"]
# The 30 scoring features, in model order.
SCORING_FEATURES = [
    "close", "high", "low", "open", "volume", "RSI", "daily_return", "SMA_10", "SMA_50", "volatilidad_10d",
    "VIX", "volumen_noticias", "sentimiento_promedio", "puntuacion_positiva", "puntuacion_negativa",
    "polaridad_promedio", "volatilidad_sentimiento", "uso_primera_persona", "day_of_week", "month", "quarter",
    "year", "day_of_month", "week_of_year", "month_sin", "month_cos", "day_sin", "day_cos",
    "sentiment_volume_interaction", "vix_rsi_interaction",
]
CALENDAR_COLS = ["day_of_week", "month", "quarter", "year", "day_of_month", "week_of_year", "month_sin", "month_cos",
                 "day_sin", "day_cos"]
# Columns removed for the "traditional" (no sentiment) variant.
SOCIAL_COLS = ["fecha", "volumen_noticias", "sentimiento_promedio", "puntuacion_positiva", "puntuacion_negativa",
               "polaridad_promedio", "volatilidad_sentimiento", "uso_primera_persona", "sentiment_volume_interaction"]


def join_vix(bars: DataFrame, vix: DataFrame) -> DataFrame:
    """Bars left-join the index close (renamed VIX) on date."""
    return bars.join(vix.select("date", F.col("close").alias("VIX")), "date", "left")


def join_news(df: DataFrame, tone: DataFrame | None, keys=("symbol",)) -> DataFrame:
    """Left-join the company's daily news tone on (symbol, date); when
    the source is absent every sentiment column is the constant 0.0."""
    if tone is None:
        return df.withColumns({c: F.lit(0.0) for c in NEWS_COLS + ["sentiment_score"]})
    t = tone.select(*keys, F.col("fecha").alias("date"), *NEWS_COLS)
    return df.join(t, [*keys, "date"], "left")


def join_social(df: DataFrame, daily: DataFrame | None, keys=("symbol",)) -> DataFrame:
    """E4 (+E3): map social aggregates onto the news columns and left-join on
    (symbol, date): mean -> sentimiento_promedio and sentiment_score, count ->
    volumen_noticias, std -> volatilidad_sentimiento, the other four 0.0."""
    if daily is None:
        return df.withColumns({c: F.lit(0.0) for c in SENTIMENT_COLS})
    s = daily.select(*keys, F.col("fecha_limpia").alias("date"),
                     F.col("sentimiento_medio").alias("sentimiento_promedio"),
                     F.col("volumen_posts").cast("double").alias("volumen_noticias"),
                     F.col("sentimiento_std").alias("volatilidad_sentimiento"),
                     F.col("sentimiento_medio").alias("sentiment_score"),
                     *[F.lit(0.0).alias(c) for c in ("puntuacion_positiva", "puntuacion_negativa",
                                                     "polaridad_promedio", "uso_primera_persona")])
    return df.join(s, [*keys, "date"], "left")


def align_full(bars: DataFrame, sentiment: DataFrame, vix: DataFrame, keys=("symbol",)) -> DataFrame:
    """E5: full outer alignment of price, sentiment and index on the date,
    keeping only rows that have a close."""
    s = sentiment.select(*keys, F.col("fecha_limpia").alias("date"),
                         F.col("sentimiento_medio").alias("sentimiento_promedio"),
                         F.col("sentimiento_std").alias("volatilidad_sentimiento"))
    j = bars.join(s, [*keys, "date"], "full")
    j = j.join(vix.select("date", F.col("close").alias("VIX")), "date", "full")
    return j.where(F.col("close").isNotNull())


def calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """day_of_week (Monday = 0), month, quarter, year, day_of_month, ISO week."""
    d = F.col(date)
    return df.withColumns({"day_of_week": F.weekday(d), "month": F.month(d), "quarter": F.quarter(d),
                           "year": F.year(d), "day_of_month": F.dayofmonth(d), "week_of_year": F.weekofyear(d)})


def cyclic(df: DataFrame) -> DataFrame:
    """Sin / cos of 2*pi*month/12 and 2*pi*day_of_week/7."""
    two_pi = 2 * math.pi
    m = F.lit(two_pi) * F.col("month") / 12
    w = F.lit(two_pi) * F.col("day_of_week") / 7
    return df.withColumns({"month_sin": F.sin(m), "month_cos": F.cos(m), "day_sin": F.sin(w), "day_cos": F.cos(w)})


def interactions(df: DataFrame) -> DataFrame:
    """sentimiento_promedio x volume and VIX x RSI / 100."""
    return df.withColumns({
        "sentiment_volume_interaction": F.col("sentimiento_promedio") * F.col("volume"),
        "vix_rsi_interaction": F.col("VIX") * F.col("RSI") / 100})


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with any NULL or NaN."""
    return df.dropna("any")


def training_features(indicators: DataFrame, vix: DataFrame, tone: DataFrame | None) -> DataFrame:
    """Indicators -> E1 -> E2/E3 -> E6-E8 -> drop incomplete rows.  SMA_50
    removes the first 49 rows of each symbol; a day without news is dropped."""
    df = join_news(join_vix(indicators, vix), tone)
    return drop_incomplete(interactions(cyclic(calendar(df))))


def fill_both_ways(df: DataFrame, cols: list[str], keys=("symbol",)) -> DataFrame:
    """Backward fill then forward fill by date within each symbol: the
    next non-null value, else the last one - all columns in one projection over
    two frames of the same window."""
    # Both fills use growing frames (unbounded preceding .. current row), which
    # Spark evaluates incrementally; the backward fill runs over the reversed
    # order instead of a shrinking "current .. unbounded following" frame,
    # which would be re-aggregated for every row (quadratic per symbol).
    behind = series_window(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = (Window.partitionBy(*keys).orderBy(F.col("date").desc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    kinds = dict(df.dtypes)

    def filled(c: str) -> Column:
        x = nan_to_null(c) if kinds[c] in ("double", "float") else F.col(c)
        return F.coalesce(x, F.last(x, ignorenulls=True).over(ahead), F.last(x, ignorenulls=True).over(behind))
    return df.withColumns({c: filled(c) for c in cols})


def scoring_features(indicators: DataFrame, vix: DataFrame, daily: DataFrame | None,
                     keys=("symbol",)) -> DataFrame:
    """E1 -> E4/E3 -> fill sentiment with 0 (B15) -> E6-E8 -> B14 fill;
    the label's NULLs become 0.  Fills instead of dropping."""
    df = join_social(join_vix(indicators, vix), daily, keys)
    df = df.fillna(0.0, subset=SENTIMENT_COLS)
    df = interactions(cyclic(calendar(df)))
    # what the calendar gives and what B15 filled cannot be missing
    never = {*keys, "date", *SENTIMENT_COLS, *CALENDAR_COLS}
    fill = [c for c in df.columns if c not in never]
    df = fill_both_ways(df, fill, keys)
    if "target_direction" in df.columns:
        df = df.withColumn("target_direction", F.coalesce("target_direction", F.lit(0)))
    return df


def scoring_vector_columns(df: DataFrame) -> DataFrame:
    """The fixed 30-column feature order used for scoring."""
    return df.select(*SCORING_FEATURES)


def drop_social(df: DataFrame) -> DataFrame:
    """The traditional variant without social / news columns."""
    return df.drop(*[c for c in SOCIAL_COLS if c in df.columns])


def numeric_only(df: DataFrame) -> DataFrame:
    """Keep numeric columns."""
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])


def keep_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Listed columns that exist, in list order."""
    return df.select(*[c for c in cols if c in df.columns])


def class_balance(df: DataFrame, label: str = "target_direction", keys=("symbol",)) -> DataFrame:
    """Share of positive labels."""
    return df.groupBy(*keys).agg(F.avg(label).alias("class_balance"), F.count(F.lit(1)).alias("rows"))


def slice_or_latest(df: DataFrame, start: str, end: str, keys=("symbol",)) -> DataFrame:
    """E15 (scoring): inclusive date range; a symbol with no row inside the
    range falls back to its latest row."""
    d = F.col("date")
    inside = d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    whole = Window.partitionBy(*keys)
    marked = df.withColumns({"_inside": inside.cast("int"), "_last": F.max("date").over(whole)})
    marked = marked.withColumn("_any", F.max("_inside").over(whole))
    keep = (F.col("_inside") == 1) | ((F.col("_any") == 0) & (F.col("date") == F.col("_last")))
    return marked.where(keep).drop("_inside", "_last", "_any")
