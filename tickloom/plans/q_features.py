"""Feature assembly (training and scoring tables) and column utilities."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.exprs import rnd
from ..operators import features as fe
from ..operators import indicators as ind
from ..operators.contracts import ENGINEERED_FEATURES, validate
from ..session import materialize
from ..sources import fixtures as fx
from .oracle import dbl, with_views
from .q_indicators import IND_CTES
from .q_news import COMPANY_TONE, company_tone
from .q_sentiment import POSTS_CTES, daily_social
from .registry import register

TWO_PI = dbl(2 * math.pi)

NEWS7 = fe.NEWS_COLS


def indicator_table(spark, sf):
    return ind.with_indicators(fx.bars(spark, sf))


def train_table(spark, sf):
    return fe.training_features(indicator_table(spark, sf), fx.vix(spark, sf), company_tone(spark, sf))


def score_table(spark, sf):
    return fe.scoring_features(indicator_table(spark, sf), fx.vix(spark, sf), daily_social(spark, sf))


# --------------------------------------------------------------- SQL twins

CAL_SQL = """CAST(isodow(i.date) - 1 AS INTEGER) AS day_of_week, CAST(month(i.date) AS INTEGER) AS month,
             CAST(quarter(i.date) AS INTEGER) AS quarter, CAST(year(i.date) AS INTEGER) AS year,
             CAST(day(i.date) AS INTEGER) AS day_of_month, CAST(weekofyear(i.date) AS INTEGER) AS week_of_year"""
CYC_SQL = f"""sin({TWO_PI} * month / 12) AS month_sin, cos({TWO_PI} * month / 12) AS month_cos,
              sin({TWO_PI} * day_of_week / 7) AS day_sin, cos({TWO_PI} * day_of_week / 7) AS day_cos,
              sentimiento_promedio * volume AS sentiment_volume_interaction, VIX * RSI / 100 AS vix_rsi_interaction"""

# Columns of the training table, in order.
TRAIN_COLS = (["symbol", "date", "open", "high", "low", "close", "volume", "RSI", "daily_return", "SMA_10",
               "SMA_50", "volatilidad_10d", "target_direction", "VIX"] + NEWS7
              + ["day_of_week", "month", "quarter", "year", "day_of_month", "week_of_year",
                 "month_sin", "month_cos", "day_sin", "day_cos", "sentiment_volume_interaction",
                 "vix_rsi_interaction"])

TRAIN_CTES = [COMPANY_TONE] + IND_CTES + [
    ("ft0", f"""SELECT i.*, v.close AS VIX, {', '.join('t.' + c for c in NEWS7)}, {CAL_SQL}
               FROM ind i LEFT JOIN vix v ON i.date = v.date LEFT JOIN tone_s t ON i.symbol = t.symbol AND i.date = t.date"""),
    ("ft1", f"SELECT *, {CYC_SQL} FROM ft0"),
    ("feat", "SELECT * FROM ft1 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in TRAIN_COLS)),
]

# Output rounding per column (None = exact).
DIGITS = {"RSI": 6, "daily_return": 8, "SMA_10": 6, "SMA_50": 6, "volatilidad_10d": 8, "month_sin": 8,
          "month_cos": 8, "day_sin": 8, "day_cos": 8, "sentiment_volume_interaction": 4, "vix_rsi_interaction": 6,
          "sentimiento_promedio": 6, "volatilidad_sentimiento": 6, "sentiment_score": 6, "volumen_noticias": 6}


def out_spark(df, cols):
    return df.select(*[rnd(c, DIGITS[c]).alias(c) if c in DIGITS else F.col(c) for c in cols])


def out_sql(cols, src):
    return "SELECT " + ", ".join(f"round(CAST({c} AS DOUBLE), {DIGITS[c]}) AS {c}" if c in DIGITS else c
                                 for c in cols) + f" FROM {src}"


def train_sql(body):
    return with_views(["bars", "vix", "company_news", "organisations"], body, TRAIN_CTES)


@register("e9_training_features", train_sql(out_sql(TRAIN_COLS, "feat")))
def q_e9(spark, sf):
    t = train_table(spark, sf)
    return out_spark(t, TRAIN_COLS)


@register("e9_contract_checked", train_sql(out_sql(["symbol", "date", "close", "VIX"], "feat")))
def q_e9c(spark, sf):
    """E9 followed by the B1/B2 contract (strict) of the engineered-features row model."""
    t = materialize(spark, train_table(spark, sf).withColumn("sentiment_score", F.lit(None).cast("double")))
    validate(t, ENGINEERED_FEATURES, "engineered_features")
    return out_spark(t, ["symbol", "date", "close", "VIX"])


@register("e1_join_vix", with_views(["bars", "vix"], """
    SELECT b.symbol, b.date, b.close, v.close AS VIX FROM bars b LEFT JOIN vix v ON b.date = v.date"""))
def q_e1(spark, sf):
    return fe.join_vix(fx.bars(spark, sf), fx.vix(spark, sf)).select("symbol", "date", "close", "VIX")


@register("e2_join_news_tone", with_views(["bars", "company_news", "organisations"], """
    SELECT b.symbol, b.date, t.volumen_noticias, t.sentimiento_promedio, t.volatilidad_sentimiento
    FROM bars b LEFT JOIN tone_s t ON b.symbol = t.symbol AND b.date = t.date""", [COMPANY_TONE]))
def q_e2(spark, sf):
    j = fe.join_news(fx.bars(spark, sf), company_tone(spark, sf))
    return j.select("symbol", "date", "volumen_noticias", "sentimiento_promedio", "volatilidad_sentimiento")


@register("e3_absent_sentiment_constants", with_views(["bars"], "SELECT symbol, date, "
                                                      + ", ".join(f"0.0::DOUBLE AS {c}" for c in NEWS7 + ["sentiment_score"])
                                                      + " FROM bars"))
def q_e3(spark, sf):
    j = fe.join_news(fx.bars(spark, sf), None)
    return j.select("symbol", "date", *NEWS7, "sentiment_score")


SOCIAL_JOIN_SQL = """
    SELECT b.symbol, b.date, s.sentimiento_medio AS sentimiento_promedio, CAST(s.volumen_posts AS DOUBLE) AS volumen_noticias,
           s.sentimiento_std AS volatilidad_sentimiento, s.sentimiento_medio AS sentiment_score,
           CASE WHEN s.symbol IS NULL THEN NULL ELSE 0.0::DOUBLE END AS puntuacion_positiva
    FROM bars b LEFT JOIN social s ON b.symbol = s.symbol AND b.date = s.fecha_limpia"""


@register("e4_join_social_mapped", with_views(["bars", "posts"], out_sql(
        ["symbol", "date", "sentimiento_promedio", "volumen_noticias", "volatilidad_sentimiento", "sentiment_score",
         "puntuacion_positiva"], "j"), POSTS_CTES + [("j", SOCIAL_JOIN_SQL)]))
def q_e4(spark, sf):
    j = fe.join_social(fx.bars(spark, sf), daily_social(spark, sf))
    return out_spark(j, ["symbol", "date", "sentimiento_promedio", "volumen_noticias", "volatilidad_sentimiento",
                         "sentiment_score", "puntuacion_positiva"])


@register("e5_full_outer_alignment", with_views(["bars", "vix", "posts"], """
    SELECT symbol, date, close, round(sentimiento_promedio, 6) AS sentimiento_promedio,
           round(volatilidad_sentimiento, 6) AS volatilidad_sentimiento, VIX FROM (
      SELECT coalesce(bs.date, v.date) AS date, bs.symbol, bs.close, bs.sentimiento_promedio,
             bs.volatilidad_sentimiento, v.close AS VIX
      FROM (SELECT coalesce(b.symbol, s.symbol) AS symbol, coalesce(b.date, s.fecha_limpia) AS date, b.close,
                   s.sentimiento_medio AS sentimiento_promedio, s.sentimiento_std AS volatilidad_sentimiento
            FROM bars b FULL JOIN social s ON b.symbol = s.symbol AND b.date = s.fecha_limpia) bs
      FULL JOIN vix v ON bs.date = v.date)
    WHERE close IS NOT NULL""", POSTS_CTES))
def q_e5(spark, sf):
    a = fe.align_full(fx.bars(spark, sf), daily_social(spark, sf), fx.vix(spark, sf))
    return a.select("symbol", "date", "close", rnd("sentimiento_promedio", 6).alias("sentimiento_promedio"),
                    rnd("volatilidad_sentimiento", 6).alias("volatilidad_sentimiento"), "VIX")


@register("e6_e8_calendar_cyclic_interactions", train_sql(out_sql(
        ["symbol", "date", "day_of_week", "month", "quarter", "year", "day_of_month", "week_of_year", "month_sin",
         "month_cos", "day_sin", "day_cos", "vix_rsi_interaction"], "ft1")))
def q_e6_e8(spark, sf):
    df = fe.join_vix(indicator_table(spark, sf), fx.vix(spark, sf)).withColumn("sentimiento_promedio", F.lit(0.0))
    df = fe.interactions(fe.cyclic(fe.calendar(df)))
    return out_spark(df, ["symbol", "date", "day_of_week", "month", "quarter", "year", "day_of_month", "week_of_year",
                          "month_sin", "month_cos", "day_sin", "day_cos", "vix_rsi_interaction"])


# Filled columns that are compared, and the columns E16 asks for.
FILL_COLS = ["RSI", "daily_return", "SMA_10", "SMA_50", "volatilidad_10d", "VIX", "sentimiento_promedio",
             "volumen_noticias", "volatilidad_sentimiento", "sentiment_score", "puntuacion_positiva"]
SCORE_OUT = ["symbol", "date"] + FILL_COLS + ["target_direction"]


def _fill(c):
    return (f"coalesce({c}, first_value({c} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), "
            f"last_value({c} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS {c}")


SENT8 = fe.SENTIMENT_COLS
SCORE_CTES = IND_CTES + POSTS_CTES + [
    ("sc0", f"""SELECT i.*, v.close AS VIX,
                  coalesce(s.sentimiento_medio, 0.0) AS sentimiento_promedio,
                  coalesce(CAST(s.volumen_posts AS DOUBLE), 0.0) AS volumen_noticias,
                  coalesce(s.sentimiento_std, 0.0) AS volatilidad_sentimiento,
                  coalesce(s.sentimiento_medio, 0.0) AS sentiment_score,
                  0.0::DOUBLE AS puntuacion_positiva, 0.0::DOUBLE AS puntuacion_negativa,
                  0.0::DOUBLE AS polaridad_promedio, 0.0::DOUBLE AS uso_primera_persona, {CAL_SQL}
           FROM ind i LEFT JOIN vix v ON i.date = v.date
           LEFT JOIN social s ON i.symbol = s.symbol AND i.date = s.fecha_limpia"""),
    ("sc1", f"SELECT *, {CYC_SQL} FROM sc0"),
    ("scored", "SELECT symbol, date, open, high, low, close, volume, puntuacion_negativa, polaridad_promedio, "
               "uso_primera_persona, day_of_week, month, quarter, year, day_of_month, week_of_year, "
               "month_sin, month_cos, day_sin, day_cos, "
               + ", ".join(_fill(c) for c in FILL_COLS + ["sentiment_volume_interaction", "vix_rsi_interaction"])
               + ", coalesce(target_direction, 0) AS target_direction FROM sc1"),
]


def score_sql(body):
    return with_views(["bars", "vix", "posts"], body, SCORE_CTES)


@register("e10_scoring_features", score_sql(out_sql(SCORE_OUT, "scored")))
def q_e10(spark, sf):
    return out_spark(score_table(spark, sf), SCORE_OUT)


@register("b14_backward_forward_fill", score_sql(out_sql(["symbol", "date", "RSI", "SMA_50", "volatilidad_10d"], "scored")))
def q_b14(spark, sf):
    return out_spark(score_table(spark, sf), ["symbol", "date", "RSI", "SMA_50", "volatilidad_10d"])


@register("b15_fill_sentiment_zero", score_sql(out_sql(["symbol", "date"] + SENT8, "scored")))
def q_b15(spark, sf):
    return out_spark(score_table(spark, sf), ["symbol", "date"] + SENT8)


E11_COLS = ["symbol", "date"] + fe.SCORING_FEATURES


@register("e11_scoring_column_order", score_sql(out_sql(E11_COLS, "scored")))
def q_e11(spark, sf):
    t = score_table(spark, sf)
    v = fe.scoring_vector_columns(t)
    assert v.columns == fe.SCORING_FEATURES
    return out_spark(t, E11_COLS)


E12_COLS = [c for c in TRAIN_COLS if c not in fe.SOCIAL_COLS]


@register("e12_traditional_variant", train_sql(out_sql(E12_COLS, "feat")))
def q_e12(spark, sf):
    t = fe.drop_social(out_spark(train_table(spark, sf), TRAIN_COLS))
    return t


E13_COLS = [c for c in TRAIN_COLS if c not in ("symbol", "date")]


@register("e13_numeric_only", train_sql(out_sql(E13_COLS, "feat")))
def q_e13(spark, sf):
    return fe.numeric_only(out_spark(train_table(spark, sf), TRAIN_COLS))


@register("e14_class_balance", train_sql("""
    SELECT symbol, round(avg(target_direction), 6) AS class_balance, count(*) AS rows FROM feat GROUP BY symbol"""))
def q_e14(spark, sf):
    b = fe.class_balance(train_table(spark, sf))
    return b.select("symbol", rnd("class_balance", 6).alias("class_balance"), "rows")


@register("e15_date_slice", score_sql("""
    SELECT symbol, date, round(RSI, 6) AS RSI FROM scored WHERE date BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'"""))
def q_e15(spark, sf):
    s = fe.slice_or_latest(score_table(spark, sf), "1997-01-01", "1997-03-31")
    return s.select("symbol", "date", rnd("RSI", 6).alias("RSI"))


@register("e15_latest_fallback", score_sql("""
    SELECT symbol, max(date) AS date, round(arg_max(RSI, date), 6) AS RSI FROM scored GROUP BY symbol"""))
def q_e15b(spark, sf):
    s = fe.slice_or_latest(score_table(spark, sf), "2030-01-01", "2030-12-31")
    return s.select("symbol", "date", rnd("RSI", 6).alias("RSI"))


E16_WANTED = ["close", "volume", "RSI", "MACD", "sentimiento_promedio", "volatilidad_sentimiento", "VIX", "Return_1d"]


@register("e16_keep_existing_columns", train_sql(out_sql(["close", "volume", "RSI", "sentimiento_promedio",
                                                          "volatilidad_sentimiento", "VIX"], "feat")))
def q_e16(spark, sf):
    return fe.keep_existing(out_spark(train_table(spark, sf), TRAIN_COLS), E16_WANTED)


@register("d15_candidate_features", score_sql("""
    SELECT symbol, date,
           CAST(coalesce(RSI < 30, false) AS INTEGER) - CAST(coalesce(RSI > 70, false) AS INTEGER) AS RSI_Signal,
           round(CASE WHEN count(sentimiento_promedio) OVER w5 >= 1 THEN avg(sentimiento_promedio) OVER w5 END, 6)
             AS Sentiment_Momentum,
           CAST(coalesce(volume > CASE WHEN count(volume) OVER w20 >= 1 THEN avg(volume) OVER w20 END * 1.5, false) AS INTEGER)
             AS Volume_Spike
    FROM scored
    WINDOW w5 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
           w20 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""))
def q_d15(spark, sf):
    c = ind.candidate_features(score_table(spark, sf))
    return c.select("symbol", "date", "RSI_Signal", rnd("Sentiment_Momentum", 6).alias("Sentiment_Momentum"),
                    "Volume_Spike")


@register("e7_cyclic_encodings", with_views(["bars"], f"""
    SELECT symbol, date, round(sin({TWO_PI} * m / 12), 8) AS month_sin, round(cos({TWO_PI} * m / 12), 8) AS month_cos,
           round(sin({TWO_PI} * w / 7), 8) AS day_sin, round(cos({TWO_PI} * w / 7), 8) AS day_cos
    FROM (SELECT symbol, date, CAST(month(date) AS INTEGER) AS m, CAST(isodow(date) - 1 AS INTEGER) AS w FROM bars)"""))
def q_e7(spark, sf):
    c = fe.cyclic(fe.calendar(fx.bars(spark, sf).select("symbol", "date")))
    return out_spark(c, ["symbol", "date", "month_sin", "month_cos", "day_sin", "day_cos"])
