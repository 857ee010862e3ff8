"""Declared table contracts (B1, B2).

A contract is a ``StructType``: required columns are non-nullable fields;
extra columns are allowed.  The row-level check is one aggregate pass
(``count_if`` per column) instead of validating rows one by one: the result is
a small violations table (one row per column), and strict mode raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, L, I, DT, TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.DateType(), T.TimestampType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# The declared row models.
STOCK_RAW = _schema(("Date", DT, False), ("Close", D, False), ("High", D, False), ("Low", D, False),
                    ("Open", D, False), ("Volume", L, False))
STOCK_PROCESSED = _schema(("date", DT, False), ("close", D, False), ("high", D, False), ("low", D, False),
                          ("open", D, False), ("volume", L, False))
GDELT_SENTIMENT = _schema(("fecha", DT, False), ("volumen_noticias", L, False), ("sentimiento_promedio", D, False),
                          ("puntuacion_positiva", D, False), ("puntuacion_negativa", D, False),
                          ("polaridad_promedio", D, False), ("volatilidad_sentimiento", D, False),
                          ("uso_primera_persona", D, False))
SOCIAL_RAW = _schema(("ID_Tweet", S, False), ("Fecha_UTC", S, False), ("Contenido_Texto", S, True),
                     ("Retweets", L, False), ("Favoritos", L, False))
SOCIAL_PROCESSED = _schema(("tweet_id", S, False), ("fecha_utc", TS, False), ("contenido_texto", S, True),
                           ("retweets", L, False), ("favoritos", L, False), ("fecha_limpia", DT, False))
SOCIAL_SENTIMENT = T.StructType(SOCIAL_PROCESSED.fields + [T.StructField("puntuacion_sentimiento", D, False),
                                                           T.StructField("sentimiento", S, False)])
SOCIAL_AGGREGATED = _schema(("fecha_limpia", DT, False), ("volumen_posts", L, False),
                            ("sentimiento_medio", D, False), ("sentimiento_std", D, False))
ENGINEERED_FEATURES = _schema(
    ("date", DT, False), ("open", D, False), ("high", D, False), ("low", D, False), ("close", D, False),
    ("volume", L, False), ("VIX", D, False), ("daily_return", D, False), ("SMA_10", D, False), ("SMA_50", D, False),
    ("volatilidad_10d", D, False), ("target_direction", I, False), ("volumen_noticias", D, True),
    ("sentimiento_promedio", D, True), ("puntuacion_positiva", D, True), ("puntuacion_negativa", D, True),
    ("polaridad_promedio", D, True), ("volatilidad_sentimiento", D, True), ("uso_primera_persona", D, True),
    ("sentiment_score", D, True))
TRADING_SIGNALS = _schema(("date", DT, False), ("price_close", D, False), ("predicted_signal", I, False),
                          ("confidence", D, False))


class ContractError(ValueError):
    pass


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """B1: the declared columns that ``df`` lacks."""
    return [f.name for f in schema.fields if f.name not in df.columns]


def require_columns(df: DataFrame | None, schema: T.StructType, stage: str) -> DataFrame:
    """B1: every declared column must be present (extra columns are fine); a
    missing frame is an error; an empty frame passes.  Driver-side, metadata only."""
    if df is None:
        raise ContractError(f"[{stage}] no data frame")
    missing = missing_columns(df, schema)
    if missing:
        raise ContractError(f"[{stage}] missing columns: {sorted(missing)}")
    return df


def _bad(c: Column, src: T.DataType, want: T.DataType, nullable: bool) -> Column:
    """True when a value cannot be read as ``want`` (lax rules) or is a
    required NULL.  NaN counts as NULL."""
    if isinstance(src, (T.DoubleType, T.FloatType)):
        c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
    missing = c.isNull()
    if isinstance(want, T.StringType):
        wrong = F.lit(False)
    elif isinstance(want, (T.IntegerType, T.LongType, T.ShortType)):
        x = c.cast("string").try_cast("double")
        wrong = c.isNotNull() & (x.isNull() | (x != F.floor(x)))
    elif isinstance(want, (T.DoubleType, T.FloatType, T.DecimalType)):
        wrong = c.isNotNull() & c.cast("string").try_cast("double").isNull()
    elif isinstance(want, T.DateType):
        wrong = c.isNotNull() & c.cast("string").try_cast("timestamp").isNull() & c.cast("string").try_cast("date").isNull()
    elif isinstance(want, T.TimestampType):
        wrong = c.isNotNull() & c.cast("string").try_cast("timestamp").isNull()
    else:
        wrong = F.lit(False)
    return wrong if nullable else (missing | wrong)


def violations(df: DataFrame, schema: T.StructType, stage: str) -> DataFrame:
    """B2: one aggregate pass -> (stage, column, bad_rows) for every declared column."""
    require_columns(df, schema, stage)
    src = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count_if(_bad(F.col(f"`{f.name}`"), src[f.name], f.dataType, f.nullable)).alias(f.name)
            for f in schema.fields]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{f.name}', `{f.name}`" for f in schema.fields)
    return wide.select(F.lit(stage).alias("stage"),
                       F.expr(f"stack({len(schema.fields)}, {pairs}) AS (column, bad_rows)"))


def validate(df: DataFrame, schema: T.StructType, stage: str, strict: bool = True) -> DataFrame:
    """B1 + B2: raise (strict) when any declared column has a bad row.  Only
    the per-column counts (one small row) reach the driver."""
    v = violations(df, schema, stage)
    if strict:
        bad = [(r["column"], r["bad_rows"]) for r in v.where("bad_rows > 0").collect()]
        if bad:
            raise ContractError(f"[{stage}] rows violating the contract: {bad}")
    return df
