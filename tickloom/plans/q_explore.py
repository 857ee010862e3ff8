"""Exploratory analytics over the scoring feature table, the
crossover backtest and the model signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import rnd as R
from ..operators import explore as ex
from ..operators import features as fe
from ..operators import indicators as ind
from ..sources import fixtures as fx
from ..sources.tables import read_table
from .oracle import win, with_views
from .q_features import score_sql, score_table
from .q_strategy import ONE
from .q_strategy import book as crossover_book
from .registry import register

KEY_FEATURES = ["close", "volume", "RSI", "sentimiento_promedio", "volatilidad_sentimiento", "VIX", "Return_1d"]


def master(spark, sf):
    return score_table(spark, sf).withColumn("Return_1d", ex.next_day_return("close"))


MASTER_SQL = ("master", f"SELECT *, CASE WHEN close = 0 THEN NULL ELSE lead(close) OVER ({win()}) / close - 1 END AS Return_1d FROM scored")


def master_sql(body, extra=None):
    from .q_features import SCORE_CTES
    return with_views(["bars", "vix", "posts"], body, SCORE_CTES + [MASTER_SQL] + (extra or []))


@register("l1_next_day_return", with_views(["bars"], f"""
    SELECT symbol, date, round(CASE WHEN close = 0 THEN NULL ELSE lead(close) OVER ({win()}) / close - 1 END, 8) AS Return_1d
    FROM bars"""))
def q_l1(spark, sf):
    return fx.bars(spark, sf).select("symbol", "date", R(ex.next_day_return("close"), 8).alias("Return_1d"))


L2_COLS = ["Return_1d", "sentimiento_promedio", "volatilidad_sentimiento", "VIX"]


@register("l2_yearly_means", master_sql("SELECT symbol, year, " + ", ".join(f"round(avg({c}), 8) AS {c}" for c in L2_COLS)
                                        + " FROM master GROUP BY symbol, year"))
def q_l2(spark, sf):
    y = ex.yearly_means(master(spark, sf), L2_COLS)
    return y.select("symbol", "year", *[R(c, 8).alias(c) for c in L2_COLS])


def _corr_sql(a, b):
    x = f"CASE WHEN {b} IS NOT NULL THEN {a} END"
    y = f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    den = f"(stddev_samp({x}) * stddev_samp({y}))"
    return f"CASE WHEN {den} = 0 THEN NULL ELSE covar_samp({x}, {y}) / {den} END"


@register("l3_correlation_matrix", master_sql(" UNION ALL ".join(
        f"SELECT symbol, '{a}' AS f1, '{b}' AS f2, round({_corr_sql(a, b)}, 6) AS corr FROM master GROUP BY symbol"
        for a in KEY_FEATURES for b in KEY_FEATURES)))
def q_l3(spark, sf):
    c = ex.corr_matrix(master(spark, sf), KEY_FEATURES)
    return c.select("symbol", "f1", "f2", R("corr", 6).alias("corr"))


L4_COLS = ["close", "sentimiento_promedio", "volatilidad_sentimiento", "VIX"]


@register("l4_zscore_last_year", master_sql("SELECT symbol, date, " + ", ".join(
        f"round(CASE WHEN stddev_samp({c}) OVER (PARTITION BY symbol) = 0 THEN NULL ELSE ({c} - avg({c}) OVER (PARTITION BY symbol)) "
        f"/ stddev_samp({c}) OVER (PARTITION BY symbol) END, 6) AS {c}" for c in L4_COLS)
        + " FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM master) WHERE k <= 252"))
def q_l4(spark, sf):
    z = ex.zscores_last(master(spark, sf), L4_COLS, 252)
    return z.select("symbol", "date", *[R(c, 6).alias(c) for c in L4_COLS])


@register("l5_target_share_by_year", master_sql(
        "SELECT symbol, year, round(avg(target_direction), 6) AS target_share FROM master GROUP BY 1, 2"))
def q_l5(spark, sf):
    y = ex.yearly_means(master(spark, sf), ["target_direction"])
    return y.select("symbol", "year", R("target_direction", 6).alias("target_share"))


L6_FEATURES = fe.SCORING_FEATURES


@register("l6_target_correlation_top_bottom", master_sql("""
    SELECT symbol, feature, round(corr, 6) AS corr, CAST(rank AS INTEGER) AS rank, side FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY round(corr, 9) DESC NULLS LAST, feature) AS rank,
             count(*) OVER (PARTITION BY symbol) AS n FROM c)
    CROSS JOIN (VALUES ('top'), ('bottom')) s(side)
    WHERE (side = 'top' AND rank <= 10) OR (side = 'bottom' AND rank > n - 10)""",
        [("c", " UNION ALL ".join(f"SELECT symbol, '{f}' AS feature, {_corr_sql(f, 'target_direction')} AS corr "
                                  f"FROM master GROUP BY symbol" for f in L6_FEATURES))]))
def q_l6(spark, sf):
    c = ex.corr_with_target(master(spark, sf), L6_FEATURES, "target_direction")
    t = ex.top_bottom(c, 10)
    return t.select("symbol", "feature", R("corr", 6).alias("corr"), "rank", "side")


L7_FEATURES = ["RSI_Signal", "Sentiment_Momentum", "Volume_Spike"]
_L7_CAND = ("cand", """
    SELECT *, CAST(coalesce(RSI < 30, false) AS INTEGER) - CAST(coalesce(RSI > 70, false) AS INTEGER) AS RSI_Signal,
           CASE WHEN count(sentimiento_promedio) OVER w5 >= 1 THEN avg(sentimiento_promedio) OVER w5 END AS Sentiment_Momentum,
           CAST(coalesce(volume > CASE WHEN count(volume) OVER w20 >= 1 THEN avg(volume) OVER w20 END * 1.5, false) AS INTEGER)
             AS Volume_Spike
    FROM master
    WINDOW w5 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
           w20 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")


@register("l7_candidate_feature_correlation", master_sql(" UNION ALL ".join(
        f"SELECT symbol, '{f}' AS feature, round({_corr_sql(f, 'target_direction')}, 6) AS corr FROM cand GROUP BY symbol"
        for f in L7_FEATURES), [_L7_CAND]))
def q_l7(spark, sf):
    c = ex.corr_with_target(ind.candidate_features(master(spark, sf)), L7_FEATURES, "target_direction")
    return c.select("symbol", "feature", R("corr", 6).alias("corr"))


def _hist_sql(src, col, bins, keys):
    k = ", ".join(keys)
    on = " AND ".join(f"x.{c} = r.{c}" for c in keys)
    return f"""
    SELECT {', '.join('x.' + c for c in keys)}, CAST(CASE WHEN r.hi = r.lo THEN 0
                ELSE least(floor((x.{col} - r.lo) * {bins} / (r.hi - r.lo)), {bins - 1}) END AS INTEGER) AS bin,
           r.lo, r.hi, r.n
    FROM (SELECT * FROM {src} WHERE {col} IS NOT NULL) x
    JOIN (SELECT {k}, min({col}) AS lo, max({col}) AS hi, count(*) AS n FROM {src} WHERE {col} IS NOT NULL GROUP BY {k}) r ON {on}"""


def _hist_out(keys):
    k = ", ".join(keys)
    return f"""
    SELECT {k}, bin, count(*) AS count, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 50, 6) AS "left",
           round(any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / 50, 6) AS "right",
           round(CASE WHEN any_value(n) * ((any_value(hi) - any_value(lo)) / 50) = 0 THEN NULL
                      ELSE count(*) / (any_value(n) * ((any_value(hi) - any_value(lo)) / 50)) END, 6) AS density
    FROM h GROUP BY {k}, bin"""


@register("l8_return_histogram", with_views(["px", "params"], _hist_out(["symbol"]),
                                            ONE + [("hx", "SELECT symbol, Strategy_Returns * 100 AS r FROM ob"),
                                                   ("h", _hist_sql("hx", "r", 50, ["symbol"]))]))
def q_l8(spark, sf):
    b = crossover_book(spark, sf).select("symbol", (F.col("Strategy_Returns") * 100).alias("r"))
    h = ex.histogram(b, "r", 50)
    return h.select("symbol", "bin", "count", R("left", 6).alias("left"), R("right", 6).alias("right"),
                    R("density", 6).alias("density"))


@register("l8_histogram_by_class", master_sql(_hist_out(["symbol", "target_direction"]).replace("/ 50", "/ 30"),
                                              [("h", _hist_sql("master", "RSI", 30, ["symbol", "target_direction"]))]))
def q_l8b(spark, sf):
    h = ex.histogram(master(spark, sf), "RSI", 30, keys=("symbol", "target_direction"))
    return h.select("symbol", "target_direction", "bin", "count", R("left", 6).alias("left"),
                    R("right", 6).alias("right"), R("density", 6).alias("density"))


ERR = ("err", "SELECT *, CAST(predicted_signal <> label AS INTEGER) AS Error, abs(confidence - 0.5) AS margin FROM preds")


def err(spark, sf):
    return ex.error_table(fx.preds(spark, sf))


@register("l9_error_table", with_views(["preds"], """
    SELECT model, symbol, date, label, predicted_signal, Error, round(margin, 8) AS margin FROM err""", [ERR]))
def q_l9(spark, sf):
    return err(spark, sf).select("model", "symbol", "date", "label", "predicted_signal", "Error",
                                 R("margin", 8).alias("margin"))


@register("l10_error_by_confidence", with_views(["preds"], """
    SELECT model, CAST(greatest(1, ceil((margin - lo) / ((hi - lo) / 10))) AS INTEGER) AS bin,
           round(avg(Error), 6) AS error_rate, count(*) AS n
    FROM err JOIN (SELECT model, min(margin) AS lo, max(margin) AS hi FROM err GROUP BY model) USING (model)
    GROUP BY 1, 2""", [ERR]))
def q_l10(spark, sf):
    e = ex.error_by_confidence(err(spark, sf))
    return e.select("model", "bin", R("error_rate", 6).alias("error_rate"), "n")


MONTHLY = ("monthly", """
    SELECT c.model, c.symbol, c.month, coalesce(a.errors, 0) AS errors, coalesce(a.n, 0) AS n,
           CASE WHEN coalesce(a.n, 0) = 0 THEN NULL ELSE a.errors / a.n END AS error_rate
    FROM (SELECT model, symbol, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH))::DATE AS month
          FROM (SELECT model, symbol, date_trunc('month', date)::DATE AS month FROM err) GROUP BY 1, 2) c
    LEFT JOIN (SELECT model, symbol, date_trunc('month', date)::DATE AS month, CAST(sum(Error) AS BIGINT) AS errors,
                      count(*) AS n FROM err GROUP BY 1, 2, 3) a
    USING (model, symbol, month)""")


@register("l11_monthly_error_rate", with_views(["preds"], """
    SELECT model, symbol, month, errors, n, round(error_rate, 6) AS error_rate FROM monthly""", [ERR, MONTHLY]))
def q_l11(spark, sf):
    m = ex.monthly_errors(err(spark, sf))
    return m.select("model", "symbol", "month", F.col("errors").cast("bigint").alias("errors"), "n",
                    R("error_rate", 6).alias("error_rate"))


@register("l11_worst_best_month", with_views(["preds"], """
    SELECT w.model, w.symbol, w.month AS worst_month, b.month AS best_month FROM
      (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model, symbol ORDER BY error_rate DESC, month) AS k
                      FROM monthly WHERE error_rate IS NOT NULL) WHERE k = 1) w
    JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model, symbol ORDER BY error_rate, month) AS k
                         FROM monthly WHERE error_rate IS NOT NULL) WHERE k = 1) b USING (model, symbol)""",
        [ERR, MONTHLY]))
def q_l11b(spark, sf):
    return ex.worst_best_month(ex.monthly_errors(err(spark, sf)))


L12_FEATURES = ["close", "volume", "RSI", "daily_return", "SMA_10", "SMA_50", "volatilidad_10d", "VIX",
                "sentimiento_promedio", "volatilidad_sentimiento"]


@register("l12_feature_gap_right_wrong", with_views(["preds", "bars", "vix", "posts"], """
    SELECT model, symbol, feature, round(correct_mean, 4) AS correct_mean, round(error_mean, 4) AS error_mean,
           CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY model, symbol ORDER BY round(abs(error_mean - correct_mean), 9) DESC NULLS LAST, feature)
             AS rank FROM g) WHERE rank <= 10""",
        __import__("tickloom.plans.q_features", fromlist=["SCORE_CTES"]).SCORE_CTES + [ERR, ("ej", """
            SELECT e.model, e.symbol, e.Error, s.* EXCLUDE (symbol, date) FROM err e JOIN scored s USING (symbol, date)"""),
            ("g", " UNION ALL ".join(
                f"SELECT model, symbol, '{c}' AS feature, avg(CASE WHEN Error = 0 THEN {c} END) AS correct_mean, "
                f"avg(CASE WHEN Error = 1 THEN {c} END) AS error_mean FROM ej GROUP BY 1, 2" for c in L12_FEATURES))]))
def q_l12(spark, sf):
    j = err(spark, sf).select("model", "symbol", "date", "Error").join(score_table(spark, sf), ["symbol", "date"])
    g = ex.feature_gap(j, L12_FEATURES)
    return g.select("model", "symbol", "feature", R("correct_mean", 4).alias("correct_mean"),
                    R("error_mean", 4).alias("error_mean"), "rank")


@register("l13_calibration_curve", with_views(["preds"], """
    SELECT model, CAST(least(greatest(ceil(confidence * 10), 1), 10) AS INTEGER) AS bin,
           round(avg(label), 6) AS fraction_of_positives, round(avg(confidence), 6) AS mean_predicted_value,
           count(*) AS n FROM preds GROUP BY 1, 2"""))
def q_l13(spark, sf):
    c = ex.calibration(fx.preds(spark, sf))
    return c.select("model", "bin", R("fraction_of_positives", 6).alias("fraction_of_positives"),
                    R("mean_predicted_value", 6).alias("mean_predicted_value"), "n")


@register("l14_high_confidence_errors", with_views(["preds"], """
    SELECT model, count(*) FILTER (WHERE Error = 1 AND margin > 0.3) AS n_high_conf_errors,
           round(count(*) FILTER (WHERE Error = 1 AND margin > 0.3) * 100.0 / count(*), 6) AS share_pct
    FROM err GROUP BY model""", [ERR]))
def q_l14(spark, sf):
    h = ex.high_confidence_errors(err(spark, sf))
    return h.select("model", "n_high_conf_errors", R("share_pct", 6).alias("share_pct"))


@register("l15_preview_sample", """
    SELECT doc_id, lang, n_chars FROM documents ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)) LIMIT 20""")
def q_l15(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return ex.preview_sample(d, 20, "doc_id", seed=42)
