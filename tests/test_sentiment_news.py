import datetime as dt

import pytest

from tickloom.operators import news as nw
from tickloom.operators import sentiment as st


def test_continuous_score_and_label(spark):
    df = spark.createDataFrame([("positive", 0.9), ("LABEL_0", 0.8), ("neutral", 0.99), ("label_2", 0.5)],
                               "label string, score double")
    got = df.select(st.continuous_score(), st.normalise_label()).collect()
    assert [tuple(r) for r in got] == [(0.95, "positive"), (0.1, "negative"), (0.5, "neutral"), (0.75, "positive")]


def test_daily_aggregate_single_post_std_zero(spark):
    d = dt.date(2026, 3, 18)
    df = spark.createDataFrame([("S", d, 0.2), ("S", d, 0.4), ("S", dt.date(2026, 3, 19), 0.7), ("S", None, 0.9)],
                               "symbol string, fecha_limpia date, puntuacion_sentimiento double")
    got = {r["fecha_limpia"]: r for r in st.daily_sentiment(df).collect()}
    assert set(got) == {d, dt.date(2026, 3, 19)}          # NULL day dropped
    assert got[d]["volumen_posts"] == 2 and got[d]["sentimiento_medio"] == pytest.approx(0.3)
    assert got[d]["sentimiento_std"] == pytest.approx(0.1414213562)
    assert got[dt.date(2026, 3, 19)]["sentimiento_std"] == 0.0


def test_top_n_per_day_is_exact_under_salting(spark):
    rows = [("S", dt.date(2024, 1, 1), str(i), i % 7, i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "symbol string, fecha_limpia date, tweet_id string, favoritos int, retweets int")
    got = [r["tweet_id"] for r in st.top_n_per_day(df, n=5, salt_buckets=8).orderBy("rank").collect()]
    brute = sorted(rows, key=lambda r: (-(r[3] + r[4]), r[2]))[:5]
    assert got == [r[2] for r in brute]


def test_label_map_answer_and_alignment(spark):
    df = spark.createDataFrame([("Positive", "Es POSITIVO claramente", "positive, negative", 3),
                                ("Other", "   ", "a,b,c,d", 2), ("Negative", "no se", "x", 1)],
                               "l string, a string, ans string, n int")
    got = df.select(st.label_value("l"), st.answer_label("a"), st.align_batch_answers("ans", "n")).collect()
    assert [tuple(r) for r in got] == [(1, "Positivo", ["Positive", "Negative", "Error"]),
                                       (None, "Vacio", ["A", "B"]), (-1, "Indeterminado", ["X"])]


def test_lexicon_scorer_whole_text(spark):
    long_text = "bad " * 5000 + "good great"
    df = spark.createDataFrame([("good news, great gains",), (long_text,), (None,)], "t string")
    got = [tuple(r) for r in df.select(st.lexicon_score("t").alias("s")).select("s.label", "s.n_pos", "s.n_neg").collect()]
    assert got == [("positive", 3, 0), ("negative", 2, 5000), ("neutral", 0, 0)]


def test_injected_scorer_isolates_failing_rows(spark):
    def scorer(texts):
        if any("boom" in t for t in texts):
            raise RuntimeError("model failure")
        return [("positive", 0.9) for _ in texts]
    df = spark.createDataFrame([(i, "boom" if i == 3 else f"text {i}") for i in range(20)], "id int, text string")
    got = {r["id"]: (r["label"], r["score"]) for r in st.score_texts(df, "text", scorer=scorer, batch_size=4).collect()}
    assert got[3] == ("ERROR", 0.0)
    assert all(v == ("positive", 0.9) for k, v in got.items() if k != 3)


def test_tone_split_is_safe(spark):
    df = spark.createDataFrame([("1.5,2,3,4,5,6",), ("x,",), (None,)], "v string")
    got = df.select(nw.tone_part("v", 0), nw.tone_part("v", 1), nw.tone_part("v", 7)).collect()
    assert [tuple(r) for r in got] == [(1.5, 2.0, None), (None, None, None), (None, None, None)]


def test_daily_tone_filters(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(d, "1,0,0,0,0", "Org 1", None), (d, "3,0,0,0,0", "ORG 1x", None),
                                (d, "9,0,0,0,0", "Org 1", "srclc:xx"), (d, "7,0,0,0,0", "Org 2", None),
                                (dt.date(2024, 2, 1), "5,0,0,0,0", "Org 1", None)],
                               "date date, v2tone string, orgs string, translationinfo string")
    t = nw.daily_tone(nw.filter_news(df, "2024-01-01", "2024-01-31", "org 1")).collect()
    assert len(t) == 1 and t[0]["volumen_noticias"] == 2 and t[0]["sentimiento_promedio"] == 2.0
    assert t[0]["volatilidad_sentimiento"] == pytest.approx(1.414)


def test_company_news_reports_each_event_on_its_days(spark):
    """Every event is reported on all its days: fewer reports leave fewer rows to train on."""
    from tickloom.sources import fixtures as fx
    from tickloom.sources.tables import read_table
    sf = "/root/testdata/sf0.001"
    n = read_table(spark, sf, "events").count()
    days = fx.company_news(spark, sf).groupBy("date").count()
    assert days.agg({"count": "sum"}).first()[0] == 24 * n
    assert days.count() == min(2405, 24 * n)
