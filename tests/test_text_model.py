import math

import pytest

from tickloom.operators import sentiment as st
from tickloom.operators import text_model as tm
from tickloom.session import scratch_path

GOOD, BAD = "bright calm honest", "dull angry false"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(f"{GOOD if i % 3 else BAD} w{i % 7}", int(i % 3 > 0)) for i in range(90)] + [("ignored", None)]
    path = scratch_path(spark, "t_text_model")
    return tm.fit(spark.createDataFrame(rows, "text string, label int"), path)


def test_windows_hold_every_word(spark):
    text = " ".join(f"a{'b' * (i % 5)}" for i in range(1100))
    df = spark.createDataFrame([(text,), ("",), (None,), ("12 34",)], "text string")
    sizes = [[len(w) for w in r[0]] for r in df.select(tm.windows("text")).collect()]
    assert sizes == [[512, 512, 76], [0], [0], [0]]


def test_learns_and_scores_as_the_table_says(spark, model):
    w = tm.read(spark, model)
    assert "ignored" not in w and "bright" in w
    df = spark.createDataFrame([(1, GOOD), (2, BAD)], "id int, text string")
    got = {r["id"]: (r["label"], r["score"]) for r in st.score_texts(df, loader=tm.Loader(spark, model)).collect()}
    assert got[1][0] == "positive" and got[2][0] == "negative"
    odds = w[""] + sum(w[t] for t in GOOD.split())
    assert got[1][1] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_whole_text_counts_unless_truncated(spark, model):
    text = " ".join(["bright"] * 512 + ["angry false dull"] * 1000)
    scorer, first = tm.LinearScorer(tm.read(spark, model)), tm.LinearScorer(tm.read(spark, model), truncate=True)
    assert scorer([text])[0][0] == "negative" and first([text])[0][0] == "positive"


def test_loaded_once_a_worker_not_once_a_task(spark, model):
    loader = tm.Loader(spark, model, truncate=True)
    df = spark.range(640).selectExpr("id", "'bright day' AS text").repartition(64)
    st.score_texts(df, loader=loader).write.format("noop").mode("overwrite").save()
    assert 1 <= loader.loads.value <= spark.sparkContext.defaultParallelism


def test_batches_hold_sixteen_and_a_failing_row_stays_alone(spark, model):
    sizes = spark.sparkContext.accumulator(0)
    most = 16

    class Counting:
        key = "counting"

        def __call__(self):
            inner = tm.LinearScorer({"": 0.1})

            def score(texts):
                assert len(texts) <= most
                sizes.add(1)
                return inner(texts)
            return score

    df = spark.createDataFrame([(i, None if i == 20 else "a word") for i in range(40)], "id int, text string").coalesce(1)
    got = {r["id"]: (r["label"], r["score"]) for r in st.score_texts(df, loader=Counting()).collect()}
    assert got.pop(20) == ("ERROR", 0.0)
    assert {lab for lab, _ in got.values()} == {"positive"}
    assert sizes.value == 3 + 16            # three batches, and the second one again row by row


def test_one_class_is_an_error_and_a_large_table_too(spark, model):
    one = spark.createDataFrame([("a b", 1), ("c d", 1)], "text string, label int")
    with pytest.raises(ValueError, match="two classes"):
        tm.fit(one, scratch_path(spark, "t_text_model"))
    with pytest.raises(ValueError, match="more than 2"):
        tm.read(spark, model, most=2)


def test_empty_table(spark, model):
    df = spark.createDataFrame([], "id int, text string")
    assert st.score_texts(df, loader=tm.Loader(spark, model)).collect() == []


def test_few_texts_are_held_at_once(spark):
    """A worker scores slices of an Arrow batch: other columns, nulls and order stay as they are."""
    df = spark.range(1000).selectExpr("id", "if(id % 7 = 0, null, id) AS n", "if(id % 5 = 0, null, concat('t', id)) AS text").coalesce(1)
    got = st.score_texts(df, scorer=lambda texts: [(t or "none", float(len(texts))) for t in texts], batch_size=1000).collect()
    assert [r["id"] for r in got] == list(range(1000)) and max(r["score"] for r in got) == 256
    assert all((r["n"] is None) == (r["id"] % 7 == 0) and r["label"] == (f"t{r['id']}" if r["id"] % 5 else "none") for r in got)
