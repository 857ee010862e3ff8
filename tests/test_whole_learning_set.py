"""The queries on the learning set keep every symbol-day that the bars and the whole company news make complete.
What is expected is counted here from the tables alone, without the library's views."""

import datetime as dt
from collections import Counter

import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reports():
    """Untranslated reports of each symbol-day: an event is reported on 24 days of 2,405, by its id."""
    e = pd.read_parquet(f"{SF}/events.parquet", columns=["event_id", "user_id"])
    symbols = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return Counter((symbols[user % 5], dt.date(1995, 1, 1) + dt.timedelta(days=(event * 24 + k) % 2405))
                   for event, user in zip(e.event_id.tolist(), e.user_id.tolist()) if event % 10 for k in range(24))


@pytest.fixture(scope="module")
def days():
    """The days with a bar, in order, of each symbol."""
    o = pd.read_parquet(f"{SF}/orders.parquet", columns=["o_custkey", "o_orderdate"])
    c = pd.read_parquet(f"{SF}/customer.parquet", columns=["c_custkey", "c_mktsegment"])
    j = o.merge(c, left_on="o_custkey", right_on="c_custkey")
    return {s: sorted(set(pd.to_datetime(g.o_orderdate).dt.date)) for s, g in j.groupby("c_mktsegment")}


@pytest.fixture(scope="module")
def complete(days, reports):
    """The days of each symbol that can be learnt from: SMA_50 needs 50 bars, the tone's deviation two reports."""
    found = {s: [d for d in ds[49:] if reports[s, d] >= 2] for s, ds in days.items()}
    assert sum(map(len, found.values())) > 500
    return found


def keyed(found):
    return sorted((s, d) for s, ds in found.items() for d in ds)


def train(found):
    return {s: ds[:int(len(ds) * 0.8)] for s, ds in found.items()}


def held_out(found):
    return {s: ds[int(len(ds) * 0.8):] for s, ds in found.items()}


def run(spark, name):
    return entry.queries()[name](spark, SF)


def keys(rows):
    return sorted((r["symbol"], r["date"]) for r in rows)


def test_e9_contract_checked(spark, complete):
    assert keys(run(spark, "e9_contract_checked").collect()) == keyed(complete)


def test_e2_join_news_tone(spark, days, reports):
    got = {(r["symbol"], r["date"]): r for r in run(spark, "e2_join_news_tone").collect()}
    assert sorted(got) == keyed(days)
    assert all((r["volumen_noticias"] or 0) == reports[key] for key, r in got.items())
    assert all((r["volatilidad_sentimiento"] is not None) == (reports[key] >= 2) for key, r in got.items())


def test_e12_traditional_variant(spark, complete):
    got = run(spark, "e12_traditional_variant")
    assert "sentimiento_promedio" not in got.columns and "VIX" in got.columns
    assert keys(got.collect()) == keyed(complete)


def test_e13_numeric_only(spark, complete, reports):
    got = run(spark, "e13_numeric_only").collect()
    assert Counter((r["year"], r["month"], r["day_of_month"], r["volumen_noticias"]) for r in got) == Counter(
        (d.year, d.month, d.day, reports[s, d]) for s, d in keyed(complete))


def test_e14_class_balance(spark, complete):
    got = run(spark, "e14_class_balance").collect()
    assert {r["symbol"]: r["rows"] for r in got} == {s: len(ds) for s, ds in complete.items()}
    assert all(0 < r["class_balance"] < 1 for r in got)


def test_e16_keep_existing_columns(spark, complete):
    got = run(spark, "e16_keep_existing_columns")
    assert got.columns == ["close", "volume", "RSI", "sentimiento_promedio", "volatilidad_sentimiento", "VIX"]
    assert got.count() == got.dropna().count() == len(keyed(complete))


def test_h1_chronological_split(spark, complete):
    got = run(spark, "h1_chronological_split").collect()
    assert keys(r for r in got if r["split"] == "train") == keyed(train(complete))
    assert keys(r for r in got if r["split"] == "test") == keyed(held_out(complete))


def test_h2_standardise_train_stats(spark, complete):
    got = run(spark, "h2_standardise_train_stats").toPandas()
    assert keys(got.to_dict("records")) == keyed(complete)
    fitted = got[got.split == "train"].groupby("symbol")[["close", "RSI", "VIX", "volume", "daily_return"]]
    assert fitted.mean().abs().to_numpy().max() < 1e-5


def test_h2_standardise_refit(spark, complete):
    got = run(spark, "h2_standardise_refit").toPandas()
    assert keys(got.to_dict("records")) == keyed(complete)
    assert got.groupby("symbol")[["close", "RSI", "VIX", "volume", "daily_return"]].mean().abs().to_numpy().max() < 1e-5


def test_h3_class_weights(spark, complete):
    got = {(r["symbol"], r["date"]): r for r in run(spark, "h3_class_weights").collect()}
    assert sorted(got) == keyed(complete)
    for s, ds in train(complete).items():
        n = Counter(got[s, d]["target_direction"] for d in ds)
        assert all(got[s, d]["weight"] == pytest.approx(len(ds) / (2 * n[got[s, d]["target_direction"]]), abs=1e-7) for d in ds)


def test_h5_train_sequences(spark, complete):
    got = sorted((r["symbol"], r["split"], r["date"], r["step"], r["step_date"]) for r in run(spark, "h5_train_sequences").collect())
    parts = [("train", train(complete)), ("test", held_out(complete))]
    assert got == sorted((s, split, ds[i], k, ds[i - 5 + k]) for split, found in parts for s, ds in found.items()
                         for i in range(5, len(ds)) for k in range(5))


def test_h7_validation_tail(spark, complete):
    got = run(spark, "h7_validation_tail").collect()
    sequences = {s: ds[5:] for s, ds in train(complete).items()}
    assert keys(got) == keyed(sequences)
    assert keys(r for r in got if r["part"] == "val") == keyed({s: ds[len(ds) - int(len(ds) * 0.2):] for s, ds in sequences.items()})


@pytest.fixture
def short_fits(monkeypatch):
    """Models of a few rounds, kept apart from those that other tests store."""
    from tickloom.plans import q_learn
    rounds = q_learn.bo.fit
    monkeypatch.setattr(q_learn, "_STORED", {})
    monkeypatch.setattr(q_learn.bo, "fit", lambda spark, df, cols: rounds(spark, df, cols, rounds=2, depth=2))


def test_i1_random_forest(spark, complete, short_fits):
    got = run(spark, "i1_random_forest").collect()
    assert keys(got) == keyed(held_out(complete))
    assert all(r["is_probability"] and r["class_agrees"] for r in got)


def test_i2_boosted_trees(spark, complete, short_fits):
    got = run(spark, "i2_boosted_trees").collect()
    assert keys(got) == keyed(held_out(complete))
    assert all(r["is_probability"] and r["class_agrees"] for r in got)


def test_i3_sentiment_variants(spark, complete, short_fits):
    got = run(spark, "i3_sentiment_variants").collect()
    n = len(keyed(held_out(complete)))
    assert sorted((r["family"], r["variant"], r["rows"]) for r in got) == [
        (f, v, n) for f in ("boosted", "forest") for v in ("traditional", "with_sentiment")]
    assert all(r["in_range"] for r in got)


def test_models_share_one_split_table(spark, complete, monkeypatch):
    from tickloom.plans import q_learn
    made, split_table = [], q_learn.split_table
    monkeypatch.setattr(q_learn, "_STORED", {})
    monkeypatch.setattr(q_learn, "split_table", lambda spark, sf: made.append(sf) or split_table(spark, sf))
    frames = [make(spark, SF) for make in (q_learn.learn_frame, q_learn.scaled_frame, q_learn.test_rows)]
    assert [keys(f.collect()) for f in frames] == [keyed(complete), keyed(complete), keyed(held_out(complete))]
    assert made == [SF]
