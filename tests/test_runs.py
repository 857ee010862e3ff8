import datetime as dt

import pytest

from tickloom.operators import runs
from tickloom.session import scratch_path


def day(n, hour=0):
    return dt.datetime(2024, 1, n, hour)


ROWS = [
    # at, seq, event, model, version, name, value, kind
    (day(1), 0, "run", "a", 1, None, None, "forest"), (day(1), 0, "run", "b", 1, None, None, "boosted"),
    (day(1), 1, "metric", "a", 1, "accuracy", 0.6, None), (day(1), 1, "metric", "b", 1, "accuracy", 0.7, None),
    (day(3), 0, "alias", "b", 1, "champion", None, None),
    (day(5), 0, "run", "a", 2, None, None, "forest"), (day(5), 1, "alias", "a", 2, "champion", None, None),
    (day(6), 0, "metric", "a", 2, "accuracy", 0.8, None),
    (day(8), 0, "alias", "a", None, "champion", None, None), (day(8), 1, "alias", "b", None, "champion", None, None),
    (day(8), 2, "alias", "b", 1, "champion", None, None),       # taken and given again at one moment
    (day(9), 0, "alias", "b", None, "champion", None, None), (day(9), 0, "alias", "z", 1, "other", None, None),
]
COLS = "at timestamp, seq long, event string, model string, version int, name string, value double, kind string"


@pytest.fixture(scope="module")
def log(spark):
    store = scratch_path(spark, "t_runs")
    for i in range(0, len(ROWS), 4):            # several appends
        runs.record(spark.createDataFrame(ROWS[i:i + 4], COLS), store)
    return runs.events(spark, store)


def brute(at, priority, default):
    def newest(event, model, name=None):
        mine = [r for r in ROWS if r[2] == event and r[3] == model and (name is None or r[5] == name) and r[0] <= at]
        return max(mine, key=lambda r: (r[0], r[1]), default=None)
    for m in priority:
        held = newest("alias", m, "champion")
        if held and held[4] is not None:
            got = [r for r in ROWS if r[2] == "metric" and r[3] == m and r[4] == held[4] and r[0] <= at]
            return m, held[4], max(got, key=lambda r: (r[0], r[1]))[6] if got else 0.0, True
    made = newest("run", default)
    return default, made and made[4], 0.0, False


def test_champion_as_of_equals_brute_force(spark, log):
    moments = [day(n, h) for n in range(1, 11) for h in (0, 12)] + [dt.datetime(2023, 12, 31)]
    asked = spark.createDataFrame([(m,) for m in moments + moments[:3]] + [(None,)], "at timestamp")
    for priority, default in ((["a", "b"], "a"), (["b", "a"], "b"), (["b"], "a"), (["z"], "nobody")):
        got = {r["at"]: (r["champion"], r["version"], r["accuracy"], r["by_alias"]) for r in runs.champion_as_of(log, asked, priority, default).collect()}
        assert got == {m: brute(m, priority, default) for m in moments}


def test_appending_changes_no_earlier_answer(spark):
    store = scratch_path(spark, "t_runs")
    runs.record(spark.createDataFrame(ROWS[:5], COLS), store)
    asked = spark.createDataFrame([(day(4),)], "at timestamp")
    before = runs.champion_as_of(runs.events(spark, store), asked, ["a", "b"], "a").collect()
    runs.record(spark.createDataFrame(ROWS[5:], COLS), store)
    assert runs.champion_as_of(runs.events(spark, store), asked, ["a", "b"], "a").collect() == before


def test_dispatch_by_kind(spark, log):
    scorers = {"forest": lambda path: ("walked", path)}
    assert runs.score_with(log, "a", 2, scorers) == ("walked", None)
    with pytest.raises(LookupError, match="boosted"):
        runs.score_with(log, "b", 1, scorers)
    with pytest.raises(LookupError, match="version 7"):
        runs.score_with(log, "a", 7, scorers)


def test_an_event_without_a_moment_is_an_error(spark):
    bad = spark.createDataFrame([(None, 0, "run", "a", 1, None, None, None)], COLS)
    with pytest.raises(Exception, match="needs at"):
        runs.record(bad, scratch_path(spark, "t_runs"))


def test_empty_log(spark):
    store = scratch_path(spark, "t_runs")
    runs.record(spark.createDataFrame([], COLS), store)
    asked = spark.createDataFrame([(day(4),)], "at timestamp")
    got = runs.champion_as_of(runs.events(spark, store), asked, ["a"], "d").collect()
    assert [tuple(r) for r in got] == [(day(4), "d", None, 0.0, False)]
