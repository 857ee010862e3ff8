"""Driver contract: entry() smoke, query / oracle registry, and a DuckDB
comparison of a sample of queries at the smallest scale factor."""

import datetime as dt
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tickloom.sources.tables import TABLES

SF = "/root/testdata/sf0.001"

# starting with its lower-case ID.
BUILT = (["a%d" % i for i in range(1, 10)] + ["b%d" % i for i in range(1, 18)] + ["c%d" % i for i in range(1, 9)]
         + ["d%d" % i for i in range(1, 16)] + ["e%d" % i for i in range(1, 17)] + ["f%d" % i for i in range(1, 8)]
         + ["g%d" % i for i in range(1, 13)] + ["h1", "h2", "h3", "h4", "h5", "h6", "h7", "h8"]
         + ["i%d" % i for i in range(1, 13)] + ["j%d" % i for i in range(1, 22)] + ["k%d" % i for i in range(1, 12)]
         + ["l%d" % i for i in range(1, 16)] + ["m1", "m2", "m3"])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "sharpe" in df.columns


def test_every_built_id_has_a_query():
    keys = [k for k in entry.queries() if not re.fullmatch(r"op\d+_\w+|pipeline", k)]     # those of the subpackage llm
    ids = set()
    for k in keys:
        m = re.match(r"([a-m])(\d+)", k)
        ids.add(m.group(0))
        for extra in re.findall(r"_([a-m]\d+)(?=_)", k):
            ids.add(extra)
    missing = [i for i in BUILT if i not in ids]
    assert not missing, missing
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


SAMPLE = ["d1_d5_indicators", "d7_macd", "j16_model_comparison", "j13_trade_pairs", "g4_daily_sentiment",
          "f1_f5_daily_news_tone", "c1_newest_batch_wins", "k4_parameter_grid", "l11_monthly_error_rate",
          "e10_scoring_features", "h5_train_sequences", "b2_row_contract_violations"]


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_sample(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == exp
