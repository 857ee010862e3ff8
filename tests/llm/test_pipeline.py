import itertools

import numpy as np
import pytest

import corpus_pipeline as cp
from tickloom.llm import decontaminate_cgk, packing, secret_structure, simhash_pivots, toxicity_weak

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before each stage and the last result, as lists of rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [(docs.columns, docs.collect())]
    top = tmp_path_factory.mktemp("stages")
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SF).write.parquet(f"{top}/{k}")
        docs = spark.read.parquet(f"{top}/{k}")
        out.append((docs.columns, docs.collect()))
    return out


def by_id(part):
    return {r.doc_id: r for r in part[1]}


def test_columns(stages):
    for cols, _ in stages[:-1]:
        assert cols == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]


def test_toxicity_rejects_what_its_classifier_does(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity_weak.fit(spark, docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity_weak.scores(docs, model).collect()}
    assert set(by_id(stages[1])) == {i for i, s in scores.items() if s < toxicity_weak.THRESHOLD}
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    assert len(toxic & set(by_id(stages[1]))) <= 0.3 * len(toxic)


def test_one_of_each_group_stays(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    prints = {i: simhash_pivots.fingerprint(r.text or "") & (2 ** 64 - 1) for i, r in before.items()}
    label = {i: i for i in prints}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            label[max(root(a), root(b))] = min(root(a), root(b))
    assert set(after) == {root(i) for i in prints}
    assert all(after[i] == before[i] for i in after)


def test_contaminated_documents_go(spark, stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    items = [" ".join(w) for w in (r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect())]
    hold = {i for i, r in before.items() if any(x in " ".join(r.text.lower().replace("!!", "").split()) for x in items)}
    assert hold and not hold & set(after) and all(after[i] == before[i] for i in after)
    index, _ = next(decontaminate_cgk.indexes(spark.read.parquet(f"{SF}/benchmark.parquet"), "text"))
    gone = set(before) - set(after)
    scan = decontaminate_cgk.Scan(index)
    assert all(scan([before[i].text]) for i in gone) and len(gone) <= len(hold) * 1.2 + 2


def test_secrets_are_redacted(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(after) == set(before)
    for i, r in after.items():
        found = secret_structure.spans(before[i].text)[1]
        assert (r.text == before[i].text) == (not found)
        assert not secret_structure.base_spans(r.text) and (not found or r.n_chars == len(r.text))


def test_packing_takes_every_document(stages):
    docs, rows = by_id(stages[4]), stages[5][1]
    assert {r.doc_id for r in rows} == set(docs)
    ids = packing.WordIds(packing.default_tokenizer())
    length = {i: len(x) // 4 + 1 for i, x in zip(docs, ids([r.text for r in docs.values()]))}
    assert sum(r.length for r in rows) == sum(length.values())
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        ends = np.cumsum([0] + [n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == ends[:-1].tolist() and ends[-1] <= 4096


def test_clashing_column_names_come_through(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some clean text of words", "en", "s", 24), (2, "other words stand here", "en", "s", 22)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    names = ["row", "row_", "score", "clean", "fp", "key", "component_id", "__row", "a.b", "length", "__text"]
    docs = docs.selectExpr("*", *[f"doc_id * 10 + {i} AS `{n}`" for i, n in enumerate(names)])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no such item in these documents")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == sorted(map(tuple, docs.collect()))
    assert cp.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 2


def test_odd_documents_pass_through(spark, tmp_path):
    rows = [(1, None, "en", "s", None), (2, "", None, None, 0), (None, "some text", "en", "s", 9), (3, "x " * 50000, "en", "s", 1),
            (4, "token = 0123456789abcdef0123456789", "en", "s", 1), (5, "twin text here", "en", "s", 1), (5, "twin text here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for path, df in ((f"{tmp_path}/a", docs), (f"{tmp_path}/b", docs.limit(0))):
        df.write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    got = cp.run(spark, f"{tmp_path}/a").collect()
    assert sorted((r.doc_id or 0) for r in got if r.piece == 0) == [0, 1, 3, 4, 5]     # 1 and 2 are copies
    assert cp.run(spark, f"{tmp_path}/b").collect() == []
