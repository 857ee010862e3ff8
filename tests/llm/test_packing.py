import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tickloom.llm import packing as pk

TEXTS = [None, "", " \n", "Hello world", "I'm İ ΣΑΣ <|endoftext|> x² ½ don't 'll   ﬁ", "naïve ÀÉ ¹²³ª º µ ß's",
         "日本語 text \x85 \x1c here", "word " * 9000, "word " * 4095, "word " * 4096, "é combining", "a--b..c!!'s"]


def reference_ids(text):
    t = Tokenizer.from_file(pk.default_tokenizer())
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_are_the_tokenizers():
    rnd = random.Random(1)
    letters = [chr(c) for c in [*range(1, 0x250), 0x300, 0x301, 0x3a3, 0x1e9e, 0x2028, 0x3000, 0x1f600]]
    parts = ["'s", "'ll", "'re", " ", " ", "\n", "<|endoftext|>", "<|", "word", "Über", "naïve", "don't", "12", "...", "ß", "İ"]
    texts = ["".join(rnd.choice(letters if rnd.random() < 0.3 else parts) for _ in range(rnd.randrange(40))) for _ in range(6000)]
    texts += [chr(c) for c in range(1, 0x250)] + [f"a{chr(c)}B" for c in range(1, 0x250)]
    texts += ["".join(rnd.choice(letters[32:0x17f]) for _ in range(12)) for _ in range(6000)]
    ids = pk.WordIds(pk.default_tokenizer())
    assert ids(texts) == ids.whole(texts)


def check_rows(rows, docs, capacity):
    ids = {}
    for i, t in docs:
        ids.setdefault(i, []).append(reference_ids(t))
    by_seq = defaultdict(list)
    for r in rows:
        part = [x[r.start:r.start + r.length] for x in ids[r.doc_id]]
        assert any(zlib.crc32(np.array(p, "<u4").tobytes()) == r.ids_crc32 and len(p) == r.length for p in part)
        assert r.start == r.piece * capacity
        by_seq[r.sequence_id].append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(r.length for r in rows) == sum(len(x) for xs in ids.values() for x in xs)
    return len(by_seq)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_round_trip(spark, capacity):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (3, TEXTS[3]), (None, "no id"), (None, "no id")]
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in docs], "doc_id long, text string, length int, piece int")
    rows = pk.pack(spark, df, capacity=capacity).collect()
    check_rows(rows, docs, capacity)
    assert sum(r.doc_id is None for r in rows) == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pk.pack(spark, df).collect() == []


def test_whole_table_is_packed_tightly(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pk.pack(spark, df).collect()
    n = check_rows(rows, [(r.doc_id, r.text) for r in df.collect()], 4096)
    assert n <= 1.02 * -(-sum(r.length for r in rows) // 4096) + 1


def greedy(lengths, capacity):
    """Best fit, longest first, one piece at a time."""
    room = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= x]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= x
        else:
            room.append(capacity - x)
    return len(room)


@pytest.mark.parametrize("seed", range(6))
def test_plan_against_one_at_a_time(seed):
    rnd = np.random.default_rng(seed)
    lengths = rnd.integers(1, 101, 2000) if seed % 2 else np.minimum(100, rnd.geometric(0.05, 2000))
    hist = np.bincount(lengths, minlength=101)
    runs = pk.plan(hist, 100)
    used, filled = np.zeros(101, int), defaultdict(list)
    for length, first, count, seq, offset in runs.tolist():
        assert first == used[length]
        used[length] += count
        for s in range(seq, seq + count):
            filled[s].append((offset, length))
    assert (used == hist).all()
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 100
    assert len(filled) <= greedy(lengths.tolist(), 100) * 1.02 + 1


def test_fit_uses_patterns():
    hist = np.zeros(101, int)
    hist[[60, 40, 50]] = [1000, 1000, 600]
    every = pk.patterns(np.flatnonzero(hist), 100)
    fit = pk.repeats(every, hist.astype(float))
    assert fit.min() >= 0
    used = np.zeros(101)
    for p, x in zip(every, fit):
        for length in p[p > 0]:
            used[length] += x
    assert abs(used[[60, 40, 50]] - [1000, 1000, 600]).max() < 5
    runs = pk.plan(hist, 100)
    assert (runs[:, 3] + runs[:, 2]).max() == 1300
