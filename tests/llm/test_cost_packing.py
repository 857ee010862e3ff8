import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tickloom.llm import cost_packing as cp
from tickloom.llm.packing import default_tokenizer

TEXTS = [None, "", " \n", "Hello world", "I'm İ ΣΑΣ <|endoftext|> x² ½ don't", "日本語 text \x85 here", "word " * 9000, "word " * 2047, "word " * 2048,
         "a--b..c!!'s", "one two three four five six seven eight"]


@pytest.fixture(scope="module")
def reference_ids():
    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def check_rows(rows, docs, capacity, ids_of):
    """Every id lies in one piece, checksums hold, and sequences are gapless and need no padding."""
    ids = defaultdict(list)
    for i, t in docs:
        ids[i].append(ids_of(t))
    want, got = defaultdict(int), defaultdict(int)
    for i, own in ids.items():
        for x in own:
            for at in range(len(x)):
                want[i, len(x), at] += 1
    by_seq = defaultdict(list)
    for r in rows:
        part = [x[r.start:r.start + r.length] for x in ids[r.doc_id] if len(x) == r.doc_tokens]
        assert any(zlib.crc32(np.array(p, "<u4").tobytes()) == r.ids_crc32 for p in part)
        for at in range(r.start, r.start + r.length):
            got[r.doc_id, r.doc_tokens, at] += 1
        by_seq[r.sequence_id].append((r.offset, r.length, r.sequence_tokens))
    assert got == want
    for held in by_seq.values():
        at = 0
        for offset, length, _ in sorted(held):
            assert offset == at
            at += length
        assert {t for _, _, t in held} == {at}
        assert at == capacity or at & (at - 1) == 0
    return by_seq


@pytest.mark.parametrize("capacity", [64, 100, 2048])
def test_round_trip(spark, capacity, reference_ids):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (3, TEXTS[3]), (None, "no id"), (None, "no id")]
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in docs], "doc_id long, text string, length int, row int")
    rows = cp.pack(spark, df, capacity=capacity).collect()
    if capacity == 100:
        assert sum(r.length for r in rows) == sum(len(reference_ids(t)) for _, t in docs)
    else:
        check_rows(rows, docs, capacity, reference_ids)


def test_empty_table(spark):
    assert cp.pack(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_whole_table(spark, reference_ids):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = cp.op13_cost_packing(spark, "/root/testdata/sf0.001").collect()
    by_seq = check_rows(rows, [(r.doc_id, r.text) for r in df.collect()], 2048, reference_ids)
    total = sum(r.length for r in rows)
    assert len(by_seq) == total // 2048 + (total % 2048).bit_count()


def one_at_a_time(lengths, capacity, width):
    """The rule, document by document: costs of the sequences."""
    full, rest = divmod(sum(lengths), capacity)
    room = [capacity] * full + [1 << b for b in range(capacity.bit_length()) if rest >> b & 1]
    spent = [0] * len(room)
    todo = defaultdict(int)
    for x in lengths:
        todo[x] += 1
    for n in range(max(lengths), 0, -1):
        for _ in range(todo[n]):
            fits = [i for i, r in enumerate(room) if r >= n]
            i = min(fits, key=lambda i: (spent[i], -room[i])) if fits else max(range(len(room)), key=lambda i: (room[i], -spent[i]))
            part = min(n, room[i])
            room[i] -= part
            spent[i] += cp.cost(part, width)
            if part < n:
                todo[n - part] += 1
    return sorted(spent)


@pytest.mark.parametrize("seed", range(6))
def test_plan_against_one_at_a_time(seed):
    rnd = np.random.default_rng(seed)
    lengths = rnd.integers(1, 65, 900) if seed % 2 else np.minimum(64, rnd.geometric(0.08, 900))
    hist = np.bincount(lengths, minlength=65)
    runs = cp.plan(hist, 64, 10)
    parts, spent = defaultdict(list), defaultdict(int)
    for length, rank, count, cut, start, size, first, offset in runs.tolist():
        for i in range(count):
            parts[length, rank + i].append((cut, start, size))
            spent[first + i] += cp.cost(size, 10)
    assert sorted(parts) == [(n, r) for n in range(65) for r in range(hist[n])]
    for (length, _), held in parts.items():
        at = 0
        for k, (cut, start, size) in enumerate(sorted(held)):
            assert (cut, start) == (k, at)
            at += size
        assert at == length
    brute = one_at_a_time(lengths.tolist(), 64, 10)
    assert len(spent) == len(brute)
    full = sum(lengths) // 64
    assert max(spent.values()) <= 1.05 * max(brute) and abs(np.std(list(spent.values())) - np.std(brute)) <= 0.25 * np.std(brute)
    rows = np.array(sorted(parts))
    found = defaultdict(list)
    for at, run in cp.find(cp.places(runs), rows[:, 0], rows[:, 1]):
        for i, r in zip(at, run):
            found[tuple(rows[i])].append((r[3], r[4], r[5]))
    assert found == {k: sorted(v) for k, v in parts.items()} and full > 0


def test_costs_are_more_even_than_by_length_alone():
    rnd = random.Random(3)
    lengths = [min(1200, int(rnd.lognormvariate(5.5, 0.8)) + 1) for _ in range(4000)]      # none fills a sequence alone
    spent = defaultdict(int)
    for length, rank, count, cut, start, size, first, offset in cp.plan(np.bincount(lengths, minlength=2049), 2048).tolist():
        for i in range(first, first + count):
            spent[i] += size * size
    full = sum(lengths) // 2048
    mine = [spent[i] for i in range(full)]
    first_fit, room = defaultdict(int), []
    for n in sorted(lengths, reverse=True):
        i = next((i for i, r in enumerate(room) if r >= n), len(room))
        if i == len(room):
            room.append(2048)
        room[i] -= n
        first_fit[i] += n * n
    assert np.std(mine) / np.mean(mine) < 0.6 * np.std(list(first_fit.values())) / np.mean(list(first_fit.values()))
