import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tickloom.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth int, conv string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), role, hashlib.sha256(text.encode()).hexdigest(), text))
    own = {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + x[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    if not convs:
        return []
    members, ends = defaultdict(list), defaultdict(list)
    for c, x in convs.items():
        for d in range(len(x) + 1):
            members[tuple(x[:d])].append(c)
        ends[tuple(x)].append(c)
    leaves, saved, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(m) - 1) * words
            leaves[node[:d]] += node not in children
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children.get(node, 0), leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()) for node, m in members.items())


def key(r):
    return tuple(-1 if x is None else x for x in r)


def check(spark, rows):
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in pt.trie(spark, df).collect()), key=key)
    assert got == sorted(brute(rows), key=key)
    return got


def made(rnd, n, longest, kinds=2):
    rows = []
    for c in range(n):
        for t in range(rnd.randrange(longest + 1)):
            rows.append((c * rnd.choice([1, 1, 3]), t, rnd.choice(["user", "assistant", None]) if rnd.random() < 0.1 else ["user", "assistant"][t % 2],
                         rnd.choice([None, "", " a\tb ", "one two  three\x0bfour\x85five"][:kinds + 1])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = made(rnd, 70, 12 if seed else 30, 1 + seed)
    rows += [(None, 0, "user", "lost"), (-41, 2, "user", "negative"), (-41, None, "user", "null turn first"), (-57, 1, "user", "x y")]
    check(spark, rows + rows[:5])


def test_deep_levels_and_spans(spark, monkeypatch):
    rnd = random.Random(7)
    monkeypatch.setattr(pt, "BLOCK", 2)
    monkeypatch.setattr(pt, "SEGMENT", 4)
    monkeypatch.setattr(pt, "SPAN", 5)
    monkeypatch.setattr(pt, "PIECE", 3)
    path = [(["user", "assistant"][t % 2], f"turn {t} of the long path") for t in range(90)]
    rows = [(c, t, *path[t]) for c in range(0, 400, 20) for t in range(rnd.choice([0, 1, 3, 4, 8, 16, 17, 64, 65, 90]))]
    rows += [(c, t, *path[t]) if t != 40 else (c, t, "user", "another way") for c in (501, 502, 503) for t in range(70)]
    check(spark, rows)


def test_copies_and_turnless(spark):
    rows = [(c, t, "user", "same words") for c in range(0, 6000, 20) for t in range(2)]       # one large group of copies
    rows += [(c, 0, "user", "gone") for c in range(9001, 9020)]                                # their family's first is absent
    got = check(spark, rows)
    assert len(got) < 30


def test_empty_table(spark):
    assert check(spark, []) == []
    assert check(spark, [(None, 0, "user", "x")]) == []
    only = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    assert len(check(spark, [(only, 0, "user", "x")])) == 1                                    # a root alone


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in pt.op12_prefix_trie(spark, "/root/testdata/sf0.001").collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def test_sql_twin(spark):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    rows = made(random.Random(11), 60, 9, 3) + [(c, 0, "user", "gone") for c in (-5, 901, 902, 903)] + [(None, 0, "user", "x")]
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    columns = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    assert sorted(con.execute(f"SELECT {columns} FROM ({pt.OP12_SQL})").fetchall(), key=key) == sorted(brute(rows), key=key)
