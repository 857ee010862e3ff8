import functools
import random
import re

import pytest

from tickloom.llm import chat_repair as cr

LEGAL = re.compile(r"(s?(ua)*u?)$")


def code(role):
    name = (role or "").strip().lower()
    return next((i for i, r in enumerate(cr.ROLES) if name in cr.NAMES[r]), cr.UNKNOWN)


def brute_cost(roles):
    """Least cost by trying every action at every turn."""
    @functools.cache
    def best(k, state):
        if k == len(roles):
            return {cr.START: cr.FAR, 0: cr.INSERT}.get(state, 0)
        options = []
        for n in range(3):
            for new in range(3):
                change = 0 if roles[k] == new else cr.RELABEL_UNKNOWN if roles[k] == cr.UNKNOWN else cr.RELABEL
                if n == 0 and new == state:
                    options.append(change + cr.MERGE + best(k + 1, new))
                reach = {state}
                for _ in range(n):
                    reach = {b for a in reach for b in cr.NEXT[a]}
                if any(new in cr.NEXT[a] for a in reach):
                    options.append(change + n * cr.INSERT + best(k + 1, new))
        return min(options)
    for k in range(len(roles), 0, -200):        # fill the cache from the end: no deep recursion
        best(k, 1)
        best(k, 2)
        best(k, 0)
    return best(0, cr.START)


def parsed(rendered):
    """(role, text) of each turn of a rendering."""
    out = []
    assert rendered.endswith(cr.END)
    for part in rendered[:-len(cr.END)].split(cr.END):
        m = re.match(r"<\|(system|user|assistant)\|>\n(.*)", part, re.S)
        out.append((m[1], m[2]))
    return out


def check(rows, turns):
    by_conv, want = {}, {}
    for r in rows:
        by_conv.setdefault(r.conv_id, []).append(r)
    for c, t, role, text in turns:
        want.setdefault(c, []).append((t if t is not None else -10 ** 9, role or "", text or ""))
    assert set(by_conv) == set(want)
    for c, part in by_conv.items():
        part.sort(key=lambda r: r.ord)
        seen = [(r.turn if r.turn is not None else -10 ** 9, r.role or "") for r in part]
        assert seen == sorted(seen) == sorted((t, r) for t, r, _ in want[c])
        out = parsed("".join(r.rendered for r in part))
        assert re.fullmatch(LEGAL, "".join(r[0] for r, _ in out)) and out[-1][0] != "system", out
        texts = [x for _, text in out for x in text.split("\n\n") if x]
        assert sorted(texts) == sorted(x for _, _, x in want[c] if x)
        roles = [code(r) for _, r in seen]
        assert {r.cost for r in part} == {brute_cost(tuple(roles))}
        paid = sum((cr.MERGE if "merge" in r.action else 0) + len([x for x in r.inserted.split(",") if x]) * cr.INSERT
                   + ((cr.RELABEL_UNKNOWN if code(r.role) == cr.UNKNOWN else cr.RELABEL) if "relabel" in r.action else 0) for r in part)
        assert paid + (cr.INSERT if part[-1].new_role == "system" else 0) == part[0].cost


def run(spark, turns):
    df = spark.createDataFrame([(*t, 1, "x") for t in turns], "conv_id long, turn long, role string, text string, ord int, cost string")
    return cr.format_chats(spark, df).collect()


@pytest.mark.parametrize("segment", [3, 4096])
def test_against_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rnd = random.Random(segment)
    names = ["system", "user", "assistant", "Human", " GPT ", None, "tool", "", "user", "assistant"]
    turns = [(c, t, rnd.choice(names), f"w{c}.{t}") for c in range(150) for t in range(rnd.randrange(1, 14))]
    turns += [(None, 1, "user", "no id"), (None, 2, "user", "no id 2"), (7000, None, "user", None), (7000, 1, "assistant", ""),
              (7001, 1, "user", "tie a"), (7001, 1, "user", "tie b"), (7001, 1, "assistant", "tie c"), (7002, 0, "system", "alone"),
              (7003, 0, "user", "same"), (7003, 0, "user", "same"), (7003, 0, "user", "same")]
    rnd.shuffle(turns)
    check(run(spark, turns), turns)


def test_hot_conversation_is_spread(spark, monkeypatch):
    monkeypatch.setattr(cr, "SEGMENT", 16)
    rnd = random.Random(2)
    turns = [(1, t, rnd.choice(["user", "assistant"]), f"t{t}") for t in range(1500)] + [(2, 0, "user", "hi"), (2, 1, "assistant", "yes")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # or few rows make one task
    try:
        rows = run(spark, turns)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    check(rows, turns)
    assert len({r.ord >> 33 for r in rows if r.conv_id == 1}) > 1


def test_legal_conversations_stay(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "user", "q")]
    rows = run(spark, turns)
    assert {r.action for r in rows} == {"keep"} and {r.cost for r in rows} == {0}
    text = "".join(r.rendered for r in sorted((r for r in rows if r.conv_id == 1), key=lambda r: r.ord))
    assert text == "<|system|>\ns<|end|>\n<|user|>\nu<|end|>\n<|assistant|>\na<|end|>\n"


def test_generated_and_empty_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = cr.format_chats(spark, df).collect()
    check(rows, [(r.conv_id, r.turn, r.role, r.text.replace("\n\n", "\n")) for r in df.collect()])
    assert cr.format_chats(spark, df.limit(0)).collect() == []


def test_matrices_combine():
    rnd = random.Random(3)
    roles = [rnd.randrange(4) for _ in range(40)]
    a, b, whole = cr.segment_matrix(roles[:17]), cr.segment_matrix(roles[17:]), cr.segment_matrix(roles)
    both = [min(cr.FAR, min(a[4 * s + m] + b[4 * m + t] for m in range(4))) for s in range(4) for t in range(4)]
    assert both == whole
