"""Minimum-cost role repair of conversations, and their rendering.

A legal conversation may open with a system turn, and then user and assistant
take turns, user first.  Dynamic programming over this automaton finds the
cheapest repair of each conversation: a turn is kept, given another role
(relabel), joined to the turn before it (merge), or preceded by empty turns
(insert).  The repaired sequence is rendered with a header for each turn and a
mark at its end.

A conversation is never gathered in one place.  What a run of turns does to the
automaton is a small matrix of least costs (from each state to each state), and
matrices of neighbouring runs combine; so the turns are sorted across tasks, cut
into segments of at most SEGMENT turns, and only the segments' matrices of a
conversation (one row of 16 numbers for 4096 turns) meet, to fix the states
between segments.  Then each segment is repaired on its own.  Ids and roles do
this work; texts are joined back by row number once.

Turns are ordered by (turn, role, hash of the text, row), null turns first.

Defined cases: a null conversation id is one conversation; null or unknown roles
are relabelled at a low cost; null text is empty; repeated rows and tied turns
are turns each; a conversation of a system turn alone gets an empty user turn; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written

SEGMENT = 4096
ROLES = ("system", "user", "assistant")
# Other names of the roles.
NAMES = {"system": ("system", "developer", "instruction"), "user": ("user", "human", "prompter", "customer", "question"),
         "assistant": ("assistant", "bot", "gpt", "ai", "model", "chatbot", "agent", "answer")}
START, UNKNOWN = 3, 3                      # the state before the first turn; a role that is none of ROLES
NEXT = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}      # legal next roles
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 2, 5, 1, 4
HEADER, END = "<|{}|>\n", "<|end|>\n"
FAR = 1 << 40


def step_costs() -> list[list[list[tuple]]]:
    """[role][state][new state]: (cost, action, roles of empty turns before it),
    the cheapest way to place a turn; ties prefer fewer empty turns, then no merge."""
    out = []
    for role in range(4):
        by_state = []
        for state in range(4):
            row = []
            for new in range(4):
                best = (FAR, 0, "", ())
                if new != START:
                    change = 0 if role == new else RELABEL_UNKNOWN if role == UNKNOWN else RELABEL
                    name = "keep" if role == new else "relabel"
                    if state == new:
                        best = min(best, (change + MERGE, 1, "merge" if role == new else "relabel merge", ()))
                    for n in range(3):
                        for path in itertools.product(range(3), repeat=n):
                            walk = (state, *path, new)
                            if all(b in NEXT[a] for a, b in zip(walk, walk[1:])):
                                best = min(best, (change + n * INSERT, 2 * n, name, path))
                row.append((best[0], best[2], best[3]))
            by_state.append(row)
        out.append(by_state)
    return out


STEP = step_costs()
FINISH = {START: (FAR, ()), 0: (INSERT, (1,)), 1: (0, ()), 2: (0, ())}    # cost of ending in a state, empty turns for it


def advance(costs: list[int], role: int) -> list[int]:
    """Least costs of each state after one more turn."""
    by_state = STEP[role]
    return [min(costs[s] + by_state[s][t][0] for s in range(4)) for t in range(4)]


def segment_matrix(roles: list[int]) -> list[int]:
    """Least costs from each state to each state over a run of turns, row by row."""
    out = []
    for s in range(4):
        costs = [FAR] * 4
        costs[s] = 0
        for r in roles:
            costs = advance(costs, r)
        out += [min(c, FAR) for c in costs]
    return out


def boundaries(matrices: list[list[int]]) -> tuple[list[int], int]:
    """States between segments (first START, last the best end) and the total cost."""
    reach = [[FAR, FAR, FAR, 0]]
    for m in matrices:
        reach.append([min(FAR, min(reach[-1][s] + m[4 * s + t] for s in range(4))) for t in range(4)])
    total, state = min((reach[-1][t] + FINISH[t][0], t) for t in range(4))
    states = [state]
    for k in range(len(matrices) - 1, -1, -1):
        m = matrices[k]
        state = min((reach[k][s] + m[4 * s + state], s) for s in range(4))[1]
        states.append(state)
    return states[::-1], total


def repair(roles: list[int], first: int, last: int) -> list[tuple[str, int, tuple]]:
    """(action, new role, roles of empty turns before) of each turn of a run
    that starts in state ``first`` and ends in state ``last``, at the least cost."""
    reach = [[0 if s == first else FAR for s in range(4)]]
    for r in roles:
        reach.append(advance(reach[-1], r))
    out, state = [], last
    for k in range(len(roles) - 1, -1, -1):
        by_state = STEP[roles[k]]
        before = min((reach[k][s] + by_state[s][state][0], s) for s in range(4))[1]
        _, action, inserted = by_state[before][state]
        out.append((action, state, inserted))
        state = before
    return out[::-1]


def opening(action: str, role: int, inserted: tuple, opens: bool) -> str:
    """What is rendered before a turn's text; ``opens``: it is the conversation's first."""
    if action.endswith("merge"):
        return "\n\n"
    turns = [HEADER.format(ROLES[r]) for r in (*inserted, role)]
    return ("" if opens else END) + END.join(turns)


def closing(state: int) -> str:
    """What is rendered after a conversation's last text."""
    return END + "".join(HEADER.format(ROLES[r]) + END for r in FINISH[state][1])


def role_code(role: Column) -> Column:
    name, code = F.lower(F.trim(role)), F.lit(UNKNOWN)
    for i, r in enumerate(ROLES):
        code = F.when(name.isin(*NAMES[r]), i).otherwise(code)
    return code.cast("long")


# ---- in Spark ---------------------------------------------------------------

def runs(keys: Iterator[tuple]) -> Iterator[tuple[tuple, list]]:
    """Consecutive rows (key, value) with equal keys, at most SEGMENT at a time."""
    held, now = [], None
    for key, value in keys:
        if held and (key != now or len(held) == SEGMENT):
            yield now, held
            held = []
        now = key
        held.append(value)
    if held:
        yield now, held


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    while part := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def mapped(df: DataFrame, make, schema: T.StructType) -> DataFrame:
    """``make`` turns the rows of a partition, in order, into rows of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: in_batches(make(rows_of(batches)), arrow), schema)


def struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def format_chats(spark: SparkSession, turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """(conv_id, turn, role, ord, action, new_role, inserted, cost, rendered), a row
    for each turn: ``ord`` orders the rows of a conversation, ``inserted`` names the
    empty turns before the row, ``cost`` is the conversation's, and the ``rendered``
    parts of a conversation joined in order are its rendering."""
    source = written(spark, turns.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                                         F.col(text).alias("text"), F.monotonically_increasing_id().alias("row")), "chat-turns")
    kind = source.schema["conv"].dataType
    narrow = source.select("conv", "turn", F.coalesce("role", F.lit("")).alias("role"), F.xxhash64("text").alias("h"), "row", role_code(F.col("role")).alias("code"))
    order = ["conv", "turn", "role", "h", "row"]
    in_order = narrow.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "code", "row")

    def cut(rows):
        at, place = TaskContext.get().partitionId(), 0
        for k, (conv, held) in enumerate(runs((r[0], r[1:]) for r in rows)):
            codes = [c for c, _ in held]
            for i, (code, row) in enumerate(held):
                yield conv, code, row, at, k, place, segment_matrix(codes) if i == len(held) - 1 else None
                place += 1

    long = T.LongType()
    segments = written(spark, mapped(in_order, cut, struct(conv=kind, code=long, row=long, part=long, segment=long, place=long,
                                                           matrix=T.ArrayType(long))), "chat-segments")

    def meet(rows):
        for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
            held = [(part, segment, matrix) for _, part, segment, matrix in group]
            states, cost = boundaries([m for _, _, m in held])
            for k, (part, segment, _) in enumerate(held):
                yield part, segment, states[k], states[k + 1], k == len(held) - 1, cost

    ends = segments.where("matrix is not null").select("conv", "part", "segment", "matrix")
    ends = mapped(ends.repartition("conv").sortWithinPartitions("conv", "part", "segment"), meet,
                  struct(part=long, segment=long, first=long, last=long, final=T.BooleanType(), cost=long))

    def mend(rows):
        for (part, _), group in itertools.groupby(rows, key=lambda r: r[:2]):
            held = list(group)                                       # at most SEGMENT rows
            first, last, final, cost = held[0][5:]
            done = repair([r[3] for r in held], first, last)
            for k, (r, (action, new, inserted)) in enumerate(zip(held, done)):
                before = opening(action, new, inserted, k == 0 and first == START)
                after = closing(last) if final and k == len(held) - 1 else ""
                yield r[4], (part << 33) + r[2], action, ROLES[new], ",".join(ROLES[i] for i in inserted), cost, before, after

    text_type = T.StringType()
    joined = segments.join(ends, ["part", "segment"]).select("part", "segment", "place", "code", "row", "first", "last", "final", "cost")
    joined = joined.repartition("part", "segment").sortWithinPartitions("part", "segment", "place")
    mended = mapped(joined, mend, struct(row=long, ord=long, action=text_type, new_role=text_type, inserted=text_type, cost=long,
                                         before=text_type, after=text_type))
    out = source.join(mended, "row")
    return out.select(F.col("conv").alias(conv_id), F.col("turn").alias(turn), F.col("role").alias(role), "ord", "action", "new_role",
                      "inserted", "cost", F.concat("before", F.coalesce("text", F.lit("")), "after").alias("rendered"))


def op7_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark, table(spark, sf_dir, "conversations"))
