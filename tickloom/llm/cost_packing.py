"""Cost-balanced packing: documents go, in descending order of their attention
cost, to the sequence of lowest cost that still has room for them.

The cost of a piece of n tokens is ``6 * width * n + n**2``: what is linear in the
tokens (projections, feed-forward) against the attention between them.  It grows
with n, so descending cost is descending length, and sequences in the same state
(cost, room) are held as one run: only the histogram of lengths (at most
``capacity`` rows) reaches the driver, and the plan's size depends on ``capacity``,
not on the number of documents.

There are as many sequences as the tokens fill exactly: full ones, and one for each
binary digit of the rest, as a power of two needs no padding.  So nothing is padded.
Documents longer than ``capacity`` are cut into as few pieces as can be, of equal
length, which keeps their squared terms low.  Another piece is cut only where no
sequence has room for the whole of it: it fills up the largest room there is, and
what is left of it waits for its turn among the shorter ones.

Texts are tokenised where they lie and never shuffled.  Ids are written with the
pieces; those of lengths that are cut again are read once more for the checksums of
their parts.  A piece's rank within its length is its rank within its task's, counted
as it is written, plus what other tasks have of that length.

Defined cases: null and empty texts are the end-of-text id alone; repeated rows are
packed each; pieces of equal length are ranked as they were written; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_small_batches, table, written
from .packing import END_ID, default_tokenizer, word_ids

CAPACITY = 2048
WIDTH = 1024          # of the model whose attention cost is estimated
LONG, BYTES = T.LongType(), T.BinaryType()


def cost(n: int, width: int = WIDTH) -> int:
    """Estimated work of a piece of ``n`` tokens that attend to each other, in products per layer and unit of width."""
    return 6 * width * n + n * n


# ---- pieces -----------------------------------------------------------------

def equal_cuts(n: int, capacity: int) -> list[int]:
    """Where the pieces of a document of ``n`` tokens begin and end."""
    k = -(-n // capacity)
    return [n * i // k for i in range(k + 1)]


def pieces(docs: DataFrame, doc_id: str, text: str, tokenizer: str, capacity: int) -> DataFrame:
    """(doc, row, task, place, start, length, doc_tokens, crc, ids): ``row`` numbers all pieces, ``place``
    those of a task that are equal in length."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    end = np.array([END_ID], "<u4").tobytes()
    schema = T.StructType([T.StructField("doc", source.schema["doc"].dataType), *[T.StructField(c, LONG) for c in (
        "row", "task", "place", "start", "length", "doc_tokens", "crc")], T.StructField("ids", BYTES)])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, task, row = word_ids(tokenizer), TaskContext.get().partitionId(), 0
        seen = [0] * (capacity + 1)
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                out: list[tuple] = []
                for doc, ids in zip(part.column(0).to_pylist(), ids_of(part.column(1).to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    cut = equal_cuts(n, capacity)
                    short = np.frombuffer(ids, "<u4")
                    short = short.astype("<u2") if short.max() < 1 << 16 else short          # two bytes an id where they do
                    for a, z in zip(cut, cut[1:]):
                        out.append((doc, (task << 33) + row, task, seen[z - a], a, z - a, n, zlib.crc32(ids[4 * a:4 * z]), short[a:z].tobytes()))
                        seen[z - a] += 1
                        row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return in_small_batches(source).mapInArrow(run, schema)


def part_sums(ids: bytes, length: int, start: int, size: int) -> int:
    """The checksum of ``size`` of the piece's ids."""
    held = np.frombuffer(ids, "<u2" if len(ids) == 2 * length else "<u4")[start:start + size]
    return zlib.crc32(held.astype("<u4").tobytes())


# ---- plan -------------------------------------------------------------------

def plan(histogram: np.ndarray, capacity: int, width: int = WIDTH) -> np.ndarray:
    """Runs (length, first rank, count, cut, start, size, first sequence, offset): ``count`` pieces of a length,
    by rank, of which ``size`` tokens from ``start`` go to the sequences from the first on, one each.  ``cut``
    numbers the parts of a piece."""
    total = int((np.arange(len(histogram)) * histogram).sum())
    full, rest = divmod(total, capacity)
    order: list[tuple[int, int, int, int, int]] = []                     # eligible: (cost, -room, first, count, capacity)
    waiting: dict[int, list[tuple[int, int, int, int]]] = {}             # too little room as yet: room -> (cost, first, count, capacity)
    sizes = [(capacity, full)] + [(1 << b, 1) for b in reversed(range(capacity.bit_length())) if rest >> b & 1]
    first = 0
    for size, count in sizes:
        if count:
            waiting.setdefault(size, []).append((0, first, count, size))
            first += count
    runs: list[tuple[int, ...]] = []
    left: dict[int, list[tuple[int, int, int, int, int]]] = {}           # by what is left: (length, first rank, count, cut, start)
    for n in range(capacity, 0, -1):
        for c, f, m, size in waiting.pop(n, ()):
            heapq.heappush(order, (c, -n, f, m, size))
        todo = left.pop(n, [])
        if histogram[n]:
            todo.append((n, 0, int(histogram[n]), 0, 0))
        while todo:
            length, rank, count, cut, start = todo.pop()
            if order:                                                    # the lowest cost with room for the whole
                c, room, f, m, size = heapq.heappop(order)
                room, part = -room, n
            else:                                                        # none has: the largest room there is
                room = part = max(waiting)
                at = min(range(len(waiting[room])), key=waiting[room].__getitem__)
                c, f, m, size = waiting[room].pop(at)
                if not waiting[room]:
                    del waiting[room]
            k = min(count, m)
            runs.append((length, rank, k, cut, start, part, f, size - room))
            if k < m and part == n:
                heapq.heappush(order, (c, -room, f + k, m - k, size))
            elif k < m:
                waiting.setdefault(room, []).append((c, f + k, m - k, size))
            if part < n:
                left.setdefault(n - part, []).append((length, rank, k, cut + 1, start + part))
            if count > k:
                todo.append((length, rank + k, count - k, cut, start))
            room, c = room - part, c + cost(part, width)
            if room >= n:
                heapq.heappush(order, (c, -room, f, k, size))
            elif room:
                waiting.setdefault(room, []).append((c, f, k, size))
    assert not order and not waiting                                     # there is just as much room as tokens
    return np.array(runs, np.int64).reshape(-1, 8)


def places(runs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For the first, second, ... part of a piece the runs and their sorted keys (length, first rank)."""
    out = []
    for cut in range(int(runs[:, 3].max(initial=-1)) + 1):
        own = runs[runs[:, 3] == cut]
        own = own[np.lexsort((own[:, 1], own[:, 0]))]
        out.append((own[:, 0] << 44 | own[:, 1], own))
    return out


def find(placed: list[tuple[np.ndarray, np.ndarray]], length: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their runs) for the first parts of pieces, then for the second parts of those that have any, ..."""
    for key, runs in placed:
        at = np.searchsorted(key, length << 44 | rank, side="right") - 1
        run = runs[np.maximum(at, 0)]
        rows = np.flatnonzero((at >= 0) & (run[:, 0] == length) & (rank < run[:, 1] + run[:, 2]))
        yield rows, run[rows]


# ---- packing ----------------------------------------------------------------

def pack(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY, width: int = WIDTH) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens), a row for each piece."""
    cut = written(spark, pieces(docs, doc_id, text, tokenizer or default_tokenizer(), capacity), "cost-pieces")
    counts = written(spark, cut.groupBy("task", "length").agg(F.count("*").alias("n")), "cost-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():          # at most ``capacity`` rows
        histogram[r["length"]] = r["n"]
    runs = plan(histogram, capacity, width)
    total = int((np.arange(capacity + 1) * histogram).sum())
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)      # a row for each task
    shift = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    names = ["doc", "row", "start", "length", "doc_tokens", "crc"]
    ranked = cut.join(shift, ["task", "length"]).select(*names, (F.col("place") + F.col("shift")).alias("rank"))
    shared = spark.sparkContext.broadcast(places(runs))                              # bounded by ``capacity``

    added = ["part_start", "part_length", "sequence_id", "offset"]
    schema = T.StructType([*ranked.schema.fields[:-1], *[T.StructField(c, LONG) for c in added]])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(3).to_numpy(zero_copy_only=False), b.column(6).to_numpy(zero_copy_only=False)
            for rows, run in find(shared.value, length, rank):
                sequence = run[:, 6] + rank[rows] - run[:, 1]
                new = [pa.array(x) for x in (run[:, 4], run[:, 5], sequence, run[:, 7])]
                kept = [c.take(pa.array(rows)) for c in b.columns[:6]]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=[*names, *added])

    placed = written(spark, ranked.mapInArrow(place, schema), "cost-placed")
    whole = placed.where("part_length = length").select("doc", "start", "length", "crc", "doc_tokens", "sequence_id", "offset")
    again = sorted({int(n) for n in runs[runs[:, 5] < runs[:, 0], 0]})              # lengths of which some are cut: at most ``capacity``
    ids = cut.where(F.col("length").isin(again)).select("row", "ids")
    parts = placed.where("part_length < length").join(ids, "row").select(
        "doc", "start", "length", "doc_tokens", "sequence_id", "offset", "part_start", "part_length", "ids")

    result = whole.columns

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, start, size, held = (b.column(i).to_pylist() for i in (2, 6, 7, 8))
            sums = [part_sums(*x) for x in zip(held, length, start, size)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.add(b.column(1).to_numpy(zero_copy_only=False), start), pa.int64()), b.column(7),
                                              pa.array(sums, pa.int64()), b.column(3), b.column(4), b.column(5)], names=result)

    every = whole.unionByName(in_small_batches(parts).mapInArrow(checked, whole.schema))
    full = total // capacity
    rest = F.element_at(F.array(*[F.lit(1 << b) for b in reversed(range(capacity.bit_length())) if (total - full * capacity) >> b & 1] or [F.lit(0)]),
                        F.greatest(F.col("sequence_id") - full + 1, F.lit(1)).cast("int"))
    tokens = F.when(F.col("sequence_id") < full, capacity).otherwise(rest).cast("long")
    return every.select(F.col("doc").alias(doc_id), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
                        tokens.alias("sequence_tokens"))


def op13_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"))
