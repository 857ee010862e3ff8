"""Best-fit packing by patterns: few-document length patterns are enumerated,
their repeat counts are fitted to the histogram of lengths by non-negative
least squares and rounded, and what is left is packed best fit, longest first.

All work on rows is Spark's: texts are tokenised where they lie, pieces are
ranked within their length, and a row finds its sequence from (length, rank).
Only the histogram (at most ``capacity`` rows) reaches the driver, and only
the packing plan goes back: runs (length, first rank, count, first sequence,
offset).  The plan's size depends on ``capacity`` alone: at most 34 patterns of
four runs for each length, and a few runs for each length from the residual.

Defined cases: null and empty texts are the end-of-text id alone; repeated rows
are packed each; ties in length are ranked by (doc_id, piece, checksum), and
rows equal in all of these are interchangeable; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, table, written

CAPACITY = 4096
END_ID = 1
SLACK = 16            # a pattern may leave so many tokens of a sequence free
ROUNDS = 600          # of the least-squares iteration
WORDS_HELD = 300_000  # stretches and words of a generation whose ids a Python worker remembers


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# ---- tokens -----------------------------------------------------------------

# Texts of these characters are unchanged by the vocabulary's NFC step and have
# one lower-case form for each character.
PLAIN = r"[\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u017f]*"
# The vocabulary's split pattern, over PLAIN characters.
LETTERS, NUMBERS = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+"


def byte_letters() -> dict[int, str]:
    """For each character of the plain range the letters that stand for its
    UTF-8 bytes in the vocabulary: printable bytes of Latin-1 stand for
    themselves, the others are numbered from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    letter = [chr(b if b in own else next(rest)) for b in range(256)]
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x80, 0x180)}


class Remembered(dict):
    """What ``find`` gives for a key, remembered in two generations: when ``held``
    keys were new or asked for again, those not asked for since the last such
    moment are let go."""

    def __init__(self, find, held: int):
        self.find, self.held, self.old = find, held, {}

    def __missing__(self, key):
        if len(self) >= self.held:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.find(key)
        self[key] = value
        return value


class WordIds:
    """Token ids of whole texts as little-endian 32-bit bytes.

    The vocabulary's split pattern never crosses white space and its merges
    never cross words, so the ids of a stretch between white space are found
    once and remembered; of its words, those that are not a stretch by
    themselves.  Texts with characters outside PLAIN, or with the marks of
    special tokens, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.plain, self.letters, self.model = re.compile(PLAIN), byte_letters(), self.tokenizer.model
        self.split = re.compile(SPLIT).findall
        self.known = Remembered(self.stretch, WORDS_HELD)

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def stretch(self, s: str) -> bytes:
        parts = self.split(s)
        if len(parts) > 1:
            return b"".join([self.known[p] for p in parts])
        found = self.model.tokenize(s if s.isascii() else s.translate(self.letters))
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def __call__(self, texts: list[str]) -> list[bytes]:
        ids = self.known.__getitem__
        plain = [(t.isascii() and t.isprintable() or self.plain.fullmatch(t)) and "<|" not in t for t in texts]
        out = [b"".join(map(ids, t.lower().split())) if p else b"" for t, p in zip(texts, plain)]
        odd = [i for i, p in enumerate(plain) if not p]
        for i, found in zip(odd, self.whole([texts[i] for i in odd])):
            out[i] = found
        return out


def word_ids(path: str) -> WordIds:
    """The one WordIds of this Python worker, which serves many tasks."""
    held = sys.modules.setdefault("tickloom_word_ids", types.ModuleType("tickloom_word_ids"))
    if path not in vars(held):
        vars(held)[path] = WordIds(path)
    return vars(held)[path]


def pieces(docs: DataFrame, doc_id: str, text: str, tokenizer: str, capacity: int) -> DataFrame:
    """(doc_id, piece, length, ids_crc32): a row for each piece of a document."""
    end = np.array([END_ID], "<u4").tobytes()

    def make():
        ids_of = word_ids(tokenizer)

        def work(texts: list[str]) -> list[list]:
            lengths, sums = [], []
            for at in range(0, len(texts), 64):
                for ids in ids_of(texts[at:at + 64]):
                    view = memoryview(ids + end)
                    cut = [view[i:i + 4 * capacity] for i in range(0, len(view), 4 * capacity)]
                    lengths.append([len(c) // 4 for c in cut])
                    sums.append([zlib.crc32(c) for c in cut])
            return [lengths, sums]
        return work

    out = T.StructType([T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("sums", T.ArrayType(T.LongType()))])
    rows = map_texts(docs, [doc_id], text, out, make).select(
        F.col(doc_id), F.posexplode(F.arrays_zip("lengths", "sums")).alias("piece", "p"))
    return rows.select(F.col(doc_id), "piece", F.col("p.lengths").alias("length"), F.col("p.sums").alias("ids_crc32"))


# ---- plan -------------------------------------------------------------------

def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns of one to four documents that fill a sequence up to SLACK
    tokens: rows of descending lengths, 0 for none.

    Each length leads; second and third members are taken evenly spaced from the
    lengths that still fit, and the last member is the longest that fits."""
    size = np.sort(lengths)
    last_fit = np.searchsorted(size, np.arange(capacity + 1), side="right") - 1      # index of the longest <= x

    def best(room):
        at = last_fit[np.maximum(room, 0)]
        return np.where(at >= 0, size[at], 0)

    def spread(room, n):
        top = last_fit[np.maximum(room, 0)]
        at = (top[:, None] * (np.arange(n)[None, :] + 1)) // n
        return np.where(top[:, None] >= 0, size[np.maximum(at, 0)], 0)

    a = size[::-1]
    rest = capacity - a
    found = [np.stack((a, 0 * a, 0 * a, 0 * a), 1), np.stack((a, best(rest), 0 * a, 0 * a), 1)]
    second = spread(rest, 16)
    a2, b2 = np.repeat(a, 16), second.ravel()
    found.append(np.stack((a2, b2, best(capacity - a2 - b2), 0 * a2), 1))
    second = spread(rest, 4)                     # 1 + 1 + 16 + 4 * 4 = 34 for each length
    a3, b3 = np.repeat(a, 4), second.ravel()
    third = spread(capacity - a3 - b3, 4)
    a4, b4, c4 = np.repeat(a3, 4), np.repeat(b3, 4), third.ravel()
    found.append(np.stack((a4, b4, c4, best(capacity - a4 - b4 - c4)), 1))
    every = np.sort(np.concatenate(found), axis=1)[:, ::-1]
    filled = every.sum(axis=1)
    every = np.unique(every[(filled <= capacity) & (filled >= capacity - SLACK)], axis=0)
    return every


def repeats(pattern: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative least squares: how often each pattern is used so that the
    lengths used come closest to the histogram (multiplicative updates keep the
    counts non-negative)."""
    rows = np.repeat(np.arange(len(pattern)), pattern.shape[1])
    cols = pattern.ravel()
    rows, cols = rows[cols > 0], cols[cols > 0]
    target = np.bincount(rows, histogram[cols], len(pattern))
    x = np.bincount(rows, histogram[cols] / np.maximum(1, np.bincount(cols, minlength=len(histogram)))[cols], len(pattern)) / 4
    x *= 0.5 ** (pattern.sum(axis=1).max(initial=0) - pattern.sum(axis=1))      # full patterns start ahead
    for _ in range(ROUNDS):
        used = np.bincount(cols, x[rows], len(histogram))
        x *= target / np.maximum(np.bincount(rows, used[cols], len(pattern)), 1e-12)
    return x


def plan(histogram: np.ndarray, capacity: int) -> np.ndarray:
    """Runs (length, first rank, count, first sequence, offset) that place
    ``histogram[length]`` pieces of each length.  The work depends on
    ``capacity``, not on the number of pieces."""
    left, taken = histogram.astype(np.int64).copy(), np.zeros(len(histogram), np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(length, count, first, offset):
        runs.append((length, int(taken[length]), count, first, offset))
        taken[length] += count
        left[length] -= count

    if (histogram > 0).any():
        every = patterns(np.flatnonzero(histogram), capacity)
        fit = repeats(every, histogram.astype(float)) if len(every) else np.zeros(0)
        for i in np.argsort(-fit, kind="stable"):
            if fit[i] < 0.5:
                break
            members = every[i][every[i] > 0]
            sizes, times = np.unique(members, return_counts=True)
            n = min(int(fit[i] + 0.5), int((left[sizes] // times).min()))
            if n:
                offset = 0
                for length in members.tolist():
                    place(length, n, sequences, offset)
                    offset += length
                sequences += n

    # The residual, best fit, longest first: sequences with equal room are held as runs.
    room: dict[int, list[tuple[int, int]]] = {}
    open_rooms: list[int] = []

    def add(space, first, count):
        if space and count:
            if space not in room:
                bisect.insort(open_rooms, space)
            room.setdefault(space, []).append((first, count))

    def fill(length, space, first, count):
        """``count`` sequences with ``space`` left get as many of ``length`` as fit, while there are any."""
        each = space // length
        whole = min(count, int(left[length]) // each)
        for j in range(each if whole else 0):
            place(length, whole, first, capacity - space + j * length)
        add(space - each * length, first, whole)
        if whole < count:
            some = int(left[length])
            for j in range(some):
                place(length, 1, first + whole, capacity - space + j * length)
            add(space - some * length, first + whole, 1)
            add(space, first + whole + 1, count - whole - 1)

    for length in range(len(left) - 1, 0, -1):
        while left[length] > 0:
            at = bisect.bisect_left(open_rooms, length)
            if at < len(open_rooms):
                space = open_rooms[at]
                first, count = room[space].pop()
                if not room[space]:
                    del room[space]
                    open_rooms.pop(at)
            else:
                each = capacity // length
                space, first, count = capacity, sequences, -(-int(left[length]) // each)
                sequences += count
            fill(length, space, first, count)
    return np.array(runs, np.int64).reshape(-1, 5)


def ranked(cut: DataFrame, doc_id: str, total: int) -> DataFrame:
    """``rank`` from 0 among the pieces of a length.  A length may hold a third
    of all pieces: ranks are taken within (length, salt) and shifted by the
    counts of the salts before."""
    salts = max(16, total // 250_000)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64(doc_id, "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    own = Window.partitionBy("length", "salt").orderBy(doc_id, "piece", "ids_crc32")
    return (salted.withColumn("own", F.row_number().over(own)).join(shift, ["length", "salt"])
            .withColumn("rank", F.col("shift") + F.col("own") - 1).drop("salt", "own", "shift"))


def pack(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row for each piece."""
    cut = written(spark, pieces(docs, doc_id, text, tokenizer or default_tokenizer(), capacity), "packing-pieces")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").count().collect():        # at most ``capacity`` rows
        histogram[r["length"]] = r["count"]
    runs = plan(histogram, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    shared = spark.sparkContext.broadcast((runs[:, 0] << 44 | runs[:, 1], runs))
    rows = ranked(cut, doc_id, int(histogram.sum()))
    names = [doc_id, "piece", "length", "ids_crc32", "rank"]
    rows = rows.select(*names)
    schema = T.StructType([*rows.schema.fields[:4], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, runs = shared.value
        for b in batches:
            length, rank = b.column(2).to_numpy(zero_copy_only=False), b.column(4).to_numpy(zero_copy_only=False)
            at = runs[np.searchsorted(key, length << 44 | rank, side="right") - 1] if len(rank) else runs[:0]
            new = [pa.array(at[:, 3] + rank - at[:, 1]), pa.array(at[:, 4])]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *new], names=[*names[:4], "sequence_id", "offset"])

    placed = rows.mapInArrow(run, schema)
    return placed.select(doc_id, F.col("piece").cast("int").alias("piece"), (F.col("piece").cast("long") * capacity).alias("start"),
                         "length", "ids_crc32", "sequence_id", "offset")


def op6_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"))
