"""Benchmark decontamination by random-walk embedding and bit-sampling LSH.

Texts and benchmark items become sequences of lower-case words.  The CGK random
walk embeds a sequence: at step ``j`` it writes the word it stands on and then
moves on or stays, by a random bit of (``j``, word).  Sequences at a small edit
distance walk together again soon after each edit, so their embeddings are at a
small Hamming distance.  Bit sampling hashes an embedding by the words at SAMPLED
random steps; this is repeated with new walks and steps as often as the target
recall needs.  That number is measured, not guessed, and for each class of lengths by
itself: copies of the class's passages with EDITS of their words edited are hashed, and
repetitions are added until ENOUGH of them meet their passage, which leaves RECALL on
other copies.  A class that does not get there in MOST_REPEATS repetitions is named in
a warning.

Windows have the size of the passages: these are dealt into classes of similar
length, and a window of a class is walked over that length.  Windows start at
every ``stride``-th word of a document, and a passage enters the index once for
each of its first ``stride`` words as start, so that some start always meets.
Candidates are verified by exact edit distance over words, anywhere in the
window.

One rule holds for all lengths: an item is found in a document if a stretch of PASSAGE
of its words, or the whole of a shorter item, is in the document with at most DISTANCE
of the stretch's words edited (rounded down, so stretches of fewer than five words are
found as they are).  Stretches begin at every STEP-th word of the item and end at its end.

Equal benchmark texts are looked for once.  Items are broadcast in blocks of at most
ITEM_BLOCK passages, one pass over the documents for each block; where there are more
blocks, each one's finds are stored and its index let go before the next is made.
Documents are never shuffled.

Defined cases: null or empty texts and items match nothing; repeated
rows of documents are reported each; repeated items are reported by each id;
ties between places go to the first; further columns are ignored.
"""

from __future__ import annotations

import random
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, in_small_batches, same, table, written

SAMPLED = 3          # steps that make one hash
EDITS = 0.2          # share of edited words at which the target recall holds: the largest that is accepted
RECALL = 0.9
ENOUGH, PROBES = 0.94, 300       # share of so many copies of a class that must be met
MOST_REPEATS = 64
DISTANCE = 0.2       # share of a stretch's words that may be edited
LEAST_WORDS = 5      # from here on one word may be edited; shorter stretches are looked up as they are
PASSAGE, STEP = 64, 16
ITEM_BLOCK = 5000
WORDS_AT_ONCE = 100_000
CLASS_RATIO = 2.0    # lengths of a class differ by less than this factor
WALK = 1.6           # steps for each word of a window; two would reach its end

MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on all of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Hashed words of many texts at once."""

    BASE = 0x9E3779B97F4A7C15       # odd, so that it has an inverse modulo 2**64

    def __init__(self):
        self.letter = np.array([chr(c).isalnum() for c in range(0x10000)])
        self.power = self.unpower = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 1 << 20)
            step = np.full(n, self.BASE, np.uint64)
            step[0] = 1
            self.power = np.multiply.accumulate(step)
            step[1:] = pow(self.BASE, -1, 1 << 64)
            self.unpower = np.multiply.accumulate(step)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text number, first character, end character) of each word."""
        lower = [t.lower() for t in texts]
        lower = [a if len(a) == len(t) else "".join(x if len(x) == 1 else c for c, x in ((c, c.lower()) for c in t))
                 for a, t in zip(lower, texts)]                      # places are those of the text itself
        size = np.array([len(t) + 1 for t in lower], np.int64)
        begin = np.concatenate(([0], np.cumsum(size)))
        code = np.frombuffer(("\n".join(lower) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        self.grow(len(code) + 1)
        inside = self.letter[np.minimum(code, 0xFFFF)] | (code > 0xFFFF)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        first, end = edge[::2], edge[1::2]
        total = np.concatenate(([np.uint64(0)], np.cumsum((code + np.uint64(1)) * self.power[:len(code)], dtype=np.uint64)))
        h = mix((total[end] - total[first]) * self.unpower[first] ^ (end - first).astype(np.uint64))
        which = np.searchsorted(begin, first, side="right") - 1
        return h, which, first - begin[which], end - begin[which]


class Walk:
    """One repetition: its random bits and the steps it samples for a class."""

    def __init__(self, repeat: int):
        self.repeat = repeat

    def bits(self, words: np.ndarray, block: int) -> np.ndarray:
        """Random bits of steps 64 * block to 64 * block + 63 for each word."""
        return mix(words ^ np.uint64((0xA24BAED4963EE407 * (self.repeat * 4096 + block + 1)) & MASK))

    def steps(self, length: int) -> list[int]:
        """Sampled steps over a window of ``length`` words, one from each of SAMPLED even parts."""
        rnd, walked = random.Random(self.repeat * 7919 + length), max(SAMPLED, int(WALK * length))
        return [rnd.randrange(walked * k // SAMPLED, max(walked * k // SAMPLED + 1, walked * (k + 1) // SAMPLED)) for k in range(SAMPLED)]

    def go(self, words: np.ndarray, at: np.ndarray, start: int, stop: int, random_words: dict[int, np.ndarray]) -> np.ndarray:
        """Positions after steps start..stop-1 of walks now at ``at``; the last word is never left."""
        byte = at * 8                            # of the random words; only the byte with the step's bit is read
        for j in range(start, stop):
            block = j >> 6
            if block not in random_words:
                fresh_bits = self.bits(words, block).astype("<u8")
                fresh_bits[-1] = 0
                random_words[block] = fresh_bits.view(np.uint8)
            move = random_words[block][(j & 63) >> 3:].take(byte)
            move >>= j & 7
            move &= 1
            move <<= 3
            byte += move
        return byte >> 3


def classes(lengths: np.ndarray) -> list[int]:
    """Lower bounds of the length classes that occur."""
    out, low = [], float(LEAST_WORDS)
    while len(lengths) and low <= lengths.max():
        high = low * CLASS_RATIO
        a, b = int(np.ceil(low)), int(np.ceil(high))
        if ((lengths >= a) & (lengths < b)).any():
            out.append(a)
        low = high
    return out


class Index:
    """The hashes of a block of passages, for all repetitions."""

    def __init__(self, ids: list, passages: list[np.ndarray]):
        self.ids, self.passages = ids, passages
        size = np.array([len(p) for p in passages], np.int64)
        self.short = {n: self.sequences(np.flatnonzero(size == n), n) for n in sorted(set(size[size < LEAST_WORDS].tolist()))}
        self.low = classes(size[size >= LEAST_WORDS])
        klass = np.where(size >= LEAST_WORDS, np.searchsorted(self.low, size, side="right") - 1, -1)
        self.members = [np.flatnonzero(klass == c) for c in range(len(self.low))]
        self.stride = [max(1, a // 4) for a in self.low]
        self.tables: list[dict[int, tuple]] = []             # of each repetition, by class
        probes = {c: self.edited(c, 11) for c in range(len(self.low))}
        found: dict[int, set[int]] = {c: set() for c in probes}
        while probes and len(self.tables) < MOST_REPEATS:
            walk = Walk(len(self.tables))
            self.tables.append({c: self.table(walk, c) for c in probes})
            for c in list(probes):
                found[c] |= self.met(probes[c], c, len(self.tables) - 1, found[c])
                if len(found[c]) >= ENOUGH * len(probes[c]):
                    del probes[c]
        for c in probes:
            warnings.warn(f"passages of {self.low[c]} words or more: recall {len(found[c]) / len(probes[c]):.2f} after {MOST_REPEATS} repetitions")

    def sequences(self, members: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(keys, passages) of stretches of ``n`` words, sorted by key."""
        key = sequence_keys(np.stack([self.passages[i] for i in members]), n)
        order = np.argsort(key, kind="stable")
        return key[order], members[order]

    def table(self, walk: Walk, c: int) -> tuple:
        """(slots of the words sampled first, these words, key of all sampled
        words, passage, offset); the last three sorted by key."""
        rows, offset, words, begin = [], [], [], []
        at = 0
        for i in self.members[c]:
            p = self.passages[i]
            for o in range(self.stride[c]):
                rows.append(i)
                offset.append(o)
                begin.append(at + o)
            words.append(p)
            words.append(np.array([i * 2 + 1], np.uint64))       # past the end: no word of any text
            at += len(p) + 1
        flat, pos, key, first, done, random_words = np.concatenate(words), np.array(begin, np.int64), None, None, 0, {}
        last = np.array([b - o + len(self.passages[i]) for b, o, i in zip(begin, offset, rows)], np.int64)
        for s in walk.steps(self.low[c]):
            pos = np.minimum(walk.go(flat, pos, done, s, random_words), last)
            done = s
            got = flat[pos]
            first = np.unique(got) if first is None else first
            key = got if key is None else mix(key ^ got) + got
        order = np.argsort(key, kind="stable")
        slots = np.zeros(1 << int(16 * len(first)).bit_length(), bool)       # most words that are first of no passage end here
        slots[first & np.uint64(len(slots) - 1)] = True
        return slots, first, key[order], np.array(rows, np.int64)[order], np.array(offset, np.int64)[order]

    def edited(self, c: int, seed: int) -> list[tuple[int, np.ndarray]]:
        """PROBES copies of passages of a class with EDITS of their words replaced, dropped or added, in foreign surroundings."""
        rnd, out = random.Random(seed), []
        some = rnd.sample(self.members[c].tolist(), min(PROBES, len(self.members[c])))
        for k in range(PROBES):
            i = some[k % len(some)]
            words = self.passages[i].tolist()
            for _ in range(max(1, int(EDITS * len(words)))):
                at, what = rnd.randrange(len(words)), rnd.randrange(3)
                new = [rnd.getrandbits(64)] if what != 1 else []
                words[at:at + (what != 2)] = new
            around = [rnd.getrandbits(64) for _ in range(400)]
            out.append((i, np.array(around[:97 + i % 64] + words + around[200:], np.uint64)))
        return out

    def met(self, probes: list[tuple[int, np.ndarray]], c: int, r: int, known: set[int]) -> set[int]:
        """Numbers of the probes not yet ``known`` that repetition ``r`` finds."""
        left = [(k, i, w) for k, (i, w) in enumerate(probes) if k not in known]
        if not left:
            return set()
        text = np.concatenate([w for _, _, w in left])
        owner = np.repeat([k for k, _, _ in left], [len(w) for _, _, w in left])
        wanted = {k: i for k, i, _ in left}
        at = [(int(owner[max(p, 0)]), int(i)) for i, p in zip(*self.candidates(text, r, {c}))]
        return {k for k, i in at if wanted[k] == i}

    def recall(self, c: int, seed: int) -> float:
        """Share of copies made with another seed that all repetitions of a class find."""
        probes, found = self.edited(c, seed), set()
        for r, tables in enumerate(self.tables):
            if c in tables:
                found |= self.met(probes, c, r, found)
        return len(found) / len(probes)

    def candidates(self, words: np.ndarray, r: int, only: set[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(passages, places where they would begin) of the windows of ``words`` whose
        hash of repetition ``r`` is that of a passage.  Walks whose first sampled
        word is first of no passage end there."""
        walk, random_words, out = Walk(r), {}, [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for c, (slots, first, keys, rows, offset) in self.tables[r].items():
            if only and c not in only:
                continue
            start = np.arange(0, len(words), self.stride[c], dtype=np.int64)
            pos, key, done = start, None, 0
            for s in walk.steps(self.low[c]):
                pos = walk.go(words, pos, done, s, random_words) if s > done else pos
                done = s
                got = words[pos]
                if key is None:
                    near = np.flatnonzero(slots[(got & np.uint64(len(slots) - 1)).view(np.int64)])
                    near = near[first[np.minimum(np.searchsorted(first, got[near]), len(first) - 1)] == got[near]]
                    start, pos, key = start[near], pos[near], got[near]
                else:
                    key = mix(key ^ got) + got
            lo, hi = np.searchsorted(keys, key, side="left"), np.searchsorted(keys, key, side="right")
            hit = np.flatnonzero(hi > lo)
            n = (hi - lo)[hit]
            entry = np.repeat(lo[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.append((rows[entry], np.repeat(start[hit], n) - offset[entry]))
        return tuple(np.concatenate(x) for x in zip(*out))


def sequence_keys(words: np.ndarray, n: int) -> np.ndarray:
    """One key for each row of ``n`` words."""
    key = words[:, 0].copy()
    for k in range(1, n):
        key = mix(key ^ words[:, k]) + words[:, k]
    return key


def edit_distance(item: np.ndarray, window: np.ndarray, anchored: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For rows of items (rows x words) and windows (rows x longer), the least
    edit distance of the item to any stretch of its window (anchored: to any
    beginning of it), and that stretch's end."""
    rows, n = item.shape
    at = np.arange(n + 1, dtype=np.int16)
    cost = np.broadcast_to(at, (rows, n + 1)).copy()
    best, end = cost[:, n].copy(), np.zeros(rows, np.int64)
    for j in range(window.shape[1]):
        new = cost + 1
        new[:, 1:] = np.minimum(new[:, 1:], cost[:, :-1] + (item != window[:, j:j + 1]))
        new[:, 0] = j + 1 if anchored else 0
        cost = np.minimum.accumulate(new - at, axis=1) + at
        better = cost[:, n] < best
        best[better], end[better] = cost[better, n], j + 1
    return best, end


def shared_words(item: np.ndarray, window: np.ndarray) -> np.ndarray:
    """How many words of each item occur in its window; every other one is an edit."""
    return sum(((item[:, k:k + 1] == window).any(axis=1) for k in range(item.shape[1])), np.zeros(len(item), np.int64))


class Scan:
    """Finds the passages of an index in texts."""

    def __init__(self, index: Index):
        self.index, self.words = index, Words()

    def __call__(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text number, passage, edit distance, first, end character), the best
        place of each passage in each text."""
        h, which, first, end = self.words(texts)
        if not len(h):
            return []
        edge = np.searchsorted(which, np.arange(len(texts) + 1))
        found = {pair for r in range(len(self.index.tables)) for pair in zip(*(x.tolist() for x in self.index.candidates(h, r)))}
        by_size: dict[int, list[tuple[int, int]]] = {}
        for i, p in sorted(found):
            by_size.setdefault(len(self.index.passages[i]), []).append((i, p))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for i, p in self.as_they_are(h, which):
            key, row = (int(which[p]), i), (0, int(first[p]), int(end[p + len(self.index.passages[i]) - 1]))
            best[key] = min(row, best.get(key, row))
        for n, pairs in by_size.items():
            most = int(DISTANCE * n)
            for at in range(0, len(pairs), 4096):
                part = np.array(pairs[at:at + 4096], np.int64)
                place = np.clip(part[:, 1], 0, len(h) - 1)
                doc = which[place]
                cols = part[:, 1:] - most + np.arange(n + 2 * most)[None, :]
                inside = (cols >= edge[doc][:, None]) & (cols < edge[doc + 1][:, None])
                window = np.where(inside, h[np.clip(cols, 0, len(h) - 1)], np.uint64(0))
                item = np.stack([self.index.passages[i] for i in part[:, 0].tolist()])
                near = shared_words(item, window) >= n - most
                part, doc, cols, item, window = part[near], doc[near], cols[near], item[near], window[near]
                far, stop = edit_distance(item, window)
                ok = np.flatnonzero(far <= most)
                stop = cols[ok, 0] + stop[ok]                               # past the stretch's last word
                back = stop[:, None] - 1 - np.arange(n + most)[None, :]
                inside = back >= edge[doc[ok]][:, None]
                _, size = edit_distance(item[ok, ::-1], np.where(inside, h[np.maximum(back, 0)], np.uint64(0)), anchored=True)
                for d, i, f, a, b in zip(doc[ok].tolist(), part[ok, 0].tolist(), far[ok].tolist(), (stop - size).tolist(), stop.tolist()):
                    row = (f, int(first[a]), int(end[b - 1]))
                    best[d, i] = min(row, best.get((d, i), row))
        return [(*key, *row) for key, row in sorted(best.items())]

    def as_they_are(self, h: np.ndarray, which: np.ndarray) -> Iterator[tuple[int, int]]:
        """(passage, place) of the passages of fewer than LEAST_WORDS words: the first place of each key in a text is enough."""
        for n, (keys, members) in self.index.short.items():
            if len(h) < n:
                continue
            rows = np.lib.stride_tricks.sliding_window_view(h, n)
            at = np.flatnonzero(which[:len(rows)] == which[n - 1:])
            key = sequence_keys(rows[at], n)
            lo, hi = np.searchsorted(keys, key, side="left"), np.searchsorted(keys, key, side="right")
            on = np.flatnonzero(hi > lo)
            _, one = np.unique(np.stack((which[at[on]].astype(np.uint64), key[on])), axis=1, return_index=True)
            for j in on[one].tolist():
                for i in members[lo[j]:hi[j]].tolist():
                    if (self.index.passages[i] == h[at[j]:at[j] + n]).all():
                        yield i, int(at[j])


def passages(ids: list, texts: list[str | None]) -> tuple[list, list[np.ndarray]]:
    """The stretches of items that are looked for, by item id."""
    h, which, _, _ = Words()([t or "" for t in texts])
    out_ids, out = [], []
    for k, item in enumerate(ids):
        words = h[np.searchsorted(which, k):np.searchsorted(which, k + 1)]
        last = max(0, len(words) - PASSAGE)
        for a in sorted({*range(0, last, STEP), last}) if len(words) else ():
            out_ids.append(item)
            out.append(words[a:a + PASSAGE])
    return out_ids, out


def contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, n_words, similarity, first, end): the items
    found in each document, with the place (characters) of the closest find."""
    src = docs.select(F.col(doc_id), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = T.StructType([T.StructField("__doc", src.schema[doc_id].dataType), T.StructField("__item", T.StringType())]
                          + [T.StructField(c, T.LongType()) for c in ("distance", "n_words", "first", "end")])
    found = None
    for index, alone in indexes(items, item_text):
        part = scan(src, index, schema)
        part = part if alone else written(spark, part, "decontaminate-found")
        found = part if found is None else found.unionByName(part)
    found = found if found is not None else spark.createDataFrame([], schema)
    owners = items.select(F.sha2(F.col(item_text), 256).alias("__item"), F.col(item_id).alias("__owner"))
    named = found.join(owners, "__item").withColumn("similarity", 1 - F.col("distance") / F.col("n_words"))
    return named.select(F.col("__doc").alias(doc_id), F.col("__owner").alias(item_id), "distance", "n_words", "first", "end", "similarity")


def indexes(items: DataFrame, item_text: str) -> Iterator[tuple[Index, bool]]:
    """An index for each block of distinct item texts, known by their digests, and whether it is the only one."""
    texts = items.where(F.col(item_text).isNotNull()).select(F.sha2(F.col(item_text), 256).alias("key"), F.col(item_text).alias("text")).distinct()
    words = F.size(F.split("text", r"\W+|_"))
    total = texts.agg(F.sum(F.ceil(words / STEP)).alias("n")).first().n or 0
    blocks = max(1, -(-int(total) // ITEM_BLOCK))
    for b in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).orderBy("key").collect()        # about ITEM_BLOCK passages
        ids, parts = passages([r.key for r in rows], [r.text for r in rows])
        if parts:
            yield Index(ids, parts), blocks == 1


def scan(src: DataFrame, index: Index, schema: T.StructType) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = None
        for b in batches:
            find = find or Scan(index)      # travels with the function, at most ITEM_BLOCK passages
            size = np.cumsum(np.concatenate(([0], pa.compute.utf8_length(b.column(1)).to_numpy()))) // (6 * WORDS_AT_ONCE)
            cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                part = b.slice(lo, hi - lo)
                best: dict[tuple[int, object], tuple[int, int, int, int]] = {}
                for d, i, far, first, end in find(part.column(1).to_pylist()) if part.num_rows else []:
                    key, row = (d, find.index.ids[i]), (far, len(find.index.passages[i]), first, end)
                    best[key] = min(row, best.get(key, row))
                ids = part.column(0).take(pa.array([d for d, _ in best], pa.int64()))
                cols = [ids, pa.array([i for _, i in best], arrow.field(1).type), *[pa.array([r[k] for r in best.values()], pa.int64()) for k in range(4)]]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return in_small_batches(src).mapInArrow(run, schema)


def keep_clean(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item of ``items`` is found, unchanged."""
    row = fresh(docs, "row")
    tagged = written(spark, docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate-docs")
    hit = contaminated(spark, tagged, items, doc_id=row).select(row).distinct()
    return same(tagged.join(hit, row, "left_anti"), docs.columns)


def op1_decontaminate_cgk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
