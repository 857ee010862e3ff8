"""SimHash near-duplicates through pivot distance tables.

Every fingerprint gets its Hamming distances to a fixed set of reference
fingerprints (the pivots).  By the triangle inequality two fingerprints that
differ in at most ``k`` bits have no two coordinates that differ by more than
``k``, so a pair whose maximum coordinate difference is larger is discarded;
survivors are verified on the fingerprints themselves.

The pivots are laid out so that the table can be joined instead of scanned:
the 64 positions are cut into ``k + 4`` bands, and each band has pivots that
differ from the base pivot in that band only.  ``d(x, pivot) - d(x, base)``
then depends on the band alone, and the pivots of a band are a resolving set:
these differences tell any two contents of the band apart.  ``k`` differing
bits leave at least four bands untouched, so each linked pair agrees on the
coordinates of some four bands, and an equality join on them loses no pair.

Copies are folded to one row per distinct fingerprint before the join.  Four
of six bands fix at least 42 bits, so one bucket holds at most 2**22 distinct
fingerprints (32 MB), whatever the size of a group of copies.  A bucket emits
a spanning forest of its verified links, not its pairs.

Defined cases: null text counts as empty; a text without words has fingerprint
zero and is linked like any other; repeated rows each get a row; a null doc_id
never becomes a component id unless all ids of the component are null; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, map_texts, same, table, written
from .components import connected_components

SEED = 42
SHINGLE = 3
MAX_BITS = 2
ALIKE = 4          # bands whose coordinates a bucket shares
SPLIT = 2048       # a bucket above this size is divided by finer bands


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of ``text`` (repeats included), signed."""
    words = text.encode("utf-8").lower().split()     # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(64, np.int64), len(words) - width + 1
    for at in range(0, n, 65536):
        stop = min(n, at + 65536)
        pairs = zip(starts[at:stop].tolist(), ends[at + width - 1:stop + width - 1].tolist())
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, stop - at)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * total > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` and the column ``fp`` (long)."""
    def make():
        return lambda texts: [[fingerprint(t, shingle) for t in texts]]
    return map_texts(df, keep, text, T.StructType([T.StructField("fp", T.LongType())]), make)


# ---- pivots -----------------------------------------------------------------

def bands(n: int, lo: int = 0, hi: int = 64) -> list[tuple[int, int]]:
    """``n`` bands [from, to) that cover the positions lo..hi-1 evenly."""
    cut = [lo + (hi - lo) * i // n for i in range(n + 1)]
    return list(zip(cut[:-1], cut[1:]))


def resolving(width: int) -> list[int]:
    """Contents of a band of ``width`` bits whose distances, less the distance
    to the empty content, tell all 2**width contents apart."""
    every = np.arange(1 << width, dtype=np.uint64)
    weight = np.bitwise_count(every).astype(np.int64)
    group = np.zeros(len(every), np.int64)           # contents not told apart yet share a number
    found: list[int] = []
    for probe in [*(x * 0x9E37 % (1 << width) for x in range(1, 8 * width)), *(1 << b for b in range(width))]:
        d = np.bitwise_count(every ^ np.uint64(probe)).astype(np.int64) - weight
        finer = np.unique(group * 256 + d + 128, return_inverse=True)[1]
        if finer.max() > group.max():
            group = finer
            found.append(probe)
        if group.max() == len(every) - 1:
            break
    return found


def pivots(n_bands: int, lo: int = 0, hi: int = 64) -> list[list[int]]:
    """The pivots of each band, as 64-bit reference fingerprints.  The base
    pivot is zero."""
    return [[p << a for p in resolving(b - a)] for a, b in bands(n_bands, lo, hi)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def coordinates(fp: Column, refs: list[int]) -> list[Column]:
    """Distances to the pivots of a band, less the distance to the base pivot."""
    base = F.bit_count(fp)
    return [(F.bit_count(fp.bitwiseXOR(F.lit(signed(r)))) - base).cast("byte") for r in refs]


# ---- links ------------------------------------------------------------------

def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each of ``n`` positions by the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def join_near(root: np.ndarray, rows: np.ndarray, fp: np.ndarray, key: np.ndarray, k: int, refs: np.ndarray) -> np.ndarray:
    """``root`` after the links within ``k`` bits among the positions ``rows``
    that have the same ``key`` (sorted): first the pivot table, then the
    fingerprints.  Pairs that are joined already are passed over, so neither
    time nor memory goes with the number of links in a dense bucket."""
    prints = fp[rows]
    table = np.bitwise_count(prints[None, :] ^ refs[:, None]).astype(np.int8)
    size = np.unique(key, return_counts=True)[1]
    left = np.repeat(np.cumsum(size), size) - np.arange(len(key)) - 1   # later rows of the same bucket
    live = np.flatnonzero(left >= 1)
    step = 1
    while len(live):
        apart = root[rows[live]] != root[rows[live + step]]
        a, b = live[apart], live[apart] + step
        for row in table:
            near = np.abs(row[a] - row[b]) <= k
            if not near.all():
                a, b = a[near], b[near]
            if not len(a):
                break
        ok = np.bitwise_count(prints[a] ^ prints[b]) <= k
        if ok.any():
            root = forest(len(root), root[rows[a[ok]]], root[rows[b[ok]]])[root]
        step += 1
        live = live[left[live] >= step]
    return root


def bucket_links(fp: np.ndarray, key: np.ndarray, k: int, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of whole buckets.  A bucket above SPLIT rows is divided
    first, by the coordinates of finer bands: again no linked pair is lost,
    since ``k`` bits leave all but ``k`` of these bands untouched."""
    counts = np.unique(key, return_inverse=True, return_counts=True)
    big = counts[2][counts[1]] > SPLIT
    rows = np.flatnonzero(~big)
    root = join_near(np.arange(len(fp)), rows, fp, key[rows], k, refs)
    where = np.flatnonzero(big)
    fine = bands(3 * k + 6)
    for left_out in itertools.combinations(range(len(fine)), k) if len(where) else ():
        mask = np.uint64(sum(((1 << (b - a)) - 1) << a for j, (a, b) in enumerate(fine) if j not in left_out))
        rows = where[np.lexsort((fp[where] & mask, key[where]))]
        pair = np.stack((key[rows], (fp[rows] & mask).view(np.int64)), axis=1)
        finer = np.concatenate(([True], (pair[1:] != pair[:-1]).any(axis=1))).cumsum()
        root = join_near(root, rows, fp, finer, k, refs)
    own = np.flatnonzero(root != np.arange(len(fp)))
    return fp[root[own]], fp[own]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) over the distinct fingerprints ``fp``: links within ``max_bits``
    bits, at least a spanning forest of all such links."""
    families = pivots(max_bits + ALIKE)
    fp = F.col("fp")
    band_key = [F.xxhash64(*coordinates(fp, refs)) for refs in families]
    mixed = distinct.select("fp", *[c.alias(f"b{i}") for i, c in enumerate(band_key)])
    keys = [F.xxhash64(F.lit(n), *[F.col(f"b{i}") for i in alike])
            for n, alike in enumerate(itertools.combinations(range(len(families)), ALIKE))]
    buckets = mixed.select(F.explode(F.array(*keys)).alias("key"), "fp").repartition("key").sortWithinPartitions("key", "fp")
    refs = np.array([0, *itertools.chain(*families)], np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def emit(key, fps):
            size = np.unique(key, return_inverse=True, return_counts=True)
            several = size[2][size[1]] > 1
            a, b = bucket_links(fps[several].view(np.uint64), key[several], max_bits, refs)
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
        held: list[tuple[np.ndarray, np.ndarray]] = []       # rows of the bucket that is still open
        for pdf in batches:
            key, fps = pdf["key"].to_numpy(), pdf["fp"].to_numpy()
            if not len(key):
                continue
            first = int(np.searchsorted(key, key[-1]))       # the last bucket may go on in the next batch
            if held and (first or held[-1][0][-1] != key[-1]):
                done_key = np.concatenate([*[h[0] for h in held], key[:first]])
                done_fp = np.concatenate([*[h[1] for h in held], fps[:first]])
                held = []
                yield emit(done_key, done_fp)
            elif first:
                yield emit(key[:first], fps[:first])
            held.append((key[first:], fps[first:]))
        if held:
            yield emit(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))

    return buckets.mapInPandas(run, "a long, b long")


def components(spark: SparkSession, prints: DataFrame, doc_id: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id): for each distinct ``fp`` of ``prints`` the smallest
    ``doc_id`` of its component."""
    reps = prints.groupBy("fp").agg(F.min(doc_id).alias("least"))
    edges = written(spark, links(reps.select("fp"), max_bits), "simhash-links")
    roots = connected_components(spark, edges)
    marked = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    alone = marked.where(F.col("root").isNull()).select("fp", F.col("least").alias("component_id"))
    linked = marked.where(F.col("root").isNotNull())
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return alone.unionByName(linked.join(least, "root").select("fp", "component_id"))


def simhash_components(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id), a row for each row of ``docs``."""
    prints = written(spark, fingerprints(docs, [doc_id], text, shingle), "simhash-prints")
    return prints.join(components(spark, prints, doc_id, max_bits), "fp").select(doc_id, "fp", "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The row with the smallest doc_id of each component (of repeated rows with
    that id one; of components without any id, one row for each fingerprint)."""
    row = fresh(docs, "row")
    tagged = written(spark, docs.withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    prints = fingerprints(tagged, [doc_id, row], text, shingle).withColumnRenamed(row, "__row")
    prints = written(spark, prints, "simhash-prints")
    found = prints.join(components(spark, prints, doc_id, max_bits), "fp")
    least = found.where(F.col(doc_id).eqNullSafe(F.col("component_id")))
    named = least.where(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.min("__row").alias("__row"))
    nameless = least.where(F.col(doc_id).isNull()).groupBy("fp").agg(F.min("__row").alias("__row"))
    rows = named.select(F.col("__row").alias(row)).unionByName(nameless.select(F.col("__row").alias(row)))
    return same(tagged.join(rows, row, "left_semi"), docs.columns)


def op10_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
