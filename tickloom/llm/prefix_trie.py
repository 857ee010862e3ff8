"""Conversation prefix trie by fixed-length block hashing.

Conversations that begin with the same turns share a path of a trie, so what they
share has to be stored, or its attention keys and values computed, only once.

Turns become 128-bit digests.  A conversation is cut into blocks of BLOCK turns, and
conversations are grouped by successive block digests: a block is known by the key
of all turns before it and its own digest.  Where all conversations that go on from
a key have the same next block, its turns are a chain and one copy says all.  Only
where siblings diverge are the turn boundaries inside the blocks refined, on one row
for each distinct block, not for each conversation.  (A block cut short by the end of a
conversation differs from a full one, so ends inside a block are found this way too.)

No group is larger than its fan-out.  Turns are ordered by a range shuffle, which
splits a long conversation over tasks; SEGMENT turns make a row, SEGMENT segments a
row of the next level, and so on, and keys go down these levels again.  Everything
about subtrees comes from sums over members, with two numbers for each conversation:
the words of its turns that a smaller conversation stands for, and whether it stands
for a leaf.  The ids that end at a node are joined to pieces of PIECE ids where the
range shuffle put them, and the pieces hashed in order, streaming.

Defined cases: rows without a conversation id take no part; null turns come first,
and rows equal in turn are ordered by role, then by the digest of their text; null
role or text is empty; repeated rows are turns each; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chat_repair import mapped, struct
from .common import table, written

FAMILY, MOST_SHARED = 20, 4       # a conversation borrows crc32 % MOST_SHARED turns from its family's first
BLOCK = 8                         # turns
SEGMENT = 512                     # turns, a multiple of BLOCK; segments in a row of the next level, and so on
SPAN = 8192                       # rows of one conversation that meet in one join key
PIECE = 4096                      # ids hashed as one string
WORD = r"[^\x20\x09-\x0D]+"
ROOT = hashlib.sha256(b"root").digest()[:16]
LONG, BYTES = T.LongType(), T.BinaryType()


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()[:16]


def narrow_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, own, d, words): digests of the text and of role and text together, and the text's words."""
    named = turns.select(F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                         F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    both = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))

    def short(x: Column) -> Column:
        return F.substring(F.unhex(F.sha2(x.cast("binary"), 256)), 1, 16)
    return named.where("conv is not null").select("conv", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("own"),
                                                  short(both).alias("d"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))


def numbered(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv, pos, d, words): ``pos`` counts the turns of a conversation from 1."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("own")]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "d", "words")

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
            for i, (_, d, words) in enumerate(group):
                yield part, conv, i + 1, d, words

    here = written(spark, mapped(ordered, count, struct(part=LONG, conv=LONG, pos=LONG, d=BYTES, words=LONG)), "trie-turns")
    # A conversation may go on from task to task: a row for each task says where it begins and ends.
    edges = here.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "pos")).alias("last")).orderBy("part").collect()
    carried, now, held = [], None, 0
    for e in edges:
        if e["first"] == now:
            carried.append((e.part, now, held))
        held = e.last.pos + (held if e["first"] == now == e.last.conv else 0)
        now = e.last.conv
    before = spark.createDataFrame(carried, "part long, conv long, before long")
    return here.join(F.broadcast(before), ["part", "conv"], "left").select(      # a row for each task at most
        "conv", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "d", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, d, words) of the rebuilt conversations, and (conv, len) of all of them."""
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % MOST_SHARED
    n = turns.groupBy("conv").agg(F.max("pos").alias("n")).withColumn("h", shared).withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    first = n.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = n.join(first, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = convs.select("conv", "base", "h", "taken", "n", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))
    heads = turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < MOST_SHARED)).withColumnRenamed("conv", "base")
    head = convs.select("conv", "base", "h").join(heads, "base").where("pos <= h").select("conv", F.col("pos").alias("depth"), "d", "words")
    span = F.floor(F.col("pos") / SPAN)
    spans = convs.select("conv", "h", "taken", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / SPAN))).alias("span"))
    tail = turns.withColumn("span", span).join(spans, ["conv", "span"]).where("pos > h")
    tail = tail.select("conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "d", "words")
    return head.unionByName(tail), convs.select("conv", "len")


# ---- keys of prefixes -------------------------------------------------------

def starts(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """For rows (conv, at, d, words), numbered from 0 in each conversation: (conv, at, start, end, before),
    the keys of all before the row and of all up to it, and the words before it."""
    most = rows.agg(F.max("at")).first()[0] or 0
    schema = struct(conv=LONG, at=LONG, start=BYTES, end=BYTES, before=LONG)

    def chain(groups: Iterator[tuple]) -> Iterator[tuple]:
        for conv, start, end, before, items in groups:
            for i, x in enumerate(items):
                after = digest(start, x["d"]) if i < SEGMENT - 1 else end
                yield conv, x["at"], start, after, before
                start, before = after, before + x["words"]

    grouped = rows.groupBy("conv", F.floor(F.col("at") / SEGMENT).alias("up")).agg(
        F.sort_array(F.collect_list(F.struct("at", "d", "words"))).alias("items"))                  # at most SEGMENT
    if most < SEGMENT:
        top = grouped.withColumns({"start": F.lit(bytearray(ROOT)), "end": F.lit(bytearray(digest(ROOT, b"all"))), "before": F.lit(0).cast("long")})
        return mapped(top.select("conv", "start", "end", "before", "items"), chain, schema)
    grouped = written(spark, grouped, "trie-levels")
    def whole(groups: Iterator[tuple]) -> Iterator[tuple]:
        for conv, up, items in groups:
            yield conv, up, digest(*[x["d"] for x in items]), sum(x["words"] for x in items)
    above = starts(spark, mapped(grouped.select("conv", "up", "items"), whole, struct(conv=LONG, at=LONG, d=BYTES, words=LONG)))
    joined = grouped.join(above.withColumnRenamed("at", "up"), ["conv", "up"])
    return mapped(joined.select("conv", "start", "end", "before", "items"), chain, schema)


BLOCKS = struct(conv=LONG, segment=LONG, start=BYTES, d=BYTES, next=BYTES, tip=BYTES, depth=LONG, before=LONG,
                turns=T.ArrayType(T.StructType([T.StructField("d", BYTES), T.StructField("words", LONG)])))


def keys(start: bytes, end: bytes, digests: list[bytes]) -> list[bytes]:
    """The keys of the prefixes that end inside a block; ``end`` where the block is full."""
    return [end if i == BLOCK else digest(b"turn", start, *digests[:i]) for i in range(1, len(digests) + 1)]


def blocks(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """A row for each block of each conversation: the key before it, its digest, the
    key after it if it is full, the key of its last turn, its depth, and its turns."""
    segments = turns.groupBy("conv", F.floor((F.col("depth") - 1) / SEGMENT).alias("at")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "d", "words"))).alias("items"))               # at most SEGMENT
    segments = written(spark, segments, "trie-segments")

    def whole(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, at, items in rows:
            yield conv, at, digest(*[x["d"] for x in items]), sum(x["words"] for x in items)
    known = starts(spark, mapped(segments, whole, struct(conv=LONG, at=LONG, d=BYTES, words=LONG)))

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, at, items, start, end, before in rows:
            for i in range(0, len(items), BLOCK):
                part = items[i:i + BLOCK]
                digests = [x["d"] for x in part]
                d = digest(*digests)
                after = end if i + BLOCK == SEGMENT else digest(start, d)
                yield (conv, at, start, d, after, keys(start, after, digests)[-1], at * SEGMENT + i, before,
                       [{"d": x["d"], "words": x["words"]} for x in part])
                start, before = after, before + sum(x["words"] for x in part)

    joined = segments.join(known, ["conv", "at"]).select("conv", "at", "items", "start", "end", "before")
    return written(spark, mapped(joined, cut, BLOCKS), "trie-blocks")


# ---- nodes ------------------------------------------------------------------

def expanded(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(start, d, key, parent, depth, words, before, n, conv, alone): the turns of each distinct block.  ``alone``
    blocks have no sibling: their turns are nodes as they are.  Turns of others still have to be grouped by key."""
    distinct = written(spark, rows.groupBy("start", "d").agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("next").alias("next"), F.first("depth").alias("depth"),
        F.first("before").alias("before"), F.first("turns").alias("turns")), "trie-distinct")
    salted = distinct.withColumn("salt", salt(F.col("d"), distinct.count()))
    siblings = spread(salted, ["start"]).select("start", "salt", (F.col("total") == 1).alias("alone"))
    held = salted.join(siblings, ["start", "salt"]).select("start", "d", "next", "depth", "before", "turns", "n", "conv", "alone")

    def refine(blocks: Iterator[tuple]) -> Iterator[tuple]:
        for start, d, after, depth, before, turns, n, conv, alone in blocks:
            parent = start
            for i, (x, key) in enumerate(zip(turns, keys(start, after, [t["d"] for t in turns]))):
                yield start, d, key, parent, depth + i + 1, x["words"], before, n, conv, alone
                parent, before = key, before + x["words"]

    return written(spark, mapped(held, refine, struct(start=BYTES, d=BYTES, key=BYTES, parent=BYTES, depth=LONG, words=LONG, before=LONG,
                                                      n=LONG, conv=LONG, alone=T.BooleanType())), "trie-turn-keys")


def salt(key: Column, total: int) -> Column:
    """So many salts that a key with every row has a quarter of a million of them in each."""
    return F.pmod(F.xxhash64(key), F.lit(max(64, total // 250_000)))


def spread(salted: DataFrame, by: list[str]) -> DataFrame:
    """(by, salt, total): the rows of each key ``by``, repeated for each salt it occurs with."""
    counts = salted.groupBy(*by, "salt").agg(F.count("*").alias("c"))
    return counts.groupBy(*by).agg(F.sum("c").alias("total"), F.collect_list("salt").alias("salts")).select(
        *by, "total", F.explode("salts").alias("salt"))


def grouped_nodes(turn_keys: DataFrame, sums: dict[str, Column], keep: list[str]) -> DataFrame:
    """One row for each key: rows of ``alone`` blocks as they are, the others' ``sums`` by key."""
    alone = turn_keys.where("alone").select("key", *keep, *sums)
    others = turn_keys.where("not alone").groupBy("key").agg(*[F.first(c).alias(c) for c in keep], *[f.alias(c) for c, f in sums.items()])
    return alone.unionByName(others)


def end_hashes(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) for rows (key, conv): SHA-256 of the ids in ascending order, comma-joined."""
    ordered = ends.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")

    def join(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, group in itertools.groupby(rows, key=lambda r: r[0]):
            while part := [conv for _, conv in itertools.islice(group, PIECE)]:
                yield key, part[0], ",".join(map(str, part))
    pieces = mapped(ordered, join, struct(key=BYTES, first=LONG, ids=T.StringType()))

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, group in itertools.groupby(rows, key=lambda r: r[0]):
            h = hashlib.sha256()
            for i, (_, _, ids) in enumerate(group):
                h.update(("," if i else "").encode() + ids.encode())
            yield key, h.hexdigest()
    return mapped(pieces.repartition("key").sortWithinPartitions("key", "first"), run, struct(key=BYTES, ends_sha256=T.StringType()))


def trie(spark: SparkSession, turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
         text: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row for each node."""
    source = written(spark, narrow_turns(turns, conv_id, turn, role, text), "trie-digests")
    whole, convs = rebuilt(numbered(spark, source))
    convs = written(spark, convs, "trie-conversations")
    rows = blocks(spark, whole)
    turn_keys = expanded(spark, rows)

    root = convs.agg(F.count("*").alias("n"), F.min("conv").alias("conv")).where("n > 0").select(
        F.lit(bytearray(ROOT)).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("before"), "n", "conv")
    nodes = grouped_nodes(turn_keys, {"n": F.sum("n"), "conv": F.min("conv")}, ["parent", "depth", "words", "before"]).unionByName(root)
    nodes = written(spark, nodes.withColumn("salt", F.coalesce(salt(F.col("key"), convs.count()), F.lit(0))), "trie-nodes")
    children = spread(nodes.where("parent is not null"), ["parent"])
    family = written(spark, children.join(nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv")), "parent"), "trie-families")
    n_children = family.groupBy(F.col("parent").alias("key")).agg(F.first("total").alias("n_children"))
    nodes = nodes.join(n_children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.join(family.select("parent", "salt", "parent_conv"), ["parent", "salt"], "left").drop("salt")

    # Of each conversation: the words that smaller ones stand for, and the leaf it stands for.
    own = nodes.groupBy("conv").agg(F.sum("words").alias("own"), F.count_if(F.col("n_children") == 0).alias("leaf"))
    every = rows.groupBy("conv").agg(F.sum(F.aggregate("turns", F.lit(0).cast("long"), lambda a, x: a + x["words"])).alias("all"),
                                     F.max_by("tip", "depth").alias("tip"))
    facts = written(spark, convs.join(every, "conv", "left").join(own, "conv", "left").select(
        "conv", "len", F.coalesce("tip", F.lit(bytearray(ROOT))).alias("tip"), F.coalesce("leaf", F.lit(0)).alias("leaf"),
        (F.coalesce("all", F.lit(0)) - F.coalesce("own", F.lit(0))).alias("shared")), "trie-facts")
    spans = facts.select("conv", "shared", "leaf", F.explode(F.sequence(F.lit(0), F.floor(F.col("len") / SPAN))).alias("span"))

    member = rows.select("conv", "start", "d", F.floor(F.col("depth") / SPAN).alias("span")).join(spans, ["conv", "span"])
    by_block = member.groupBy("start", "d").agg(F.sum("shared").alias("shared"), F.sum("leaf").alias("leaf"))
    by_node = grouped_nodes(turn_keys.select("start", "d", "key", "alone").join(by_block, ["start", "d"]),
                            {"shared": F.sum("shared"), "leaf": F.sum("leaf")}, [])
    by_node = by_node.unionByName(facts.agg(F.sum("shared").alias("shared"), F.sum("leaf").alias("leaf")).select(
        F.lit(bytearray(ROOT)).alias("key"), "shared", "leaf"))
    of_rep = spans.select("conv", "span", F.col("shared").alias("of_rep"))
    out = nodes.join(by_node, "key").withColumn("span", F.floor(F.col("depth") / SPAN)).join(of_rep, ["conv", "span"])
    out = out.join(end_hashes(spark, facts.select(F.col("tip").alias("key"), "conv")), "key", "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("conv").alias(conv_id), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.col("leaf").alias("n_leaves"), (F.col("shared") - F.col("of_rep") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(spark, table(spark, sf_dir, "conversations"))


def trie_sql(family: int = FAMILY, most_shared: int = MOST_SHARED) -> str:
    """The same trie in DuckDB SQL: every prefix of every conversation, and every pair of a node and what is above it."""
    crc = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
    return f"""
    WITH t AS (
      SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
    n AS MATERIALIZED (SELECT c, c - c % {family} AS base, count(*) AS n, {crc} % {most_shared} AS h FROM t GROUP BY c),
    turns AS (
      SELECT n.c, t.p AS d, t.r, t.t FROM n JOIN t ON t.c = n.base AND t.p <= n.h
      UNION ALL SELECT n.c, least(n.h, coalesce(b.n, 0)) + t.p - n.h, t.r, t.t FROM n JOIN t ON t.c = n.c AND t.p > n.h LEFT JOIN n b ON b.c = n.base),
    paths AS MATERIALIZED (
      SELECT n.c, coalesce(list(struct_pack(r := r, t := t) ORDER BY d) FILTER (d IS NOT NULL), []) AS path
      FROM n LEFT JOIN turns USING (c) GROUP BY n.c),
    prefixes AS MATERIALIZED (
      SELECT c, d, len(path) = d AS ends, CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].t, '[^\\x20\\x09-\\x0D]+')) END AS w,
             sha256(array_to_string(list_transform(path[1:d], lambda x: concat(len(x.r), ':', x.r, len(x.t), ':', x.t)), '')) AS k
      FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM paths)),
    linked AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS up FROM prefixes),
    nodes AS MATERIALIZED (
      SELECT k, any_value(d) AS d, any_value(up) AS up, any_value(w) AS w, min(c) AS m, count(*) AS n,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS e FROM linked GROUP BY k),
    children AS MATERIALIZED (SELECT up AS k, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
    below AS (
      SELECT a.k, CAST(sum((u.n - 1) * u.w) AS BIGINT) AS saved, count(*) FILTER (h.k IS NULL) AS leaves
      FROM nodes u JOIN prefixes a ON a.c = u.m AND a.d <= u.d LEFT JOIN children h ON h.k = u.k GROUP BY a.k)
    SELECT x.m AS conv_id, x.d AS depth, p.m AS parent_conv_id, x.n AS n_convs, coalesce(n_children, 0) AS n_children, leaves AS n_leaves,
           saved AS saved_tokens, x.e AS ends_sha256
    FROM nodes x JOIN below USING (k) LEFT JOIN children USING (k) LEFT JOIN nodes p ON p.k = x.up"""


OP12_SQL = trie_sql()
