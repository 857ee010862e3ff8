"""Secret scan with structural confirmation.

Base formats (assignments, access ids, hex runs) are found by pattern.  Beyond
them, runs of base64 or hex characters, dotted triples and key blocks are
candidates only: they are decoded and reported if the decoded bytes have the
structure of a secret, that is
- a private key as nested tag-length-value (all nested lengths must add up,
  and the fields must be those of a key),
- a private key file of length-prefixed strings,
- a signed token whose header is a JSON object that names its algorithm and
  whose payload is a JSON object,
- or, once more encoded, any of these.

Defined cases: null and empty texts have no spans; spans are in code points,
end exclusive, and may overlap between kinds; repeated rows are scanned each;
further columns are ignored by the scan and kept by the redaction.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, map_texts, table

# Base formats.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_LEAST = 6
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "token", "key")
MARK = "[REDACTED]"

# Candidates.
TRIPLE = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{2,})\.[A-Za-z0-9_-]*")
BLOCK = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:(?!-----)[\s\S])*)-----END \1-----")
RUN64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
RUN16 = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
DEPTH = 2     # encodings within encodings


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


# ---- structure --------------------------------------------------------------

def unbase64(run: str) -> bytes | None:
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return None


def fields(raw: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of each tag-length-value of ``raw``; None unless their
    lengths add up to all of it."""
    out, at = [], 0
    while at < len(raw):
        if at + 2 > len(raw):
            return None
        tag, length = raw[at], raw[at + 1]
        at += 2
        if length & 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or at + n > len(raw):
                return None
            length = int.from_bytes(raw[at:at + n], "big")
            at += n
        if at + length > len(raw):
            return None
        out.append((tag, raw[at:at + length]))
        at += length
    return out


# Tags.
INTEGER, OCTETS, OBJECT, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def nested_key(raw: bytes) -> bool:
    """A private key as nested tag-length-value."""
    outer = fields(raw) if raw[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    parts = fields(outer[0][1])
    if not parts or parts[0][0] != INTEGER or len(parts[0][1]) != 1:
        return False
    tags, version = [t for t, _ in parts], parts[0][1][0]
    if version in (0, 1) and len(tags) >= 9 and all(t == INTEGER for t in tags[:9]) and len(parts[1][1]) >= 16:
        return True                                                     # version and the numbers of a key pair
    if version == 0 and len(tags) == 6 and all(t == INTEGER for t in tags) and len(parts[1][1]) >= 16:
        return True
    if version in (0, 1) and tags[1:3] == [SEQUENCE, OCTETS]:
        kind = fields(parts[1][1])
        return bool(kind) and kind[0][0] == OBJECT and len(parts[2][1]) >= 16     # algorithm and wrapped key
    return version == 1 and tags[1:2] == [OCTETS] and len(parts[1][1]) >= 16 and all(t >= 0xA0 for t in tags[2:])


# Fixed value: first bytes of the key file format of length-prefixed strings.
KEY_FILE = b"openssh-key-v1\0"


def prefixed_key(raw: bytes) -> bool:
    """A key file of length-prefixed strings: cipher, derivation, its options,
    the number of keys, and that many public parts before a private part."""
    if not raw.startswith(KEY_FILE):
        return False
    at, n = len(KEY_FILE), None

    def string():
        nonlocal at
        if at + 4 > len(raw):
            return None
        size = int.from_bytes(raw[at:at + 4], "big")
        at += 4 + size
        return raw[at - size:at] if at <= len(raw) else None

    if any(string() is None for _ in range(3)) or at + 4 > len(raw):
        return False
    n = int.from_bytes(raw[at:at + 4], "big")
    at += 4
    return 1 <= n <= 16 and all(string() is not None for _ in range(n + 1))


def signed_token(header: str, payload: str) -> bool:
    def parsed(part):
        raw = unbase64(part)
        try:
            return json.loads(raw) if raw else None
        except (ValueError, RecursionError):
            return None
    head = parsed(header)
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(parsed(payload), dict)


def confirmed_bytes(raw: bytes | None, depth: int) -> bool:
    if not raw:
        return False
    if nested_key(raw) or prefixed_key(raw):
        return True
    if depth <= 0:
        return False
    try:
        text = raw.decode("ascii").strip()
    except UnicodeDecodeError:
        return False
    return any(True for _ in confirmed(text, depth - 1))


def confirmed(text: str, depth: int = DEPTH) -> Iterator[tuple[str, int, int]]:
    """Candidates of ``text`` whose structure holds, leftmost first; a run inside
    an earlier span is not looked at again."""
    taken: list[tuple[int, int]] = []          # disjoint, sorted

    def free(m):
        i = bisect.bisect_left(taken, m.span())
        return (i == len(taken) or taken[i][0] >= m.end()) and (i == 0 or taken[i - 1][1] <= m.start())

    if "PRIVATE KEY-----" in text:
        for m in BLOCK.finditer(text):
            body = "".join(x.strip() for x in re.split(r"\n|\\n", m[2]) if ":" not in x)
            if confirmed_bytes(unbase64("".join(body.split())), 0):
                bisect.insort(taken, m.span())
                yield "key", *m.span()
    if "." in text:
        for m in TRIPLE.finditer(text):
            if free(m) and signed_token(m[1], m[2]):
                bisect.insort(taken, m.span())
                yield "token", *m.span()
    for pattern, decode in ((RUN16, lambda s: bytes.fromhex(s)), (RUN64, unbase64)):
        for m in pattern.finditer(text):
            if free(m) and confirmed_bytes(decode(m[0]), depth):
                bisect.insort(taken, m.span())
                yield "key", *m.span()


def spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and all spans, by start, then kind."""
    def order(s):
        return s[1], KINDS.index(s[0]), s[2]
    base = sorted(base_spans(text), key=order)
    return base, sorted(base + list(confirmed(text)), key=order)


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_token, n_key)."""
    out = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in BASE]
                       + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
                       + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS[len(BASE):]])

    def make():
        def one(text):
            base, every = spans(text)
            count = [sum(s[0] == k for s in every) for k in KINDS]
            return [*count[:3], hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), *count[3:]]
        return lambda texts: [list(c) for c in zip(*map(one, texts))]
    return map_texts(docs, [doc_id], text, out, make)


def redacted(text: str) -> str:
    """``text`` with each stretch of overlapping spans replaced by MARK."""
    out, at, end = [], 0, 0
    for _, a, b in spans(text)[1]:
        if a >= end:
            out += [text[at:a], MARK]
        at = end = max(end, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced in ``text`` (null stays null) and, where it
    changed, ``length`` recounted."""
    keep, clean = docs.columns, fresh(docs, "clean")

    def make():
        return lambda texts: [list(map(redacted, texts))]
    done = map_texts(docs, keep, text, T.StructType([T.StructField(clean, T.StringType())]), make)
    changed = F.col(text).isNotNull() & (F.col(clean) != F.col(text))
    cols = {text: F.when(F.col(text).isNotNull(), F.col(clean))}
    if length in keep:
        cols[length] = F.when(changed, F.char_length(clean).cast(docs.schema[length].dataType)).otherwise(F.col(length))
    return done.select(*[cols.get(c, F.col(f"`{c}`")).alias(c) for c in keep])


def op5_secret_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
