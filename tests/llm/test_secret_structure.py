import base64
import hashlib
import json
import random
import re

from tickloom.llm import secret_structure as ss


def tlv(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x80 | 2]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + content


def number(n_bytes):
    return tlv(2, b"\x01" + bytes(range(n_bytes - 1)))


PAIR = tlv(0x30, tlv(2, b"\0") + b"".join(number(n) for n in (128, 3, 128, 64, 64, 64, 64, 64)))
WRAPPED = tlv(0x30, tlv(2, b"\0") + tlv(0x30, tlv(6, b"\x2a\x86\x48") + tlv(5, b"")) + tlv(4, PAIR))
CURVE = tlv(0x30, tlv(2, b"\1") + tlv(4, bytes(range(32))) + tlv(0xA0, tlv(6, b"\x2a\x86")))


def string(b):
    return len(b).to_bytes(4, "big") + b


FILE = ss.KEY_FILE + string(b"none") + string(b"none") + string(b"") + (1).to_bytes(4, "big") + string(b"pub" * 9) + string(b"x" * 90)


def b64(raw, url=False):
    return (base64.urlsafe_b64encode if url else base64.b64encode)(raw).decode().rstrip("=" if url else "")


TOKEN = ".".join([b64(json.dumps({"alg": "HS256", "typ": "JWT"}).encode(), True), b64(b'{"sub":"1"}', True), "c2ln"])


def kinds(text):
    return [(k, text[a:b]) for k, a, b in ss.confirmed(text)]


def test_structures_are_confirmed():
    assert kinds(f"x {TOKEN} y") == [("token", TOKEN)]
    for raw in (PAIR, WRAPPED, CURVE, FILE):
        assert kinds(f"é {b64(raw)} y") == [("key", b64(raw))]
        assert kinds(raw.hex()) == [("key", raw.hex())]
    block = "-----BEGIN RSA PRIVATE KEY-----\nDEK-Info: a-b\n\n" + b64(PAIR)[:64] + "\n" + b64(PAIR)[64:] + "\n-----END RSA PRIVATE KEY-----"
    assert kinds(f"a {block} b") == [("key", block)]
    assert kinds(b64(block.encode())) == [("key", b64(block.encode()))]
    assert kinds(b64(TOKEN.encode())) == [("key", b64(TOKEN.encode()))]


def test_broken_structures_are_not():
    assert kinds(b64(PAIR[:-1])) == [] and kinds(b64(PAIR + b"\0\0\0")) == []
    assert kinds(b64(FILE[:-20])) == []
    assert kinds("aaaaaaaaaaaa.bbbbbbbbbb.cccc") == []
    assert kinds(b64(b'{"typ":"JWT"}', True) + "." + b64(b"{}", True) + ".x") == []
    assert kinds("A" * 5000) == [] and kinds("0" * 5000) == [] and kinds("." * 5000) == []
    assert ss.unbase64("A" * 41) is None
    deep = b"\x30" * 4000
    assert not ss.nested_key(deep)
    assert kinds(b64(b"[" * 100000, True) + ".e30.x") == []


def slow_base(text):
    out = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for i, (kind, pattern, least) in enumerate([("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)]):
        out += [(m.start(), i + 1, kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def test_base_spans_against_plain_patterns():
    rnd = random.Random(1)
    parts = ["token", "ToKen", "toKen", "paſſword", "password", "api_key", "apikey", "=", ":", " ", '"', "abc123", "AKIA", "AKIAAKIA",
             "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "é", "\n", "secret", "x", ".", "-"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 14)))
        assert ss.joined(ss.spans(text)[0]) == slow_base(text), text


def test_scan_and_redaction(spark):
    rows = [(1, f"A password = hunter22 and {TOKEN}", 5), (2, None, None), (3, "", 0), (1, "é" * 50 + " AKIA" + "Z" * 16, 1),
            (None, "token=abcdef012345678901234567890123", 3), (4, "clean text", 10), (4, "clean text", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").selectExpr("*", "1 as spans", "2 as n_key")
    got = {(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.n_token): r for r in ss.scan(docs).collect()}
    assert set(got) == {(1, 1, 0, 0, 1), (2, 0, 0, 0, 0), (3, 0, 0, 0, 0), (1, 0, 1, 0, 0), (None, 1, 0, 1, 0), (4, 0, 0, 0, 0)}
    r = got[(None, 1, 0, 1, 0)]
    assert r.spans == "assign:0:36,hex:6:36" and r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    clean = ss.redact(docs)
    assert clean.columns == docs.columns
    text = sorted((r.doc_id or 0, r.text or "", r.n_chars or 0) for r in clean.collect())
    assert text == sorted([(1, "A [REDACTED] and [REDACTED]", 27), (2, "", 0), (3, "", 0), (1, "é" * 50 + " [REDACTED]", 61),
                           (0, "[REDACTED]", 10), (4, "clean text", 10), (4, "clean text", 10)])
    assert ss.scan(docs.limit(0)).collect() == [] and ss.redact(docs.limit(0)).collect() == []
