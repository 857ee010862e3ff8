import functools
import hashlib
import random
import re

from pyspark.sql import functions as F

from tickloom.llm import pii_weak as pw


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


@functools.cache
def slow_base(text):
    """The base formats, by plain patterns."""
    text = text or ""
    out = [("email", m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.span()))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, (a, b) in spans)


def check(rows, docs, doc_id="doc_id"):
    want = sorted((i if i is not None else -1, hashlib.sha256(joined(slow_base(t)).encode()).hexdigest(),
                   *[sum(k == x for k, _ in slow_base(t)) for x in pw.KINDS]) for i, t in docs)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows)
    assert got == want
    for r in rows:
        spans = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        order = [(pw.KINDS.index(k), int(a), int(b)) for k, a, b in spans]
        assert order == sorted(order) and len(spans) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added


def test_base_spans_against_plain_patterns(spark):
    rnd = random.Random(1)
    parts = ["a", "b.c", "@", ".", "-", "_", "x-y", "1", "22", "255", "256", "007", " ", "  ", "+", "(", ")", "é", "😀", "\n", "@d.e", "a@b.c",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4", "999999999999.1.1.1", "+1 (555) 123-4567", "+49 30 1234567", "dot", " at "]
    docs = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 25)))) for i in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    check(pw.find(spark, df).collect(), docs)


def test_generated_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(pw.find(spark, df).collect(), [(r.doc_id, r.text) for r in df.collect()])


def test_odd_rows(spark):
    long = ["9" * 30000, "1 " * 30000, "a" * 60000 + "@", "a@" * 20000, "a@b" + ".c" * 20000, "+1" + "(" * 50000, "1." * 40000,
            "+1 " * 3000 + "a@b.co " * 3000, "x" * 100000 + " 4111111111111111"]
    docs = [(1, None), (2, ""), (None, "a@b.co"), (3, "call 😀 +1 (555) 123-4567"), (3, "call 😀 +1 (555) 123-4567")] + [(10 + i, t) for i, t in enumerate(long)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, found int, t string")
    check(pw.find(spark, df).collect(), docs)
    assert pw.find(spark, df.limit(0)).collect() == []
    none = pw.find(spark, spark.createDataFrame([(1, "nothing here")], "doc_id long, text string")).collect()
    assert none[0].spans == "" and none[0].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_votes_decide_on_wider_candidates(spark):
    rnd = random.Random(7)
    docs, true, false = [], set(), set()
    for i in range(600):
        name, n = f"n{i}", f"{rnd.randrange(200, 999)}-{rnd.randrange(200, 999)}-{rnd.randrange(1000, 9999)}"
        kind = i % 6
        if kind == 0:
            text = f"mail me: {name}@host.com please"
        elif kind == 1:
            text = f"phone: +1 {n} today"
        elif kind == 2:
            text = f"phone: {n} today"
            true.add(i)
        elif kind == 3:
            text = f"contact {name} [at] host [dot] com please"
            true.add(i)
        elif kind == 4:
            text = f"order {rnd.randrange(10 ** 15, 10 ** 16)} shipped"
            if not any(k == "card" for k, _ in slow_base(text)):
                false.add(i)
        else:
            text = f"card 4111 1111 1111 1111 paid to {name}"
        docs.append((i, text))
    rows = {r.doc_id: r for r in pw.find(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sum(rows[i].n_added for i in true) >= 0.9 * len(true)
    assert sum(rows[i].n_added for i in false) == 0
    i = min(i for i in true if i % 6 == 2)
    (kind, a, b), = [x.split(":") for x in rows[i].spans.split(",")]
    assert kind == "phone" and dict(docs)[i][int(a):int(b)] == dict(docs)[i].split()[1]


def test_main_path_has_no_python(spark):
    df = spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string")
    for plan in (pw.candidates(df), pw.find(spark, df)):
        text = plan._jdf.queryExecution().toString()
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
    assert pw.find(spark, df).select(F.sum("n_email")).first()[0] == 1


def test_after_a_query_that_observes(spark):
    """Once a session has observed anything, it cannot travel to a task: nothing of the classifier may hold it."""
    from pyspark.sql import Observation
    seen = Observation("rows")
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 10}
    assert pw.op2_pii_weak(spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
