"""Personal data by weak supervision, with DataFrame functions only.

Candidates are the matches of the base formats (email, ip, card, phone) and of
wider patterns for the same kinds: written-out addresses, national phone
numbers, card numbers whose check digit fails, long network addresses.  Labelers
vote on each candidate: its format, its check digit or structure, a gazetteer
(domain endings, issuer prefixes, dialling codes, reserved networks), words
before it that speak for or against it, and its edges.  A generative model of
the votes (a rate for each labeler, kind and truth) is estimated by
expectation-maximisation over the table of vote patterns, one aggregate a round.
Its posteriors train the final span classifier, a logistic regression over kind,
votes and shape.  Base matches always stay; the classifier decides on the rest.

Patterns are written so that each text is scanned once and without recursion:
repetitions are possessive where that cannot change a match, and start only
where a run of their characters starts (or right behind the last match).

The texts are read once; the candidates are written to the shared folder.  The
table of vote patterns has at most PATTERN_BITS bits of key for each kind,
however large the corpus, and is all that reaches the driver.

Defined cases: null and empty texts have no span; spans are in code points, end
exclusive; spans of one kind do not overlap; repeated rows are scanned each; a
table without any candidate needs no model; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 12           # of expectation-maximisation
SURE = 0.5            # of the classifier, for a span beyond the base formats
PATTERN_BITS = 10     # votes and shape of a candidate

# Base formats.  In an email a run of address characters starts
# where no such character stands before, or where the last match ended.
LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
OCTETS = rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"

# Wider patterns.
EMAIL_WORDS = (rf"(?:(?<!{LOCAL})|\G){LOCAL}++(?: ?(?:\[at\]|\(at\)|\{{at\}}) ?| at )[A-Za-z0-9-]++"
               r"(?:(?: ?(?:\[dot\]|\(dot\)|\{dot\}) ?| dot |\.)[A-Za-z0-9-]++)++")
IP_LONG = r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
PHONE_HOME = r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])"

# Gazetteers and context words.
ENDINGS = r"(?i)(?:\.|dot[\])}]? ?)(?:com|org|net|edu|gov|info|io|eu|de|fr|es|uk|us|ca|it|nl|ch|at|be|co|example|test)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|30[0-5]|3[689]|35|6011|64[4-9]|65|62)"
DIALLING = r"^(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED = r"^(?:0+|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|22[4-9]|2[34][0-9]|25[0-5])\."
BEFORE = {"email": r"(?i)\b(?:e-?mails?|mail|contact|write|reach|correo|courriel|address)\b[^\n]{0,20}$",
          "ip": r"(?i)\b(?:ip|host|server|client|address|login|from|addr)\b[^\n]{0,20}$",
          "card": r"(?i)\b(?:cards?|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\b[^\n]{0,20}$",
          "phone": r"(?i)\b(?:phone|tel|telephone|mobile|cell|call|fax|telefon|tél|teléfono|whatsapp)\b[^\n]{0,20}$"}
AGAINST = r"(?i)\b(?:order|invoice|isbn|issn|version|release|serial|part|sku|ticket|tracking|section|build|figure|page|id|no)\b[^\n]{0,10}$"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches: array of (start, match, before, after); ``before`` is up
    to 40 characters between the last match and this one, ``after`` one character."""
    none = F.array().cast("array<struct<start:int,match:string,before:string,after:string>>")

    def place(m: Column, gaps: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            gap, match = F.element_at(gaps, i), F.element_at(m, i)
            start = acc["pos"] + F.char_length(gap)
            item = F.struct(start.alias("start"), match.alias("match"), F.right(gap, F.lit(40)).alias("before"),
                            F.left(F.element_at(gaps, i + 1), F.lit(1)).alias("after"))
            return F.struct((start + F.char_length(match)).alias("pos"), F.concat(acc["out"], F.array(item)).alias("out"))
        empty = F.struct(F.lit(0).alias("pos"), none.alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.size(m)), empty, step, lambda acc: acc["out"])

    # A one-element array and a lambda bind the matches and the gaps, so that each is found once.
    found = F.transform(F.array(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), lambda m: F.when(
        F.size(m) == 0, none).otherwise(F.element_at(F.transform(F.array(F.split(text, pattern, -1)), lambda gaps: place(m, gaps)), 1)))
    return F.element_at(found, 1)


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits holds."""
    size = F.char_length(number)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((size - i) % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def bit(*flags: Column) -> Column:
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(flags)), F.lit(0))


def judged(found: Column, kind: str, base: Column | None, check, gazetteer, offered=None) -> Column:
    """Array of (kind, start, end, base, pattern): candidates with their votes.
    ``base``, ``check``, ``gazetteer`` and ``offered`` are functions of a match."""
    def one(x: Column) -> Column:
        m = x["match"]
        strict = base(m) if base is not None else F.lit(False)
        edges = ~(F.right(x["before"], F.lit(1)).rlike("[A-Za-z0-9]") | x["after"].rlike("[A-Za-z0-9]"))
        votes = bit(strict, check(m), gazetteer(m), x["before"].rlike(BEFORE[kind]), ~x["before"].rlike(AGAINST), edges)
        size = F.least(F.lit(3), F.floor(F.char_length(m) / 8).cast("int"))
        dull = F.size(F.array_distinct(F.split(digits(m), ""))) <= 4
        shape = size * 64 + m.rlike("[ -]").cast("int") * 256 + dull.cast("int") * 512
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), (x["start"] + F.char_length(m)).alias("end"),
                        strict.alias("base"), (votes + shape).alias("pattern"))
    return F.transform(F.filter(found, lambda x: offered(x["match"])) if offered is not None else found, one)


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, found): all candidates of each text."""
    t = F.coalesce(F.col(text), F.lit(""))
    size = lambda m: F.char_length(digits(m))
    ending = lambda m: m.rlike(ENDINGS)
    has = lambda sign: F.instr(F.col("t"), sign) > 0
    none = F.array().cast("array<struct<kind:int,start:int,end:int,base:boolean,pattern:int>>")
    col = F.col("t")
    word_end = lambda m: m.rlike(r"[A-Za-z]{2,10}$")
    parts = [
        F.when(has("@"), judged(matches(col, EMAIL), "email", lambda m: F.lit(True), word_end, ending)),
        F.when(has("at"), judged(matches(col, EMAIL_WORDS), "email", None, word_end, ending, lambda m: m.rlike("dot|[\\[({]at"))),
        F.when(has("."), judged(matches(col, IP), "ip", lambda m: m.rlike(OCTETS), lambda m: ~m.rlike(r"(?:^|\.)0[0-9]"),
                                lambda m: ~m.rlike(RESERVED), lambda m: m.rlike(OCTETS))),
        F.when(has(":"), judged(matches(col, IP_LONG), "ip", None, lambda m: m.rlike("[a-fA-F]"), lambda m: m.rlike("^[23]"))),
        judged(matches(col, CARD), "card", lambda m: luhn(digits(m)), lambda m: luhn(digits(m)), lambda m: digits(m).rlike(ISSUERS),
               lambda m: size(m).between(13, 19)),
        F.when(has("+"), judged(matches(col, PHONE), "phone", lambda m: F.lit(True), lambda m: size(m).between(10, 13),
                                lambda m: digits(m).rlike(DIALLING), lambda m: size(m).between(9, 15))),
        judged(matches(col, PHONE_HOME), "phone", None, lambda m: size(m) == 10, lambda m: digits(m).rlike("^[2-9]..[2-9]")),
    ]
    return docs.select(F.col(doc_id), t.alias("t")).select(doc_id, F.concat(*[F.coalesce(p, none) for p in parts]).alias("found"))


# ---- label model and classifier ----------------------------------------------

VOTERS = 6


def vote(j: int) -> Column:
    return F.shiftright("pattern", j).bitwiseAND(F.lit(1)).cast("double")


def posterior(rates: dict[int, tuple]) -> Column:
    """P(true) of a row (kind, pattern) under the rates of each kind."""
    total = None
    for kind, (prior, yes, no) in rates.items():
        odds = F.lit(math.log(prior / (1 - prior)))
        for j in range(VOTERS):
            odds += F.when(vote(j) == 1, math.log(yes[j] / no[j])).otherwise(math.log((1 - yes[j]) / (1 - no[j])))
        total = (F.when if total is None else total.when)(F.col("kind") == kind, odds)
    return 1 / (1 + F.exp(-F.least(F.lit(30.0), F.greatest(F.lit(-30.0), total))))


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> Column:
    """Expectation-maximisation over (kind, pattern, n): the posterior of a row."""
    p = F.when(vote(0) == 1, 0.9).otherwise(F.when(sum(vote(j) for j in range(1, VOTERS)) >= 4, 0.6).otherwise(0.1))
    for _ in range(rounds):
        n = F.col("n")
        sums = patterns.withColumn("p", p).groupBy("kind").agg(
            F.sum(n).alias("all"), F.sum(n * F.col("p")).alias("true"),
            *[F.sum(n * F.col("p") * vote(j)).alias(f"yes{j}") for j in range(VOTERS)],
            *[F.sum(n * (1 - F.col("p")) * vote(j)).alias(f"no{j}") for j in range(VOTERS)]).collect()     # one row a kind
        rates = {r.kind: ((r.true + 1) / (r["all"] + 2), [(r[f"yes{j}"] + 1) / (r.true + 2) for j in range(VOTERS)],
                          [(r[f"no{j}"] + 1) / (r["all"] - r.true + 2) for j in range(VOTERS)]) for r in sums}
        p = posterior(rates)
    return p


def cells() -> list[Column]:
    """Of a row (kind, pattern): the kind, and by kind the votes and the shape."""
    out = []
    size = F.shiftright("pattern", VOTERS).bitwiseAND(F.lit(3))
    for k in range(len(KINDS)):
        mine = (F.col("kind") == k).cast("double")
        out += [mine, *[mine * vote(j) for j in range(VOTERS)], mine * vote(8), mine * vote(9)]
        out += [mine * (size == s).cast("double") for s in range(1, 4)]
    return out


def odds(weights: list[float], start: float) -> Column:
    """The classifier's log odds as a column over the cells.  Scoring with the
    fitted model itself would send its summary, and with it the session, to the tasks."""
    return F.lit(start) + sum((F.lit(w) * c for w, c in zip(weights, cells()) if w), F.lit(0.0))


def accepted(found: DataFrame) -> list[int]:
    """The keys (kind * 2**PATTERN_BITS + pattern) that the final classifier takes for
    personal data, of all that occur."""
    counted = found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.pattern").agg(F.count("*").alias("n"))
    patterns = counted.coalesce(1).orderBy("kind", "pattern").persist()          # at most 4 * 2**PATTERN_BITS rows
    try:
        if patterns.isEmpty():
            return []
        soft = patterns.withColumn("p", estimate(patterns)).withColumn("features", array_to_vector(F.array(*cells())))
        rows = soft.select("features", F.explode(F.array(
            F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("w")),
            F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("w")))).alias("x")).select("features", "x.label", "x.w")
        total = rows.agg(F.sum("w")).first()[0]
        model = LogisticRegression(weightCol="w", regParam=1e-3, maxIter=50).fit(rows.withColumn("w", F.col("w") / total + 1e-9))
        sure = soft.where(odds(model.coefficients.toArray().tolist(), model.intercept) >= math.log(SURE / (1 - SURE)))
        return [r.kind << PATTERN_BITS | r.pattern for r in sure.select("kind", "pattern").collect()]
    finally:
        patterns.unpersist()


def joined(spans: Column) -> Column:
    """kind:start:end by kind, then start, comma-joined."""
    def one(x: Column) -> Column:
        name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["kind"] + 1)
        return F.concat_ws(":", name, x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(F.transform(spans, lambda x: F.struct(x["kind"], x["start"], x["end"]))), one), ",")


def find(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)."""
    found = written(spark, candidates(docs, doc_id, text), "pii-candidates")
    keys = F.array(*[F.lit(k) for k in sorted(accepted(found))]).cast("array<int>")
    base = F.filter("found", lambda x: x["base"])

    def free(x: Column) -> Column:
        return ~F.exists(base, lambda b: (b["kind"] == x["kind"]) & (b["start"] < x["end"]) & (x["start"] < b["end"]))
    more = F.filter("found", lambda x: ~x["base"] & F.array_contains(keys, F.shiftleft(x["kind"], PATTERN_BITS) + x["pattern"]))
    rows = found.withColumn("base", base).withColumn("more", more)
    rows = rows.withColumn("more", F.when(F.size("more") == 0, F.col("more")).otherwise(F.filter("more", free)))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select(doc_id, *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                       joined(F.concat("base", "more")).alias("spans"), F.size("more").cast("long").alias("n_added"))


def op2_pii_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(spark, table(spark, sf_dir, "documents"))
