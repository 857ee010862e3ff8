"""Sentiment scoring and aggregation over posts and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import rnd as R
from ..operators import sentiment as st
from ..operators import text_model as tm
from ..operators.indicators import distribution
from ..session import materialize, scratch_path
from ..sources import fixtures as fx
from ..sources.tables import read_table
from .oracle import with_views
from .registry import register

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def clean_posts(spark, sf, labelled=True):
    """B5-B7 + G2/G3 over the posts view: typed ids and counters, UTC
    timestamp (unparsable rows dropped), day, continuous score and label
    (``labelled=False``: without these two and without the labels join)."""
    p = fx.posts(spark, sf) if labelled else fx.raw_posts(spark, sf).withColumn("label", F.lit(None).cast("string"))
    ts = F.try_to_timestamp(F.col("ts_text"), F.lit(TS_FORMAT))
    c = p.select(
        F.col("id").cast("string").alias("tweet_id"), ts.alias("fecha_utc"),
        F.col("text").alias("contenido_texto"),
        F.coalesce(F.col("retweets"), F.lit(0)).cast("bigint").alias("retweets"),
        F.coalesce(F.col("favoritos"), F.lit(0)).cast("bigint").alias("favoritos"),
        "symbol", "label", "score", "lang")
    c = c.where(F.col("fecha_utc").isNotNull() & F.col("tweet_id").isNotNull())
    if not labelled:
        return c.drop("label", "score").withColumn("fecha_limpia", F.to_date("fecha_utc"))
    return c.withColumns({
        "fecha_limpia": F.to_date("fecha_utc"),
        "puntuacion_sentimiento": st.continuous_score("label", "score"),
        "sentimiento": st.normalise_label("label"),
    })


def daily_social(spark, sf):
    return st.daily_sentiment(clean_posts(spark, sf))


POSTS_CTES = [
    ("clean", """
        SELECT CAST(id AS VARCHAR) AS tweet_id, try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') AS fecha_utc,
               text AS contenido_texto, CAST(coalesce(retweets, 0) AS BIGINT) AS retweets,
               CAST(coalesce(favoritos, 0) AS BIGINT) AS favoritos, symbol, label, score, lang,
               CAST(try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') AS DATE) AS fecha_limpia,
               round(CASE WHEN lower(label) LIKE '%pos%' OR lower(label) LIKE '%label_2%' THEN 0.5 + score * 0.5
                          WHEN lower(label) LIKE '%neg%' OR lower(label) LIKE '%label_0%' THEN 0.5 - score * 0.5
                          ELSE 0.5 END, 4) AS puntuacion_sentimiento,
               CASE WHEN lower(label) LIKE '%pos%' OR lower(label) LIKE '%label_2%' THEN 'positive'
                    WHEN lower(label) LIKE '%neg%' OR lower(label) LIKE '%label_0%' THEN 'negative'
                    ELSE 'neutral' END AS sentimiento
        FROM posts WHERE try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') IS NOT NULL"""),
    ("social", """
        SELECT symbol, fecha_limpia, count(puntuacion_sentimiento) AS volumen_posts,
               avg(puntuacion_sentimiento) AS sentimiento_medio,
               coalesce(stddev_samp(puntuacion_sentimiento), 0.0) AS sentimiento_std
        FROM clean WHERE fecha_limpia IS NOT NULL GROUP BY symbol, fecha_limpia"""),
]


def posts_sql(body: str, extra=None) -> str:
    return with_views(["posts"], body, POSTS_CTES + (extra or []))


# Fixed values (SQL twin of the lexicon scorer): see operators.sentiment.
_POS = "[" + ", ".join(f"'{w}'" for w in st.POSITIVE_WORDS) + "]"
_NEG = "[" + ", ".join(f"'{w}'" for w in st.NEGATIVE_WORDS) + "]"
# The documents seldom hold a lexicon word, so one to three are added to four of
# five texts: every branch of the scorers is then reached.
ADDED = {0: " " + st.POSITIVE_WORDS[0], 1: " " + st.NEGATIVE_WORDS[0], 2: f" {st.POSITIVE_WORDS[1]} {st.NEGATIVE_WORDS[1].upper()}",
         3: f" {st.NEGATIVE_WORDS[2]}, {st.NEGATIVE_WORDS[3]}; {st.POSITIVE_WORDS[2]}"}
TEXTS_CTE = ("texts", "SELECT doc_id, concat(text, CASE doc_id % 5 "
             + " ".join(f"WHEN {k} THEN '{v}'" for k, v in ADDED.items()) + " ELSE '' END) AS text FROM documents")


def scored_texts(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    more = F.lit("")
    for k, v in ADDED.items():
        more = F.when(F.col("doc_id") % 5 == k, v).otherwise(more)
    return d.select("doc_id", F.concat(F.coalesce("text", F.lit("")), more).alias("text"))


LEX_CTE = ("lex", f"""
    SELECT doc_id, len(list_filter(w, lambda x: list_contains({_POS}, x))) AS n_pos,
           len(list_filter(w, lambda x: list_contains({_NEG}, x))) AS n_neg
    FROM (SELECT doc_id, regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}]+') AS w FROM texts)""")
LEX_OUT = """
    SELECT doc_id, CASE WHEN n_pos > n_neg THEN 'positive' WHEN n_neg > n_pos THEN 'negative' ELSE 'neutral' END AS label,
           round(CASE WHEN n_pos + n_neg = 0 THEN 0.5 ELSE 0.5 + 0.5 * abs(n_pos - n_neg) / (n_pos + n_neg) END, 6) AS score,
           CAST(n_pos AS INTEGER) AS n_pos, CAST(n_neg AS INTEGER) AS n_neg FROM lex"""


@register("g1_lexicon_scoring", with_views([], LEX_OUT, [TEXTS_CTE, LEX_CTE]))
def q_g1(spark, sf):
    d = scored_texts(spark, sf)
    s = st.lexicon_score("text")
    return d.select("doc_id", s["label"].alias("label"), R(s["score"], 6).alias("score"),
                    s["n_pos"].alias("n_pos"), s["n_neg"].alias("n_neg"))


class FlakyLexiconScorer:
    """A batch scorer with the lexicon rule, written in Python, that fails on
    very short texts - it exercises the ``mapInPandas`` path and the per-row
    failure isolation (G10)."""

    min_chars = 50

    def __call__(self, texts):
        import regex
        out = []
        pos_set, neg_set = set(st.POSITIVE_WORDS), set(st.NEGATIVE_WORDS)
        for t in texts:
            if len(t) < self.min_chars:
                raise ValueError("text too short for the model")
            words = regex.split(r"[^\p{L}]+", t.lower())
            p = sum(w in pos_set for w in words)
            n = sum(w in neg_set for w in words)
            lab = "positive" if p > n else "negative" if n > p else "neutral"
            out.append((lab, 0.5 if p + n == 0 else 0.5 + 0.5 * abs(p - n) / (p + n)))
        return out


@register("g10_isolated_batch_scoring", with_views([], """
    SELECT doc_id, CASE WHEN length(coalesce(text, '')) < 50 THEN 'ERROR'
                        WHEN n_pos > n_neg THEN 'positive' WHEN n_neg > n_pos THEN 'negative' ELSE 'neutral' END AS label,
           round(CASE WHEN length(coalesce(text, '')) < 50 THEN 0.0 WHEN n_pos + n_neg = 0 THEN 0.5
                      ELSE 0.5 + 0.5 * abs(n_pos - n_neg) / (n_pos + n_neg) END, 6) AS score
    FROM lex JOIN texts USING (doc_id)""", [TEXTS_CTE, LEX_CTE]))
def q_g10(spark, sf):
    d = scored_texts(spark, sf)
    s = st.score_texts(d, "text", scorer=FlakyLexiconScorer(), batch_size=16)
    return s.select("doc_id", "label", R("score", 6).alias("score"))


@register("g2_continuous_score", posts_sql("SELECT tweet_id, puntuacion_sentimiento FROM clean"))
def q_g2(spark, sf):
    return clean_posts(spark, sf).select("tweet_id", "puntuacion_sentimiento")


@register("g3_label_normalisation", posts_sql("SELECT tweet_id, label, sentimiento FROM clean"))
def q_g3(spark, sf):
    return clean_posts(spark, sf).select("tweet_id", "label", "sentimiento")


@register("g4_daily_sentiment", posts_sql("""
    SELECT symbol, fecha_limpia, volumen_posts, round(sentimiento_medio, 6) AS sentimiento_medio,
           round(sentimiento_std, 6) AS sentimiento_std FROM social"""))
def q_g4(spark, sf):
    d = daily_social(spark, sf)
    return d.select("symbol", "fecha_limpia", "volumen_posts", R("sentimiento_medio", 6).alias("sentimiento_medio"),
                    R("sentimiento_std", 6).alias("sentimiento_std"))


@register("g5_sentiment_summary", posts_sql("""
    SELECT symbol, round(avg(volumen_posts), 6) AS volumen_medio,
           round(coalesce(avg(sentimiento_medio), 0.5), 9) AS sentimiento_global FROM social GROUP BY symbol"""))
def q_g5(spark, sf):
    s = st.sentiment_summary(daily_social(spark, sf))
    return s.select("symbol", R("volumen_medio", 6).alias("volumen_medio"),
                    R("sentimiento_global", 9).alias("sentimiento_global"))


@register("g6_top_posts_per_day", posts_sql("""
    SELECT symbol, fecha_limpia, tweet_id, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol, fecha_limpia
                                   ORDER BY favoritos + retweets DESC, tweet_id) AS rank FROM clean WHERE lang = 'en')
    WHERE rank <= 300"""))
def q_g6(spark, sf):
    """English posts only, the 300 best per symbol-day (reference defaults)."""
    en = clean_posts(spark, sf).where(F.col("lang") == "en")
    t = st.top_n_per_day(en, n=300)
    return t.select("symbol", "fecha_limpia", "tweet_id", "rank")


@register("g7_label_value_daily", posts_sql("""
    SELECT symbol, fecha_limpia, round(avg(CASE lbl WHEN 'Positive' THEN 1 WHEN 'Neutral' THEN 0 WHEN 'Negative' THEN -1 END), 6)
           AS daily_label_mean, count(*) AS posts
    FROM (SELECT symbol, fecha_limpia, CASE WHEN favoritos = 0 THEN 'Unknown'
                                            ELSE upper(substr(label, 1, 1)) || substr(label, 2) END AS lbl FROM clean)
    GROUP BY symbol, fecha_limpia"""))
def q_g7(spark, sf):
    c = clean_posts(spark, sf)
    lbl = F.when(F.col("favoritos") == 0, F.lit("Unknown")).otherwise(F.initcap("label"))
    v = c.select("symbol", "fecha_limpia", st.label_value(lbl).alias("v"))
    return v.groupBy("symbol", "fecha_limpia").agg(R(F.avg("v"), 6).alias("daily_label_mean"),
                                                   F.count(F.lit(1)).alias("posts"))


@register("g8_answer_label", with_views([], """
    SELECT conv_id, turn, CASE WHEN trim(coalesce(text, '')) = '' THEN 'Vacio'
                               WHEN contains(lower(trim(text)), 'positivo') THEN 'Positivo'
                               WHEN contains(lower(trim(text)), 'negativo') THEN 'Negativo'
                               WHEN contains(lower(trim(text)), 'neutro') THEN 'Neutro'
                               ELSE 'Indeterminado' END AS answer_label
    FROM (SELECT conv_id, turn, CASE (conv_id + turn) % 7 WHEN 0 THEN 'Creo que es POSITIVO. ' || text WHEN 1 THEN text || ' (negativo)'
                 WHEN 2 THEN 'neutro' WHEN 3 THEN '   ' WHEN 4 THEN 'Neutro, no negativo' WHEN 5 THEN NULL ELSE text END AS text
          FROM conversations)"""))
def q_g8(spark, sf):
    """Model answers made from the turns, so that every reading occurs."""
    c = read_table(spark, sf, "conversations").select("conv_id", "turn", "text")
    k = (F.col("conv_id") + F.col("turn")) % 7
    answer = (F.when(k == 0, F.concat(F.lit("Creo que es POSITIVO. "), "text")).when(k == 1, F.concat("text", F.lit(" (negativo)")))
              .when(k == 2, "neutro").when(k == 3, "   ").when(k == 4, "Neutro, no negativo").when(k == 6, F.col("text")))
    return c.select("conv_id", "turn", st.answer_label(answer).alias("answer_label"))


@register("g9_batch_alignment", posts_sql("""
    SELECT symbol, batch, CAST(generate_subscripts(labels, 1) - 1 AS INTEGER) AS pos, unnest(labels) AS label FROM (
      SELECT symbol, batch,
             list_resize(list_transform(string_split(answer, ','),
                                        lambda s: upper(substr(trim(s), 1, 1)) || lower(substr(trim(s), 2))),
                         want, 'Error') AS labels
      FROM (SELECT symbol, batch, string_agg(sentimiento, ', ' ORDER BY id) AS answer,
                   CAST(count(*) + batch % 3 - 1 AS INTEGER) AS want
            FROM (SELECT symbol, CAST(tweet_id AS BIGINT) AS id, sentimiento,
                         CAST(floor(CAST(tweet_id AS BIGINT) / 16) AS BIGINT) AS batch FROM clean)
            GROUP BY symbol, batch)
      WHERE want > 0)"""))
def q_g9(spark, sf):
    c = clean_posts(spark, sf).withColumn("_id", F.col("tweet_id").cast("bigint"))
    b = c.groupBy("symbol", F.floor(F.col("_id") / 16).cast("bigint").alias("batch")).agg(
        F.concat_ws(", ", F.transform(F.sort_array(F.collect_list(F.struct("_id", "sentimiento"))),
                                      lambda s: s["sentimiento"])).alias("answer"),
        F.count(F.lit(1)).alias("n"))
    b = b.withColumn("want", (F.col("n") + F.col("batch") % 3 - 1).cast("int")).where(F.col("want") > 0)
    a = b.select("symbol", "batch", F.posexplode(st.align_batch_answers("answer", "want")).alias("pos", "label"))
    return a.select("symbol", "batch", F.col("pos").cast("int").alias("pos"), "label")


@register("g11_label_distribution", posts_sql("""
    SELECT sentimiento, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM clean), 6) AS pct
    FROM clean GROUP BY 1"""))
def q_g11(spark, sf):
    d = distribution(clean_posts(spark, sf).select("sentimiento"), "sentimiento")
    return d.select("sentimiento", "n", R("pct", 6).alias("pct"))


@register("g12_throughput_rows", with_views([], """
    SELECT CASE WHEN n_pos > n_neg THEN 'positive' WHEN n_neg > n_pos THEN 'negative' ELSE 'neutral' END AS label, count(*) AS rows
    FROM lex GROUP BY 1""", [TEXTS_CTE, LEX_CTE]))
def q_g12(spark, sf):
    """Rows scored per label; the same frame carries the observed row count
    that the throughput report reads (timings vary per run)."""
    scored, _ = st.throughput(st.score_texts(scored_texts(spark, sf), "text"), "g12")
    return scored.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


@register("g12_throughput_report", "SELECT count(*) AS rows, true AS took_time, true AS rate_agrees FROM documents")
def q_g12b(spark, sf):
    """The report of a scoring pass: the rows that the executors counted as they scored them, and the rate."""
    scored, report = st.throughput(st.score_texts(scored_texts(spark, sf), "text"), "g12 report")
    scored.write.format("noop").mode("overwrite").save()
    r = report()
    whole = spark.createDataFrame([(r["rows"], r["seconds"], r["rows_per_sec"])], "rows bigint, seconds double, rate double")
    return whole.select("rows", (F.col("seconds") > 0).alias("took_time"),
                        (F.abs(F.col("rate") * F.col("seconds") - F.col("rows")) < 1e-6).alias("rate_agrees"))


# ------------------------------------------------------- the learnt scorer

_MODELS: dict[tuple, str] = {}
HELD_OUT = 5            # one of so many texts is kept from the fit


def labelled_texts(spark, sf):
    """Every document with its label (NULL without one) and whether it is kept from the fit."""
    lab = read_table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    kept = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT == 0
    return d.join(lab, "doc_id", "left").withColumn("held_out", kept)


def sentiment_model(spark, sf):
    """Path of the model fitted on the labelled texts; one fit a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        rows = materialize(spark, labelled_texts(spark, sf).where(~F.col("held_out") & F.col("quality").isNotNull()))
        _MODELS[key] = tm.fit(rows, scratch_path(spark, "sentiment_model"), label="quality")
    return _MODELS[key]


@register("g1_learnt_scoring", """
    SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'positive' WHEN l.quality = 0 THEN 'negative' END AS given,
           true AS is_share, true AS beats_coin
    FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) l USING (doc_id)""")
def q_g1b(spark, sf):
    """Every document by the model that the labels taught; on the labelled texts kept from the fit the mean of the
    classes' right shares is more than two standard errors above a coin's."""
    s = st.score_texts(labelled_texts(spark, sf), "text", loader=tm.Loader(spark, sentiment_model(spark, sf)))
    s = materialize(spark, s.drop("text"))
    given = F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative")
    right = F.avg((F.col("label") == given).cast("int"))
    classes = s.where("held_out AND quality IS NOT NULL").groupBy("quality").agg(
        right.alias("right"), (0.25 / F.count(F.lit(1))).alias("spread"))
    coin = 0.5 + 2 * F.sqrt(F.sum("spread")) / F.count(F.lit(1))
    return s.select("doc_id", given.alias("given"), (F.col("label").isin("positive", "negative") & F.col("score").between(0.5, 1)).alias("is_share"),
                    classes.select(F.avg("right") > coin).scalar().alias("beats_coin"))


@register("g10_isolated_learnt_scoring", r"""
    SELECT doc_id, regexp_matches(text, '\p{L}') AND doc_id % 11 <> 0 AS scored, true AS errors_score_zero FROM documents""")
def q_g10b(spark, sf):
    """One of eleven texts has lost its words: the learnt scorer fails on it, and the others of its batch keep their scores."""
    lost = F.regexp_replace("text", r"\p{L}", " ")
    d = read_table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 11 == 0, lost).otherwise(F.col("text")).alias("text"))
    s = st.score_texts(d, "text", loader=tm.Loader(spark, sentiment_model(spark, sf)))
    failed = F.col("label") == "ERROR"
    return s.select("doc_id", (~failed).alias("scored"), (failed == (F.col("score") == 0)).alias("errors_score_zero"))
