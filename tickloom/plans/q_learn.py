"""H1-H8 (learning sets) and I1-I12 (models and metrics)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import rnd as R
from ..operators import attribution as at
from ..operators import backtest as bt
from ..operators import boosting as bo
from ..operators import features as fe
from ..operators import learnset as ls
from ..operators import models as md
from ..operators import oversample as ov
from ..operators import runs as ru
from ..operators import sequence_model as sq
from ..session import materialize, scratch_path
from ..sources import fixtures as fx
from .oracle import dbl, with_views
from .q_backtest import metrics_ctes, ob_ctes
from .q_explore import master
from .q_features import SCORE_CTES, TRAIN_CTES, score_table, train_table
from .registry import register

SCALE_COLS = ["close", "RSI", "VIX", "volume", "daily_return"]
SEQ_COLS = fe.SCORING_FEATURES
SHOWN = ["close", "RSI", "VIX", "vix_rsi_interaction"]      # sequence features whose every step is compared


def split_table(spark, sf):
    """Models learn from the engineered features (E9): incomplete rows are
    dropped, nothing is filled with later values."""
    return ls.chrono_split(train_table(spark, sf))


SPLIT_CTE = ("sp", f"""
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY date)
                        <= floor(count(*) OVER (PARTITION BY symbol) * {dbl(0.8)}) THEN 'train' ELSE 'test' END AS split
    FROM feat""")


def learn_sql(body, extra=None):
    return with_views(["bars", "vix", "company_news", "organisations"], body, TRAIN_CTES + [SPLIT_CTE] + (extra or []))


@register("h1_chronological_split", learn_sql("SELECT symbol, date, split FROM sp"))
def q_h1(spark, sf):
    return split_table(spark, sf).select("symbol", "date", "split")


def _scaled_sql(fit_filter):
    stats = ", ".join(f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}"
                      for c in SCALE_COLS)
    cols = ", ".join(f"round((s.{c} - t.mu_{c}) / t.sd_{c}, 6) AS {c}" for c in SCALE_COLS)
    return (f"SELECT s.symbol, s.date, s.split, {cols} FROM sp s "
            f"LEFT JOIN (SELECT symbol, {stats} FROM sp {fit_filter} GROUP BY symbol) t USING (symbol)")


@register("h2_standardise_train_stats", learn_sql(_scaled_sql("WHERE split = 'train'")))
def q_h2(spark, sf):
    s = ls.standardise(split_table(spark, sf), SCALE_COLS)
    return s.select("symbol", "date", "split", *[R(c, 6).alias(c) for c in SCALE_COLS])


@register("h2_standardise_refit", learn_sql(_scaled_sql("")))
def q_h2b(spark, sf):
    s = ls.standardise(split_table(spark, sf), SCALE_COLS, fit_on=None)
    return s.select("symbol", "date", "split", *[R(c, 6).alias(c) for c in SCALE_COLS])


@register("h3_class_weights", learn_sql("""
    SELECT s.symbol, s.date, s.target_direction, round(w.weight, 8) AS weight FROM sp s LEFT JOIN (
      SELECT c.symbol, c.target_direction, t.n / (2.0 * c.nc) AS weight
      FROM (SELECT symbol, target_direction, count(*) AS nc FROM sp WHERE split = 'train' GROUP BY 1, 2) c
      JOIN (SELECT symbol, count(*) AS n FROM sp WHERE split = 'train' GROUP BY 1) t USING (symbol)) w
    ON s.symbol = w.symbol AND s.target_direction = w.target_direction"""))
def q_h3(spark, sf):
    w = ls.class_weights(split_table(spark, sf))
    return w.select("symbol", "date", "target_direction", R("weight", 8).alias("weight"))


W5 = "PARTITION BY symbol, split ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING"
SEQ5 = ("seq5", f"""
    SELECT * FROM (SELECT symbol, split, date, target_direction AS label, CAST(count(*) OVER ({W5}) AS INTEGER) AS seq_len
                   FROM sp) WHERE seq_len = 5""")


def seq5(spark, sf):
    """Training sequences over all features, standardised with the train statistics.
    The feature table is stored once; the statistics, the check of the splits and the sequences read that."""
    whole = materialize(spark, split_table(spark, sf).select("symbol", "date", "split", "target_direction", *SEQ_COLS))
    return ls.train_sequences(ls.standardise(whole, SEQ_COLS), SEQ_COLS, 5)


def steps(seqs, keys):
    """Every step of every sequence in order, with the SHOWN features."""
    e = seqs.select(*keys, F.posexplode("seq").alias("step", "x"))
    return e.select(*keys, F.col("step").cast("int").alias("step"), F.col("x.date").alias("step_date"),
                    *[R(F.col("x.x")[SEQ_COLS.index(c)], 6).alias(c) for c in SHOWN])


def _standard_sql(cols, source, fit_filter):
    stats = ", ".join(f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}" for c in cols)
    values = ", ".join(f"(s.{c} - t.mu_{c}) / t.sd_{c} AS {c}" for c in cols)
    return (f"SELECT s.* EXCLUDE ({', '.join(cols)}), {values} FROM {source} s "
            f"LEFT JOIN (SELECT symbol, {stats} FROM {source} {fit_filter} GROUP BY symbol) t USING (symbol)")


STD_CTE = ("std", _standard_sql(SHOWN, "sp", "WHERE split = 'train'"))
_SHOWN_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in SHOWN)


@register("h5_train_sequences", learn_sql(f"""
    SELECT a.symbol, a.split, a.date, a.label, CAST(b.rn - (a.rn - 5) AS INTEGER) AS step, b.date AS step_date, {_SHOWN_SQL}
    FROM (SELECT symbol, split, date, target_direction AS label, row_number() OVER (PARTITION BY symbol, split ORDER BY date) AS rn FROM std) a
    JOIN (SELECT *, row_number() OVER (PARTITION BY symbol, split ORDER BY date) AS rn FROM std) b
      ON a.symbol = b.symbol AND a.split = b.split AND b.rn BETWEEN a.rn - 5 AND a.rn - 1 WHERE a.rn > 5""", [STD_CTE]))
def q_h5(spark, sf):
    return steps(seq5(spark, sf), ["symbol", "split", "date", "label"])


W10 = "PARTITION BY symbol ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW"
WRUN = "PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
SEQ10 = ("seq10", f"""
    SELECT symbol, date, count(*) OVER ({W10}) AS cnt, sum(close) OVER ({W10}) AS sc, sum(RSI) OVER ({W10}) AS sr,
           first_value(close) OVER ({WRUN}) AS c0, first_value(RSI) OVER ({WRUN}) AS r0 FROM scored""")


def seq10(spark, sf, scaled=False):
    t = score_table(spark, sf)
    if scaled:              # the scoring path refits the scaler on the rows it scores
        t = ls.standardise(t, SEQ_COLS, fit_on=None)
    return ls.score_sequences(t, SEQ_COLS, 10)


@register("h6_score_sequences", with_views(["bars", "vix", "posts"], f"""
    SELECT a.symbol, a.date, CAST(p.k AS INTEGER) AS step, b.date AS step_date, {_SHOWN_SQL}
    FROM (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM std) a
    CROSS JOIN range(10) p(k)
    JOIN (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM std) b
      ON a.symbol = b.symbol AND b.rn = greatest(1, a.rn - 9 + p.k)""", SCORE_CTES + [("std", _standard_sql(SHOWN, "scored", ""))]))
def q_h6(spark, sf):
    return steps(seq10(spark, sf, scaled=True), ["symbol", "date"])


@register("h7_validation_tail", learn_sql("""
    SELECT symbol, date, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY date)
                                   > count(*) OVER (PARTITION BY symbol) - floor(count(*) OVER (PARTITION BY symbol) * 0.2)
                              THEN 'val' ELSE 'fit' END AS part
    FROM seq5 WHERE split = 'train'""", [SEQ5]))
def q_h7(spark, sf):
    return ls.validation_tail(seq5(spark, sf)).select("symbol", "date", "part")


H8_COLS = ["close", "RSI", "VIX", "Return_1d"]


@register("h8_drop_unlabelled_tail", with_views(["bars", "vix", "posts"], f"""
    SELECT symbol, date FROM (
      SELECT symbol, date, lead(date) OVER (PARTITION BY symbol ORDER BY date) AS nxt FROM master
      WHERE {' AND '.join(f'{c} IS NOT NULL' for c in H8_COLS)}) WHERE nxt IS NOT NULL""",
        SCORE_CTES + [("master", "SELECT *, CASE WHEN close = 0 THEN NULL ELSE lead(close) OVER "
                                 "(PARTITION BY symbol ORDER BY date) / close - 1 END AS Return_1d FROM scored")]))
def q_h8(spark, sf):
    return ls.drop_unlabelled_tail(master(spark, sf), H8_COLS).select("symbol", "date")


# ----------------------------------------------------------------- models

FEATURES = fe.SCORING_FEATURES
TRADITIONAL = [c for c in FEATURES if c not in fe.SOCIAL_COLS]


FIT_ROWS = 100_000          # of a partition that a fit reads
_STORED: dict[tuple, str] = {}


def placed(spark, df):
    """``df`` stored in the shared checkpoint folder, as fitting makes many passes over it, in partitions of about
    FIT_ROWS rows: placed by a hash of the key and sorted (tree fitting samples by partition, so the model
    depends on this placement, not on how the rows were made)."""
    once = materialize(spark, df)
    n = max(8, -(-once.count() // FIT_ROWS))
    return materialize(spark, once.repartition(n, "symbol", "date").sortWithinPartitions("symbol", "date"))


def stored_once(spark, sf, name, make):
    """Path of a table or model: made and stored by the first query of the session that asks for it, read by the others."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        path = scratch_path(spark, "model")
        make(path)
        _STORED[key] = path
    return _STORED[key]


def split_rows(spark, sf):
    """The split table (H1), stored once a session: the company's news is read once for all that models learn from and score."""
    return spark.read.parquet(stored_once(spark, sf, "split", lambda path: split_table(spark, sf).write.parquet(path)))


def learn_frame(spark, sf):
    """Split + class weights (H1, H3)."""
    return placed(spark, ls.class_weights(split_rows(spark, sf)))


def stored_forest(spark, sf, name, pipeline):
    def make(path):
        train = learn_frame(spark, sf).where(F.col("split") == "train")
        pipeline.fit(train).write().overwrite().save(path)
    return stored_once(spark, sf, name, make)


def forest_path(spark, sf):
    return stored_forest(spark, sf, "forest", md.random_forest(FEATURES))


def forest(spark, sf):
    return md.load(forest_path(spark, sf))


def beats_constant(p):
    """Whether the mean log loss of the scored rows is below that of the best constant score: no wrong fit does that."""
    up = F.col("target_direction") == 1
    inside = F.least(F.greatest("p_up", F.lit(1e-12)), F.lit(1 - 1e-12))
    share = F.avg(up.cast("int"))
    constant = -(share * F.log(share) + (1 - share) * F.log(1 - share))
    return p.select(F.avg(-F.when(up, F.log(inside)).otherwise(F.log(1 - inside))) < constant).scalar()


def checked(p):
    """What any right fit must show: a key and label, a probability, the class that the probability says, and
    scores of unseen rows that are better than any constant."""
    ok = F.col("p_up").between(0, 1)
    agrees = F.col("predicted_signal") == (F.col("p_up") > 0.5).cast("int")
    return p.select("symbol", "date", "target_direction", ok.alias("is_probability"), agrees.alias("class_agrees"),
                    beats_constant(p).alias("beats_constant"))


def test_rows(spark, sf):
    return split_rows(spark, sf).where(F.col("split") == "test")


CHECKED_SQL = learn_sql("""SELECT symbol, date, target_direction, true AS is_probability, true AS class_agrees, true AS beats_constant
    FROM sp WHERE split = 'test'""")


@register("i1_random_forest", CHECKED_SQL)
def q_i1(spark, sf):
    return checked(md.predict(forest(spark, sf), test_rows(spark, sf)))


@register("i1_random_forest_exploratory", CHECKED_SQL)
def q_i1b(spark, sf):
    """The exploratory forest: 200 trees, depth 10, at least 2 rows per leaf."""
    path = stored_forest(spark, sf, "exploratory", md.random_forest(FEATURES, num_trees=200, max_depth=10, min_leaf=2))
    return checked(md.predict(md.load(path), test_rows(spark, sf)))


def scaled_frame(spark, sf):
    """H2 of the split table, stored once a session: features by the train statistics."""
    def make(path):
        whole = split_rows(spark, sf).select("symbol", "date", "split", "target_direction", *FEATURES)
        ls.standardise(whole, FEATURES).write.parquet(path)
    return spark.read.parquet(stored_once(spark, sf, "scaled", make))


def scaled_test_rows(spark, sf):
    return scaled_frame(spark, sf).where(F.col("split") == "test")


def balanced(spark, sf, cols):
    """The train rows and the synthetic ones that make the classes of each symbol equal (H4)."""
    train = scaled_frame(spark, sf).where(F.col("split") == "train")
    synthetic = ov.oversample(spark, train, cols)
    return train.select("symbol", "target_direction", *cols).unionByName(synthetic.select("symbol", "target_direction", *cols))


# The train rows standardised, the drawn rows, their neighbours and the rows between.
_FEATURE_LIST = ", ".join(f"CAST({c} AS DOUBLE)" for c in FEATURES)
_MD5 = "CAST('0x' || substr(md5({}), 1, 13) AS BIGINT)"
_DRAWN = "'42:' || symbol || ':' || target_direction || ':' || strftime(date, '%Y-%m-%d')"
H4_CTES = [
    ("scaled", _standard_sql(FEATURES, "sp", "WHERE split = 'train'")),
    ("tr", f"SELECT symbol, date, target_direction, [{_FEATURE_LIST}] AS x FROM scaled WHERE split = 'train'"),
    ("lacking", """SELECT symbol, target_direction, n, max(n) OVER (PARTITION BY symbol) - n AS lack
                   FROM (SELECT symbol, target_direction, count(*) AS n FROM tr GROUP BY 1, 2)"""),
    ("base", f"""SELECT tr.*, n, CAST(floor(lack / n) AS BIGINT) + CASE WHEN row_number() OVER (
                        PARTITION BY symbol, target_direction ORDER BY {_MD5.format(_DRAWN)}, date) <= lack % n THEN 1 ELSE 0 END AS drawn
                 FROM tr JOIN lacking USING (symbol, target_direction) WHERE lack > 0"""),
    ("near", """SELECT b.symbol, b.target_direction, b.date, c.date AS neighbour_date, c.x AS y, row_number() OVER (
                       PARTITION BY b.symbol, b.target_direction, b.date
                       ORDER BY round(list_sum(list_transform(list_zip(b.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 1e9) / 1e9, c.date) AS place
                FROM base b JOIN tr c ON b.symbol = c.symbol AND b.target_direction = c.target_direction AND b.date <> c.date WHERE b.drawn > 0"""),
    ("copied", f"""SELECT *, {_MD5.format(_DRAWN + " || ':' || copy || ':n'")} % least(5, n - 1) + 1 AS place,
                          ({_MD5.format(_DRAWN + " || ':' || copy || ':u'")} + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
                   FROM (SELECT *, unnest(range(1, drawn + 1)) AS copy FROM base)"""),
    ("synthetic", """SELECT c.symbol, c.target_direction, c.date, CAST(c.copy AS INTEGER) AS copy, k.neighbour_date, c.u,
                            list_transform(list_zip(c.x, k.y), lambda z: z[1] + c.u * (z[2] - z[1])) AS x
                     FROM copied c JOIN near k USING (symbol, target_direction, date, place)"""),
    ("balanced", "SELECT target_direction, x FROM tr UNION ALL SELECT target_direction, x FROM synthetic"),
]


@register("h4_oversampling", learn_sql(
    "SELECT symbol, target_direction, date, copy, neighbour_date, round(u, 9) AS u, "
    + ", ".join(f"round(x[{FEATURES.index(c) + 1}], 6) AS {c}" for c in SHOWN) + " FROM synthetic", H4_CTES))
def q_h4(spark, sf):
    """The synthetic rows of the smaller class of each symbol: which row, which neighbour, how far, and some features."""
    s = ov.oversample(spark, scaled_frame(spark, sf).where(F.col("split") == "train"), FEATURES)
    return s.select("symbol", "target_direction", "date", "copy", F.col("neighbour_day").alias("neighbour_date"), R("u", 9).alias("u"),
                    *[R(c, 6).alias(c) for c in SHOWN])


@register("h4_class_balance", learn_sql("""
    SELECT symbol, target_direction, count(*) AS rows FROM (
      SELECT symbol, target_direction FROM tr UNION ALL SELECT symbol, target_direction FROM synthetic) GROUP BY 1, 2""", H4_CTES))
def q_h4b(spark, sf):
    return balanced(spark, sf, FEATURES).groupBy("symbol", "target_direction").agg(F.count(F.lit(1)).alias("rows"))


def boosted(spark, sf, name, cols):
    """200 rounds on the balanced rows, stored as a table of nodes."""
    return spark.read.parquet(stored_booster(spark, sf, name, cols))


def stored_booster(spark, sf, name, cols):
    return stored_once(spark, sf, name, lambda path: bo.store(bo.fit(spark, balanced(spark, sf, cols), cols), path))


@register("i2_boosted_trees", CHECKED_SQL)
def q_i2(spark, sf):
    return checked(bo.predict(boosted(spark, sf, "boosted", FEATURES), scaled_test_rows(spark, sf), FEATURES))


# One round of depth 2 in SQL: bins at the quantiles, histograms of gradients, the split with the most gain.
BINS = 16
_NAMES = ", ".join(f"'{c}'" for c in FEATURES)
I2_CTES = H4_CTES + [
    ("cell", """SELECT r, CASE WHEN target_direction = 1 THEN -0.5::DOUBLE ELSE 0.5::DOUBLE END AS g, unnest(x) AS v, unnest(range(len(x))) AS f
                FROM (SELECT *, row_number() OVER () AS r FROM balanced)"""),
    ("edge", f"""SELECT DISTINCT f, v FROM (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS rn, count(*) OVER (PARTITION BY f) AS n FROM cell)
                 JOIN range(1, {BINS}) q(q) ON rn = ceil(q / {BINS}.0::DOUBLE * n)"""),
    ("bin", "SELECT r, g, f, v, (SELECT count(*) FROM edge e WHERE e.f = c.f AND e.v < c.v) AS b FROM cell c"),
]


def _level_sql(level: int) -> list[tuple[str, str]]:
    """The nodes of a level (rows by node) and each one's best split."""
    rows = ("SELECT DISTINCT r, g, 1 AS node FROM bin" if level == 0 else
            f"SELECT n.r, n.g, 2 * n.node + CASE WHEN c.b > s.b THEN 1 ELSE 0 END AS node FROM node{level - 1} n JOIN split{level - 1} s USING (node) "
            "JOIN bin c ON c.r = n.r AND c.f = s.f")
    return [
        (f"node{level}", rows),
        (f"hist{level}", f"""SELECT node, f, b, sum(sum(g)) OVER w AS gl, sum(sum(h)) OVER w AS hl
            FROM (SELECT n.node, c.f, c.b, n.g, 0.25::DOUBLE AS h FROM node{level} n JOIN bin c USING (r)) GROUP BY node, f, b
            WINDOW w AS (PARTITION BY node, f ORDER BY b ROWS UNBOUNDED PRECEDING)"""),
        (f"whole{level}", f"SELECT node, sum(g) AS g, sum(0.25::DOUBLE) AS h FROM node{level} GROUP BY node"),
        (f"split{level}", f"""SELECT node, f, b FROM (SELECT node, f, b, row_number() OVER (PARTITION BY node ORDER BY
              gl ** 2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g ** 2 / (h + 1) DESC, f, b) AS place
            FROM hist{level} JOIN whole{level} USING (node) WHERE hl >= 1 AND h - hl >= 1) WHERE place = 1"""),
    ]


_TREE_CTES = I2_CTES + _level_sql(0) + _level_sql(1) + _level_sql(2)[:1] + _level_sql(2)[2:3]
_THRESHOLD = "(SELECT list(e.v ORDER BY e.v) FROM edge e WHERE e.f = s.f)[s.b + 1]"


@register("i2_first_tree", learn_sql(f"""
    SELECT CAST(node AS INTEGER) AS node, f AS feature, round(threshold, 6) AS threshold, round(-0.01::DOUBLE * g / (h + 1), 9) AS value FROM (
      SELECT node, ([{_NAMES}])[s.f + 1] AS f, {_THRESHOLD} AS threshold, g, h FROM whole0 JOIN split0 s USING (node)
      UNION ALL SELECT node, ([{_NAMES}])[s.f + 1], {_THRESHOLD}, g, h FROM whole1 JOIN split1 s USING (node)
      UNION ALL SELECT node, NULL, NULL, g, h FROM whole2)""", _TREE_CTES))
def q_i2b(spark, sf):
    """The first tree of a booster on the balanced rows, down to depth 2: SQL fits the same tree."""
    m = bo.fit(spark, balanced(spark, sf, FEATURES), FEATURES, rounds=1, depth=2, bins=BINS)
    return m.select("node", "feature", R("threshold", 6).alias("threshold"), R("value", 9).alias("value"))


@register("i3_sentiment_variants", learn_sql("""
    SELECT family, variant, count(*) AS rows, true AS in_range, true AS beats_majority FROM sp
    CROSS JOIN (VALUES ('forest'), ('boosted')) f(family) CROSS JOIN (VALUES ('with_sentiment'), ('traditional')) v(variant)
    WHERE split = 'test' GROUP BY 1, 2"""))
def q_i3(spark, sf):
    """Both families with and without the sentiment columns, scored on the test rows."""
    out, plain, scaled = None, test_rows(spark, sf), scaled_test_rows(spark, sf)
    for variant, cols in (("with_sentiment", FEATURES), ("traditional", TRADITIONAL)):
        f = forest(spark, sf) if cols is FEATURES else md.load(stored_forest(spark, sf, "forest traditional", md.random_forest(cols)))
        b = boosted(spark, sf, "boosted" if cols is FEATURES else "boosted traditional", cols)
        for family, p in (("forest", md.predict(f, plain)), ("boosted", bo.predict(b, scaled, cols))):
            p = p.select("target_direction", "predicted_signal", F.lit(family).alias("family"), F.lit(variant).alias("variant"))
            m = md.classification_metrics(p, keys=("family", "variant"), label="target_direction")
            up = F.avg("target_direction")
            n = p.groupBy("family", "variant").agg(F.count(F.lit(1)).alias("rows"), F.greatest(up, 1 - up).alias("majority"))
            m = m.join(n, ["family", "variant"])
            out = m if out is None else out.unionByName(m)
    fine = F.col("accuracy").between(0, 1) & F.col("precision").between(0, 1) & F.col("f1").between(0, 1)
    return out.select("family", "variant", "rows", fine.alias("in_range"), (F.col("accuracy") > F.col("majority")).alias("beats_majority"))


@register("i10_tree_attributions", learn_sql("""
    SELECT family, symbol, date, 30 AS features, true AS adds_up FROM sp CROSS JOIN (VALUES ('forest'), ('boosted')) f(family) WHERE split = 'test'"""))
def q_attributions(spark, sf):
    """What each feature adds to each test row's score, by the stored trees themselves; with the base value that makes
    the score which the model gives, an independent walk of the trees."""
    f_nodes = at.forest_nodes(spark, forest_path(spark, sf), FEATURES)
    b_model = boosted(spark, sf, "boosted", FEATURES)
    f_rows = md.predict(forest(spark, sf), test_rows(spark, sf)).withColumn("score", F.col("p_up"))
    b_rows = bo.predict(b_model, scaled_test_rows(spark, sf), FEATURES).withColumn("score", F.log(F.col("p_up") / (1 - F.col("p_up"))))
    out = None
    for family, nodes, rows in (("forest", f_nodes, f_rows), ("boosted", at.booster_nodes(b_model), b_rows)):
        a = at.attributions(nodes, rows.select("symbol", "date", "score", *FEATURES), FEATURES)
        total = F.aggregate("attributions", F.col("base_value"), lambda x, y: x + y)
        a = a.select(F.lit(family).alias("family"), "symbol", "date", F.size("attributions").alias("features"),
                     (F.abs(total - F.col("score")) < 1e-8).alias("adds_up"))
        out = a if out is None else out.unionByName(a)
    return out


# --------------------------------------------------------------- sequence classifier

HIDDEN, EPOCHS = (32, 16), 8          # smaller than the operator's own sizes, so that the bench can fit it


def sequence_net(spark, sf):
    """(net, whether training lowered the loss), stored by the first query that asks for it."""
    def make(path):
        net, history = sq.fit(spark, ls.validation_tail(seq5(spark, sf)), len(SEQ_COLS), hidden=HIDDEN, epochs=EPOCHS, batch=512, rate=0.005)
        sq.store(spark, net, f"{path}/net")
        spark.createDataFrame(history, "epoch int, fit_loss double, val_loss double, rate double").write.parquet(f"{path}/history")
    path = stored_once(spark, sf, "sequence", make)
    h = spark.read.parquet(f"{path}/history").agg(F.min_by("fit_loss", "epoch").alias("first"), F.min("fit_loss").alias("least")).first()
    return sq.load(spark, f"{path}/net"), h.least < h.first


@register("i4_sequence_classifier", with_views(["bars", "vix", "posts"], """
    SELECT symbol, date, true AS is_probability, true AS class_agrees, true AS learnt FROM scored""", SCORE_CTES))
def q_sequences(spark, sf):
    """The sequence classifier fitted on H5 with the H7 tail, scoring the padded sequences of H6."""
    net, learnt = sequence_net(spark, sf)
    p = sq.predict(net, seq10(spark, sf, scaled=True).select("symbol", "date", "seq"))
    agrees = F.col("predicted_signal") == (F.col("p_up") > 0.5).cast("int")
    return p.select("symbol", "date", F.col("p_up").between(0, 1).alias("is_probability"), agrees.alias("class_agrees"), F.lit(learnt).alias("learnt"))


@register("i12_sequence_attributions", learn_sql(f"""
    SELECT symbol, date, {len(SEQ_COLS)} AS features, true AS adds_up FROM seq5 WHERE split = 'test'""", [SEQ5]))
def q_i12b(spark, sf):
    """I12 on the classifier's attributions: one value for each feature, the mean over the steps; times the steps they
    add up to what the row's log odds differ from the background's."""
    net, _ = sequence_net(spark, sf)
    seqs = materialize(spark, seq5(spark, sf))
    base = sq.background(seqs.where(F.col("split") == "train"), ["symbol", "date"], len(SEQ_COLS), 4)
    a = sq.attributions(net, seqs.where(F.col("split") == "test"), base)
    a = a.withColumn("mean", md.collapse_steps("attributions", len(SEQ_COLS)))
    total = F.aggregate("mean", F.lit(0.0), lambda x, y: x + y) * F.size("attributions")
    near = F.abs(total - (F.col("log_odds") - F.col("base_value"))) < 0.02 + 0.02 * F.abs(F.col("log_odds") - F.col("base_value"))
    return a.select("symbol", "date", F.size("mean").alias("features"), near.alias("adds_up"))


def signals(spark, sf):
    """I4: signals of the stored forest for every row given (the scoring table)."""
    p = md.predict(forest(spark, sf), score_table(spark, sf))
    return p.select(F.lit("forest").alias("model"), "symbol", "date", F.col("close").alias("price_close"), "predicted_signal",
                    F.col("p_up").alias("confidence"), F.col("target_direction").alias("label"))


@register("i4_batch_prediction", with_views(["bars", "vix", "posts"], """
    SELECT symbol, date, close AS price_close, true AS is_probability, true AS class_agrees FROM scored""", SCORE_CTES))
def q_i4(spark, sf):
    s = signals(spark, sf)
    agrees = F.col("predicted_signal") == (F.col("confidence") > 0.5).cast("int")
    return s.select("symbol", "date", "price_close", F.col("confidence").between(0, 1).alias("is_probability"), agrees.alias("class_agrees"))


# A model that SQL can fit as well: the share of rises on the train rows of each
# weekday, RSI third and kind of move.
CELL = ["day_of_week", "rsi_third", "rising"]
CELL_SQL = """day_of_week, CASE WHEN RSI < 40 THEN 0 WHEN RSI < 60 THEN 1 ELSE 2 END AS rsi_third,
              CASE WHEN daily_return > 0 THEN 1 ELSE 0 END AS rising"""


def cells(df):
    third = F.when(F.col("RSI") < 40, 0).when(F.col("RSI") < 60, 1).otherwise(2)
    return df.withColumns({"rsi_third": third, "rising": F.when(F.col("daily_return") > 0, 1).otherwise(0)})


J22_CTES = [
    ("cell", f"SELECT symbol, date, SMA_50 AS px, target_direction, split, {CELL_SQL} FROM sp"),
    ("fitted", "SELECT day_of_week, rsi_third, rising, avg(target_direction) AS p FROM cell WHERE split = 'train' GROUP BY 1, 2, 3"),
    ("preds", """SELECT 'cells' AS model, symbol, date, px AS price_close, coalesce(p, 0.5) AS confidence,
                        CAST(coalesce(p, 0.5) > 0.5 AS INTEGER) AS predicted_signal, target_direction AS label
                 FROM cell LEFT JOIN fitted USING (day_of_week, rsi_third, rising) WHERE split = 'test'"""),
]
J22_COLS = ["strategy_return", "bh_return", "sharpe", "max_dd", "num_trades", "win_rate"]


@register("j22_model_to_backtest", learn_sql(
    "SELECT model, symbol, " + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in J22_COLS) + " FROM met",
    J22_CTES + ob_ctes(100_000.0, False) + metrics_ctes(100_000.0)))
def q_j22(spark, sf):
    """The whole chain: fit on the train rows, store the model, load it, predict
    the test rows, store the signals, build the order book and compare.  Trades
    at the 50-day mean, so that running products stay bounded."""
    sp = cells(split_table(spark, sf))
    model_path, signals_path = scratch_path(spark, "cell_model"), scratch_path(spark, "cell_signals")
    sp.where(F.col("split") == "train").groupBy(*CELL).agg(F.avg("target_direction").alias("p")).write.parquet(model_path)
    p = sp.where(F.col("split") == "test").join(spark.read.parquet(model_path), CELL, "left")
    conf = F.coalesce("p", F.lit(0.5))
    p.select(F.lit("cells").alias("model"), "symbol", "date", F.col("SMA_50").alias("price_close"), conf.alias("confidence"),
             (conf > 0.5).cast("int").alias("predicted_signal"), F.col("target_direction").alias("label")).write.parquet(signals_path)
    back = spark.read.parquet(signals_path)
    m = bt.backtest_metrics(bt.order_book(back, 100_000.0, first_row_position=False), 100_000.0)
    return m.select("model", "symbol", *[R(F.col(c).cast("double"), 6).alias(c) for c in J22_COLS])


@register("j22_forest_to_backtest", with_views(["bars", "vix", "posts"], """
    SELECT 'forest' AS model, symbol, count(*) AS days, true AS fine FROM scored GROUP BY symbol""", SCORE_CTES))
def q_j22b(spark, sf):
    """The same chain with the stored forest over the scoring table; what any
    fit must show: every day is booked and the ratios are in their ranges."""
    path = scratch_path(spark, "forest_signals")
    signals(spark, sf).write.parquet(path)
    m = bt.backtest_metrics(bt.order_book(spark.read.parquet(path), 100_000.0, first_row_position=False), 100_000.0)
    fine = (F.col("max_dd") <= 0) & (F.col("strategy_return") >= -100) & F.col("win_rate").between(0, 100)
    return m.select("model", "symbol", "days", fine.alias("fine"))


METRICS_SQL = """
    SELECT model, count(*) FILTER (WHERE label = predicted_signal) / count(*) AS accuracy,
           CASE WHEN count(*) FILTER (WHERE predicted_signal = 1) = 0 THEN 0.0
                ELSE count(*) FILTER (WHERE label = 1 AND predicted_signal = 1) / count(*) FILTER (WHERE predicted_signal = 1) END
             AS precision,
           CASE WHEN 2 * count(*) FILTER (WHERE label = 1 AND predicted_signal = 1) + count(*) FILTER (WHERE label <> predicted_signal) = 0
                THEN 0.0 ELSE 2 * count(*) FILTER (WHERE label = 1 AND predicted_signal = 1)
                     / (2 * count(*) FILTER (WHERE label = 1 AND predicted_signal = 1)
                        + count(*) FILTER (WHERE label <> predicted_signal)) END AS f1
    FROM preds GROUP BY model"""


def metrics(spark, sf):
    return md.classification_metrics(fx.preds(spark, sf))


@register("i5_classification_metrics", with_views(["preds"], """
    SELECT model, round(accuracy, 8) AS accuracy, round(precision, 8) AS precision, round(f1, 8) AS f1 FROM m""",
        [("m", METRICS_SQL)]))
def q_i5(spark, sf):
    m = metrics(spark, sf)
    return m.select("model", R("accuracy", 8).alias("accuracy"), R("precision", 8).alias("precision"),
                    R("f1", 8).alias("f1"))


@register("i6_confusion_matrix", with_views(["preds"], """
    SELECT model, label AS true_label, predicted_signal AS predicted, count(*) AS n FROM preds GROUP BY 1, 2, 3"""))
def q_i6(spark, sf):
    return md.confusion(fx.preds(spark, sf))


@register("i7_model_comparison", with_views(["preds"], """
    SELECT model, round(accuracy, 8) AS accuracy, round(f1, 8) AS f1 FROM m""", [("m", METRICS_SQL)]))
def q_i7(spark, sf):
    return metrics(spark, sf).select("model", R("accuracy", 8).alias("accuracy"), R("f1", 8).alias("f1"))


@register("i8_best_model", with_views(["preds"], """
    SELECT model AS best_model, round(accuracy, 8) AS accuracy, round(f1, 8) AS f1 FROM m
    ORDER BY accuracy DESC, f1 DESC LIMIT 1""", [("m", METRICS_SQL)]))
def q_i8(spark, sf):
    b = md.best_model(metrics(spark, sf))
    return b.select("best_model", R("accuracy", 8).alias("accuracy"), R("f1", 8).alias("f1"))


PRIORITY = ["m3", "m1", "m2"]


@register("i9_champion_selection", with_views(["preds"], """
    SELECT coalesce((SELECT model FROM m WHERE accuracy >= 0.5 AND model IN ('m3', 'm1', 'm2')
                     ORDER BY CASE model WHEN 'm3' THEN 1 WHEN 'm1' THEN 2 ELSE 3 END LIMIT 1), 'm1') AS champion""",
        [("m", METRICS_SQL)]))
def q_i9(spark, sf):
    """The runs table (a metric row per run, with its champion mark) is stored by
    the training side and read here."""
    path = scratch_path(spark, "runs")
    marked = metrics(spark, sf).withColumn("is_champion", F.col("accuracy") >= 0.5)
    marked.select(F.concat(F.lit("run-"), "model").alias("run_id"), "model", "accuracy", "precision", "f1", "is_champion").write.parquet(path)
    return md.champion(spark.read.parquet(path), PRIORITY, "m1")


# ------------------------------------------------------ the registry over time

# A run of each model at the end of each year: measured on that year, and champion if it was right on half of it.
RUNS_CTES = [
    ("by_year", """SELECT model, CAST(year(date) AS INTEGER) AS y, avg(CAST(predicted_signal = label AS INTEGER)) AS accuracy
                   FROM preds GROUP BY 1, 2"""),
    ("moves", """SELECT model, y, make_date(y + 1, 1, 1) AS day, accuracy, CASE WHEN accuracy >= 0.5 THEN y - 1994 END AS version FROM by_year"""),
    ("asked", """SELECT DISTINCT date_trunc('month', date)::DATE AS day FROM preds"""),
    ("holds", """SELECT a.day, m.model, arg_max(struct_pack(v := m.version, acc := m.accuracy), m.day) AS h
                 FROM asked a JOIN moves m ON m.day <= a.day GROUP BY 1, 2"""),
    ("held", """SELECT day, first(model ORDER BY CASE model WHEN 'm3' THEN 1 WHEN 'm1' THEN 2 ELSE 3 END) AS champion,
                       first(h.v ORDER BY CASE model WHEN 'm3' THEN 1 WHEN 'm1' THEN 2 ELSE 3 END) AS version,
                       first(h.acc ORDER BY CASE model WHEN 'm3' THEN 1 WHEN 'm1' THEN 2 ELSE 3 END) AS accuracy
                FROM holds WHERE h.v IS NOT NULL GROUP BY day"""),
    ("champions", """SELECT a.day, coalesce(h.champion, 'm1') AS champion,
                            CAST(coalesce(h.version, (SELECT max(y) - 1994 FROM moves m WHERE m.model = 'm1' AND m.day <= a.day)) AS INTEGER) AS version,
                            coalesce(h.accuracy, 0.0) AS accuracy, h.champion IS NOT NULL AS by_alias
                     FROM asked a LEFT JOIN held h USING (day)"""),
]


def run_log(spark, sf):
    """The log of those runs, appended year by year's kind: runs, their accuracy, the alias."""
    right = F.avg((F.col("predicted_signal") == F.col("label")).cast("int"))
    y = fx.preds(spark, sf).groupBy("model", F.year("date").alias("y")).agg(right.alias("accuracy"))
    y = materialize(spark, y.select("model", F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)).cast("timestamp").alias("at"),
                                    (F.col("y") - 1994).alias("version"), "accuracy"))
    store = scratch_path(spark, "run_log")
    ru.record(y.select("at", F.lit(0).alias("seq"), F.lit("run").alias("event"), "model", "version", F.lit("signals").alias("kind")), store)
    ru.record(y.select("at", F.lit(1).alias("seq"), F.lit("metric").alias("event"), "model", "version", F.lit("accuracy").alias("name"),
                       F.col("accuracy").alias("value")), store)
    ru.record(y.select("at", F.lit(2).alias("seq"), F.lit("alias").alias("event"), "model", F.lit("champion").alias("name"),
                       F.when(F.col("accuracy") >= 0.5, F.col("version")).alias("version")), store)
    return ru.events(spark, store)


def monthly_champions(spark, sf):
    asked = fx.preds(spark, sf).select(F.trunc("date", "month").cast("timestamp").alias("at"))
    return ru.champion_as_of(run_log(spark, sf), asked, PRIORITY, "m1")


@register("i9_champion_as_of", with_views(["preds"], """
    SELECT day, champion, version, round(accuracy, 8) AS accuracy, by_alias FROM champions""", RUNS_CTES))
def q_i9b(spark, sf):
    """Who was champion at the start of each month, as the log tells it afterwards."""
    c = monthly_champions(spark, sf)
    return c.select(F.to_date("at").alias("day"), "champion", "version", R("accuracy", 8).alias("accuracy"), "by_alias")


@register("i9_score_as_of", with_views(["preds"], """
    SELECT p.symbol, p.date, c.champion, c.version, p.predicted_signal, round(p.confidence, 8) AS confidence
    FROM preds p JOIN champions c ON date_trunc('month', p.date)::DATE = c.day AND p.model = c.champion""", RUNS_CTES))
def q_i9c(spark, sf):
    """Every day scored with the model that was champion at the start of its month."""
    c = monthly_champions(spark, sf).select(F.to_date("at").alias("_month"), F.col("champion").alias("model"), "version")
    p = fx.preds(spark, sf).withColumn("_month", F.trunc("date", "month")).join(c, ["_month", "model"])
    return p.select("symbol", "date", F.col("model").alias("champion"), "version", "predicted_signal", R("confidence", 8).alias("confidence"))


@register("i9_dispatch_stored", learn_sql("""
    SELECT day, champion, symbol, date, true AS is_probability, true AS beats_constant FROM sp
    CROSS JOIN (VALUES (DATE '2001-01-15', 'trading'), (DATE '2001-02-15', 'boosted'), (DATE '2001-03-15', 'trading')) d(day, champion)
    WHERE split = 'test'"""))
def q_i9d(spark, sf):
    """The test rows scored with the stored model that the log names at three dates: a forest, then a booster, and
    the forest again as the fallback when the alias has been taken away."""
    store = scratch_path(spark, "run_log")
    forest_at, booster_at = forest_path(spark, sf), stored_booster(spark, sf, "boosted", FEATURES)
    rows = [("2001-01-01", "run", "trading", 1, None, "forest", forest_at), ("2001-01-01", "run", "boosted", 1, None, "boosted", booster_at),
            ("2001-01-10", "alias", "trading", 1, "champion", None, None), ("2001-02-10", "alias", "trading", None, "champion", None, None),
            ("2001-02-10", "alias", "boosted", 1, "champion", None, None), ("2001-03-10", "alias", "boosted", None, "champion", None, None)]
    made = spark.createDataFrame(rows, "at string, event string, model string, version int, name string, kind string, path string")
    ru.record(made.withColumn("at", F.to_timestamp("at")).withColumn("seq", F.lit(0)), store)
    log = ru.events(spark, store)
    asked = spark.createDataFrame([("2001-01-15",), ("2001-02-15",), ("2001-03-15",)], "at string").withColumn("at", F.to_timestamp("at"))
    scorers = {"forest": lambda path: md.predict(md.load(path), test_rows(spark, sf)),
               "boosted": lambda path: bo.predict(spark.read.parquet(path), scaled_test_rows(spark, sf), FEATURES)}
    out = None
    for c in sorted(ru.champion_as_of(log, asked, ["trading", "boosted"], "trading").collect(), key=lambda r: r["at"]):
        p = ru.score_with(log, c["champion"], c["version"], scorers)
        p = p.select(F.lit(c["at"].date()).alias("day"), F.lit(c["champion"]).alias("champion"), "symbol", "date",
                     F.col("p_up").between(0, 1).alias("is_probability"), beats_constant(p).alias("beats_constant"))
        out = p if out is None else out.unionByName(p)
    return out


@register("i10_feature_importance", "SELECT feature, true AS in_range, true AS adds_up FROM (VALUES "
          + ", ".join(f"('{c}')" for c in fe.SCORING_FEATURES) + ") t(feature)")
def q_i10(spark, sf):
    """Importances of the stored forest over its features; what any fit must show."""
    imp = md.feature_importance(spark, forest(spark, sf), FEATURES, len(FEATURES))
    total = imp.select(F.sum("importance")).scalar()
    return imp.select("feature", F.col("importance").between(0, 1).alias("in_range"), (F.abs(total - 1) < 1e-9).alias("adds_up"))


@register("i11_signal_log_summary", with_views(["preds"], """
    SELECT model, symbol, count(*) AS total, count(*) FILTER (WHERE predicted_signal = 1) AS buys,
           count(*) FILTER (WHERE predicted_signal <> 1) AS others, max(date) AS last_date,
           arg_max(predicted_signal, date) AS last_signal, round(arg_max(confidence, date), 8) AS last_confidence
    FROM preds GROUP BY 1, 2"""))
def q_i11(spark, sf):
    s = md.signal_summary(fx.preds(spark, sf))
    return s.select("model", "symbol", "total", "buys", "others", "last_date", "last_signal",
                    R("last_confidence", 8).alias("last_confidence"))


@register("i12_attribution_collapse", with_views(["bars", "vix", "posts"], """
    SELECT symbol, date, round((sc + (10 - cnt) * c0) / 10, 4) AS mean_close,
           round((sr + (10 - cnt) * r0) / 10, 6) AS mean_rsi FROM seq10""", SCORE_CTES + [SEQ10]))
def q_i12(spark, sf):
    s = seq10(spark, sf).withColumn("_m", md.collapse_steps("seq", len(SEQ_COLS)))
    close, rsi = F.col("_m")[SEQ_COLS.index("close")], F.col("_m")[SEQ_COLS.index("RSI")]
    return s.select("symbol", "date", R(close, 4).alias("mean_close"), R(rsi, 6).alias("mean_rsi"))
