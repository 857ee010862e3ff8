"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination,
secrets, packing.

Each stage is a function (spark, docs, sf_dir) over all that the stage before
kept; ``run`` writes each result to the shared folder and reads it again as the
next stage's documents.  All stages but the last return the columns of
``documents``.

In every stage a null text counts as empty, whole texts are read, however long, an
empty table gives an empty result, and further columns, of any name, stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontaminate_cgk, packing, secret_structure, simhash_pivots, toxicity_weak
from tickloom.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go.  A row is judged by its text
    alone, so repeated rows stay or go together; null ids take no part in the fit;
    without labels of both classes every document stays."""
    return toxicity_weak.keep_clean(spark, docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id
    (of repeated rows with that id one; of groups without any id one for each
    fingerprint).  Texts without words are alike."""
    return simhash_pivots.keep_one(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.  A row is judged by its text, whatever
    its id, so repeated rows go or stay together; without items all stay."""
    return decontaminate_cgk.keep_clean(spark, docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, repeated rows and null ids too."""
    return secret_structure.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens packed into sequences: a row for each piece.  Empty texts
    are the end-of-text id alone; repeated rows and null ids are packed each."""
    return packing.pack(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]

# The stages learn, hash and tokenise; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
