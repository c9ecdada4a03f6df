"""From raw documents to a clean, encoded corpus, one stored table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferry.llm import decontaminate, exact_dedup, jaccard_join, pieces, toxicity
from ferry.llm.words import table
from ferry.sources.scratch import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, learnt from the labels of these documents."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without blanks."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of near-duplicates."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark text."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids."""
    return pieces.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

# Learnt scores and pieces of a vocabulary file are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each reads what the one before stored."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "corpus")
    return STAGES[-1][1](spark, docs, sf_dir)
