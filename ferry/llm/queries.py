"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm import (
    decontaminate,
    exact_dedup,
    fill_middle,
    filter_audit,
    fingerprints,
    jaccard_join,
    licenses,
    line_dedup,
    pieces,
    sharding,
    surrogates,
    token_counts,
    toxicity,
)
from ferry.llm.words import table

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 40
# For the query only; a user's key comes from where secrets are kept.
SURROGATE_KEY = b"op5"


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), SHARDS)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.overlaps(docs, benchmark, {"doc_id": F.col("doc_id")})


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace(docs, SURROGATE_KEY)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return toxicity.score_documents(docs, labels)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return encoded.select("doc_id", "n_tokens", "ids", "round_trip")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.remove_boilerplate(docs).drop("source")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.limits(token_counts.histogram(table(spark, sf_dir, "documents")))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(*(table(spark, sf_dir, t) for t in ("documents", "labels")))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_jaccard_join,
            op2_license_scan,
            op3_sharding,
            op4_decontamination,
            op5_surrogates,
            op6_toxicity,
            op7_exact_dedup,
            op8_sentencepiece,
            op9_line_dedup,
            op10_token_counts,
            op11_fingerprints,
            op12_filter_audit,
            op13_fill_middle,
        )
    }
