"""Exact token length histogram and what it answers for every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferry.llm.words import quoted, whole
from ferry.sources.scratch import materialize

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's publisher cuts text before merging bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Text a worker encodes at a time.
PIECE_CHARS = 4_000_000
# Distinct lengths whose sums one window task holds.
BLOCK = 4096

_encoders: dict[int, object] = {}


def file_bytes(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file, read through Spark so that any store will do."""
    rows = spark.read.format("binaryFile").load(path).select("content").take(1)
    if not rows:
        raise FileNotFoundError(path)
    return bytes(rows[0][0])


def _encoder(vocabulary):
    """One encoder per worker; the vocabulary is broadcast once."""
    if vocabulary.id not in _encoders:
        import tiktoken

        pairs = (line.split() for line in vocabulary.value.splitlines() if line)
        ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        _encoders[vocabulary.id] = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encoders[vocabulary.id]


class _Vocabulary:
    """A broadcast with a name that stays the same in every worker."""

    def __init__(self, spark: SparkSession, path: str):
        self.sent = spark.sparkContext.broadcast(file_bytes(spark, path))
        self.id = (path, hash(self.sent.value))

    @property
    def value(self) -> bytes:
        return self.sent.value


def token_lengths(docs: DataFrame, path: str = VOCABULARY, text_column: str = "text") -> DataFrame:
    """n_tokens of each document; null text has none."""
    vocabulary = _Vocabulary(docs.sparkSession, path)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            counts, piece, chars = [], [], 0
            for text in batch["text"]:
                piece.append(text)
                chars += len(text)
                if chars > PIECE_CHARS:
                    counts += map(len, encoder.encode_ordinary_batch(piece, num_threads=1))
                    piece, chars = [], 0
            counts += map(len, encoder.encode_ordinary_batch(piece, num_threads=1))
            yield pd.DataFrame({"n_tokens": counts})

    return docs.select(whole(quoted(text_column)).alias("text")).mapInPandas(count, "n_tokens long")


def histogram(docs: DataFrame, path: str = VOCABULARY, text_column: str = "text") -> DataFrame:
    """n_tokens and docs: how many documents have each length that occurs."""
    return (
        token_lengths(docs, path, text_column)
        .groupBy("n_tokens")
        .agg(F.count("*").alias("docs"))
    )


def limits(lengths: DataFrame) -> DataFrame:
    """For each length that occurs, taken as a context limit, sums over all documents.

    docs_over and tokens_over: documents longer than the limit and their tokens;
    total: tokens of all; truncated_total: tokens left if each document is cut at
    the limit; quantile: part of the documents not longer than the limit.
    Between two lengths that occur docs_over stays, so a limit x between lengths
    a and b has truncated_total(a) + (x - a) * docs_over(a).

    ``lengths`` is a histogram. Sums run over blocks of lengths first, so no task
    holds more than a block of lengths or one number per block. An empty table
    gives an empty result; empty and null texts have length 0.
    """
    lengths = materialize(
        lengths.select(
            "n_tokens",
            "docs",
            (F.col("n_tokens") * F.col("docs")).alias("tokens"),
            F.floor(F.col("n_tokens") / BLOCK).alias("block"),
        ),
        "lengths",
    )
    blocks = lengths.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_later"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_later"),
        F.sum("d").over(every).alias("all_docs"),
        F.sum("t").over(every).alias("total"),
    )
    over = (
        Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = lengths.join(blocks, "block").select(
        "n_tokens",
        "docs",
        (F.coalesce(F.sum("docs").over(over), F.lit(0)) + F.col("d_later")).alias("docs_over"),
        (F.coalesce(F.sum("tokens").over(over), F.lit(0)) + F.col("t_later")).alias("tokens_over"),
        "total",
        "all_docs",
    )
    return sums.select(
        "n_tokens",
        "docs",
        "docs_over",
        "tokens_over",
        "total",
        (F.col("total") - F.col("tokens_over") + F.col("n_tokens") * F.col("docs_over")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("quantile"),
    )
