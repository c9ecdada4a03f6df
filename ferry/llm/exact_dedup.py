"""Exact duplicates by content hash, checked byte by byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.words import attach, free_name, quoted, whole
from ferry.sources.scratch import materialize

# Fixed value: what is deleted before texts are compared.
BLANKS = " \t\n\x0b\x0c\r"
# Keys of groups with several rows that may be broadcast: 24 bytes each and
# the row overhead of a hash table, under 100 MB at this number.
BROADCAST_GROUPS = 1_000_000


def normal(text: Column | str) -> Column:
    return F.translate(whole(text), BLANKS, "")


def _clashes(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """hash and clash (true) of the groups of ``rows`` by hash whose texts differ.

    ``texts`` has t and hash; the smallest and the largest text of each group of
    several are compared.
    """
    several = (
        rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    )
    several = materialize(several, "copied")
    if several.count() <= BROADCAST_GROUPS:
        several = F.broadcast(several)
    clash = (
        texts.join(several, "hash", "left_semi")
        .groupBy("hash")
        .agg(F.min("t").alias("low"), F.max("t").alias("high"))
        .where("low <> high")
        .select("hash", F.lit(True).alias("clash"))
    )
    return materialize(clash, "clash")


def mark_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Rows are equal if their texts are byte for byte equal after blanks are
    deleted. Of equal rows that with the most code points stays, then the
    smallest id; a null id comes last. Null text is empty text, and empty texts
    are equal. Rows that repeat an id are rows of their own, but only one row of
    a group is kept: of equal best rows, the first by ``row`` (a number Spark
    gives each row of the staged table). An empty table gives an empty result.

    Rows are grouped by 128 bits of hash; only groups of several rows are read
    again, to compare the smallest and the largest text of each. A group whose
    texts differ is told apart by SHA-256. Tasks reduce a group to one row before
    it moves, and only groups of several rows are brought back to their rows: by a
    broadcast if they are measured small, else with groups that very many rows have
    spread over many tasks. So a group may hold any share of the table.
    """
    text = normal(quoted(text_column))
    rows = docs.select(
        quoted(id_column).alias("doc_id"),
        F.unhex(content_hash(text)).alias("hash"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
        F.char_length(whole(quoted(text_column))).alias("points"),
    )
    # Staged: read twice, and the row numbers must not change between the reads.
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "copies")
    rank = F.struct(
        (-F.col("points")).alias("a"), F.col("doc_id").isNull().alias("b"), "doc_id", "row"
    )
    texts = docs.select(text.alias("t")).select("t", F.unhex(content_hash(F.col("t"))).alias("hash"))
    clash = _clashes(rows, texts)
    rows = attach(rows, clash, "hash").withColumn("part", F.when(F.col("clash"), F.col("sha")).otherwise(F.lit(b"")))
    rows = rows.withColumn("key", F.concat("hash", "part")).drop("hash", "part", "clash")
    groups = rows.groupBy("key").agg(F.count("*").alias("group_size"), F.min(rank).alias("best"))
    groups = groups.where("group_size > 1").select(
        "key", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")
    )
    found = attach(rows, materialize(groups, "groups"), "key")
    alone = F.col("group_size").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """``docs`` with one row of each group of equal rows, all columns as they were.

    Groups are those of ``mark_copies``, compared byte for byte by the same step,
    and the row that stays is the same; rows alike in id, text length and hash are
    told apart by a number, so exactly one stays. Null text is empty text, a null id
    comes last, and an empty table gives an empty result.
    """
    text = normal(quoted(text_column))
    h, n, keep, sha = (free_name(docs, c) for c in ("hash", "points", "keep", "sha"))
    keyed = docs.withColumns(
        {
            h: F.unhex(content_hash(text)),
            sha: F.unhex(F.sha2(text.cast("binary"), 256)),
            n: F.char_length(whole(quoted(text_column))),
        }
    )
    row = free_name(keyed, "row")
    staged = materialize(keyed.withColumn(row, F.monotonically_increasing_id()), "keyed")
    slim = staged.select(
        quoted(id_column).alias("id"), *(F.col(c).alias(a) for c, a in ((h, "hash"), (sha, "sha"), (n, "points"), (row, "row")))
    )
    clash = _clashes(slim, staged.select(text.alias("t"), F.col(h).alias("hash")))
    slim = attach(slim, clash, "hash").withColumn("part", F.when(F.col("clash"), F.col("sha")).otherwise(F.lit(b"")))
    rank = F.struct((-F.col("points")).alias("a"), F.col("id").isNull().alias("b"), "id", "row")
    best = slim.groupBy("hash", "part").agg(F.min(rank).alias(keep))
    kept = best.select(F.col(f"{keep}.row").alias(row))
    return staged.join(kept, row, "left_semi").select(*[quoted(c) for c in docs.columns])
