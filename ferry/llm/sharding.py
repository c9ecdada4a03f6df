"""Shards by jump consistent hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferry.llm.words import free_name, quoted, whole
from ferry.sources.scratch import materialize
from ferry.sources.sizing import shuffle_partitions

# Fixed value: the multiplier of the 64-bit generator of the published method.
MULTIPLIER = 2862933555777941757
LOW = 0xFFFFFFFF


def _halves(key: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(key, 32), key.bitwiseAND(LOW)


def _low_product(a: Column, b: int) -> Column:
    """a * b modulo 2^32 for 32-bit a and b, below 2^63 at every step."""
    return (
        a.bitwiseAND(0xFFFF) * F.lit(b)
        + F.shiftleft((F.shiftrightunsigned(a, 16) * F.lit(b)).bitwiseAND(0xFFFF), 16)
    ).bitwiseAND(LOW)


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2^64, in halves: checked arithmetic allows no wrap."""
    m1, m0 = MULTIPLIER >> 32, MULTIPLIER & LOW
    top = F.shiftrightunsigned(low, 16) * F.lit(m0)
    part = low.bitwiseAND(0xFFFF) * F.lit(m0) + F.shiftleft(top.bitwiseAND(0xFFFF), 16) + 1
    carry = F.shiftrightunsigned(part, 32) + F.shiftrightunsigned(top, 16)
    new_high = carry + _low_product(high, m0) + _low_product(low, m1)
    return new_high.bitwiseAND(LOW), part.bitwiseAND(LOW)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a 64-bit key; a null key counts as 0.

    A key jumps ahead from shard to shard while it stays below the count. Each
    jump moves on by one at least, so ``shards`` steps are enough.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    high, low = _halves(F.coalesce(key.cast("long"), F.lit(0).cast("long")))
    start = F.struct(
        high.alias("high"), low.alias("low"),
        F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("jump"),
    )

    def step(at: Column, _: Column) -> Column:
        new_high, new_low = _next(at["high"], at["low"])
        jump = F.floor(
            (at["jump"] + 1) * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(new_high, 1) + 1))
        )
        ahead = F.struct(
            new_high.alias("high"), new_low.alias("low"),
            at["jump"].alias("shard"), jump.cast("long").alias("jump"),
        )
        return F.when(at["jump"] < shards, ahead).otherwise(at)

    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, step, lambda at: at["shard"].cast("int"))


def shard_key(column: Column, kind: str) -> Column:
    """Integers as they are, anything else by a 64-bit hash of its text."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return column.cast("long")
    return F.xxhash64(column.cast("string"))


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", name: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row; the key and the count alone decide."""
    kind = dict(docs.dtypes)[key]
    return docs.withColumn(name, jump_shard(shard_key(quoted(key), kind), shards))


def number_rows(rows: DataFrame, group: str, order: list[str], name: str = "slot") -> DataFrame:
    """Number the rows of each group from 0 without gaps, in ``order``, nulls first.

    Rows are sorted into ranges, which split a large group and rows that are
    alike in everything, and are numbered as they are written; only the first
    number and the row count of each group and range are compared.
    """
    at, row, base, first = (free_name(rows, c) for c in ("at", "row", "base", "first"))
    rows = materialize(rows.withColumn(row, F.monotonically_increasing_id()), "rows")
    by = [quoted(c) for c in [group, *order, row]]
    rows = rows.repartitionByRange(shuffle_partitions(rows), *by).sortWithinPartitions(*by)
    rows = materialize(rows.drop(row).withColumn(at, F.monotonically_increasing_id()), "sorted")
    part = F.shiftright(F.col(at), 33).alias(base)  # the range, in the upper bits of the number
    sizes = rows.groupBy(group, part).agg(F.min(at).alias(first), F.count("*").alias(row))
    before = Window.partitionBy(group).orderBy(base).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        group, base, (F.coalesce(F.sum(row).over(before), F.lit(0)) - F.col(first)).alias(first)
    )
    return (
        rows.withColumn(base, F.shiftright(F.col(at), 33))
        .join(sizes, [group, base])
        .withColumn(name, F.col(first) + F.col(at))
        .drop(base, at, first)
    )


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its shard, its place there and its shard after growth.

    Null and repeated keys are rows like others and go where their key goes (null
    counts as 0). Null text has no bytes. An empty table gives an empty result.
    """
    body = whole(quoted(text)).cast("binary")
    slim = docs.select(
        quoted(key).alias("doc_id"),
        (F.octet_length(body).cast("long") + 16).alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    kind = dict(slim.dtypes)["doc_id"]
    place = shard_key(F.col("doc_id"), kind)
    slim = slim.withColumns(
        {"shard": jump_shard(place, shards), "grown_shard": jump_shard(place, shards + 1)}
    )
    numbered = number_rows(slim, "shard", ["doc_id", "text_crc32", "size"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id", rows_per_file: int = 1_000_000) -> None:
    """Write a folder per shard; large shards take several tasks and files."""
    name = free_name(docs, "shard")
    sharded = assign_shards(docs, shards, key, name)
    (
        sharded.hint("rebalance", name)
        .write.partitionBy(name)
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )
