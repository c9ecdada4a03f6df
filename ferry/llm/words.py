"""What the operators share: words, row keys, tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.operators.matching import broadcastable, hot_keys, places_for

# Fixed value: what stands between words, once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

MB = 1024 * 1024
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(df: DataFrame, rows: int = 1000) -> Iterator[None]:
    """Hand whole texts to Python workers some rows at a time in the jobs inside.

    A setting that is smaller already stays, and the session's own is put back.
    """
    conf = df.sparkSession.conf
    before = conf.get(BATCH_ROWS)
    if not 0 < int(before) <= rows:
        conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        conf.set(BATCH_ROWS, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column | str) -> Column:
    """Words in order. ``lower`` turns no separator into a word or back, so it
    gives as many words as lower-casing A-Z alone."""
    return F.array_remove(F.split(F.lower(whole(text)), BETWEEN), "")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def bytes_of(table: DataFrame) -> tuple[int, int]:
    """Rows and, roughly, bytes of ``table``: of every column as text."""
    size = sum((F.coalesce(F.octet_length(quoted(c).cast("string")), F.lit(0)) for c in table.columns), F.lit(0))
    found = table.agg(F.count("*"), F.sum(size.cast("long"))).first()
    return found[0], found[1] or 0


def attach(
    rows: DataFrame, table: DataFrame, key: str, how: str = "left", hot: Sequence[Any] | None = None
) -> DataFrame:
    """``rows`` joined with ``table``, which has a key once, by a column of both.

    Both are read several times, so pass what is stored or cheap. A measured small
    table is broadcast. Otherwise keys with more rows than a shuffle partition has
    on average are spread over all of them (``hot``, counted unless given), and
    their row of ``table`` is repeated for each place.
    """
    if broadcastable(*bytes_of(table)):
        return rows.join(F.broadcast(table), key, how)
    hot = hot_keys(rows, key) if hot is None else hot
    if not hot:
        return rows.join(table, key, how)
    places = places_for(rows)
    kind = rows.schema[key].dataType
    listed = rows.sparkSession.createDataFrame([(h,) for h in hot], f"`hot_key` {kind.simpleString()}")
    listed = F.broadcast(listed.withColumn("is_hot", F.lit(True)))
    somewhere = F.pmod(F.xxhash64(F.spark_partition_id(), *map(quoted, rows.columns)), F.lit(places)).cast("int")

    def marked(df: DataFrame) -> DataFrame:
        return df.join(listed, quoted(key).eqNullSafe(F.col("hot_key")), "left").drop("hot_key")

    spread = marked(rows).withColumn("place", F.when(F.col("is_hot"), somewhere).otherwise(0)).drop("is_hot")
    everywhere = F.when(F.col("is_hot"), F.sequence(F.lit(0), F.lit(places - 1))).otherwise(F.array(F.lit(0)))
    repeated = marked(table).withColumn("place", F.explode(everywhere)).drop("is_hot")
    return spread.join(repeated, [key, "place"], how).drop("place")
