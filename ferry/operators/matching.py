"""Keeping or dropping rows by a set of keys, however they are distributed."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from ferry.sources.sizing import shuffle_partitions

# Keys are broadcast up to this many bytes; a row costs some bytes more.
BROADCAST_BYTES = 32 * 1024 * 1024
ROW_OVERHEAD = 64
# A key is hot if it holds more rows than a shuffle partition would on average,
# and this many at least. There are fewer such keys than partitions.
HOT_ROWS = 100_000
# Rows of a hot key go to as many places as the shuffle has partitions, at least
# to this many.
PLACES = 64
# Up to this many hot keys are a condition; more are looked up.
LISTED_KEYS = 100


def name(column: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def holds(kind: DataType, *wanted: type) -> bool:
    """Whether a type is, or has inside, one of ``wanted``."""
    if isinstance(kind, ArrayType):
        return holds(kind.elementType, *wanted)
    if isinstance(kind, StructType):
        return any(holds(f.dataType, *wanted) for f in kind.fields)
    return isinstance(kind, wanted)


def places_for(rows: DataFrame) -> int:
    return max(PLACES, shuffle_partitions(rows))


def measure(keys: DataFrame, key: str) -> tuple[int, int]:
    """How many keys there are, and their bytes."""
    size = F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0))
    return tuple(keys.agg(F.count(F.lit(1)), size).first())


def broadcastable(count: int, size: int) -> bool:
    return size + count * ROW_OVERHEAD <= BROADCAST_BYTES


def hottest(counts: DataFrame, key: str, rows: str, places: int) -> list[Any]:
    """The hot keys of a DataFrame of counts, fewer than ``places``; None may be one."""
    total = counts.agg(F.sum(rows)).first()[0] or 0
    least = max(HOT_ROWS, total // places + 1)
    return [r[key] for r in counts.filter(F.col(rows) >= least).select(name(key)).collect()]


def hot_keys(rows: DataFrame, key: str) -> list[Any]:
    """The hot keys of ``rows``; each task counts before the shuffle."""
    counts = rows.groupBy(name(key)).agg(F.count(F.lit(1)).alias("_rows"))
    return hottest(counts, key, "_rows", places_for(rows))


def _flagged(rows: DataFrame, key: str, hot: Sequence[Any]) -> DataFrame:
    """``rows`` with _hot: whether the key is among ``hot``."""
    if len(hot) <= LISTED_KEYS:
        is_hot = name(key).isin([h for h in hot if h is not None])
        if None in hot:
            is_hot = is_hot | name(key).isNull()
        return rows.withColumn("_hot", F.coalesce(is_hot, F.lit(False)))
    kind = rows.schema[key].dataType
    listed = rows.sparkSession.createDataFrame([(h,) for h in hot], StructType().add("_key", kind))
    listed = listed.withColumn("_hot", F.lit(True))
    found = rows.join(F.broadcast(listed), name(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return found.withColumn("_hot", F.coalesce("_hot", F.lit(False)))


def match(
    rows: DataFrame, keys: DataFrame, key: str, how: str, hot: Sequence[Any] = ()
) -> DataFrame:
    """``left_semi`` or ``left_anti`` join by shuffle.

    Rows of a hot key are spread over many places, and that key is repeated for
    each of them. A row's place follows from its values and the task it comes
    from, so equal rows are spread too, and a task that runs again repeats it.
    """
    if not hot:
        return rows.join(keys, key, how).select(*rows.columns)
    places = places_for(rows)
    hashable = [
        F.to_json(F.struct(name(f.name))) if holds(f.dataType, MapType, VariantType) else name(f.name)
        for f in rows.schema
    ]
    home = F.lit(0).cast("bigint")
    somewhere = F.pmod(F.xxhash64(F.spark_partition_id(), *hashable), F.lit(places))
    spread = _flagged(rows, key, hot).withColumn("_place", F.when(F.col("_hot"), somewhere).otherwise(home))
    everywhere = F.sequence(home, F.lit(places - 1).cast("bigint"))
    repeated = _flagged(keys, key, hot).withColumn(
        "_place", F.explode(F.when(F.col("_hot"), everywhere).otherwise(F.array(home)))
    )
    joined = spread.drop("_hot").join(repeated.drop("_hot"), [key, "_place"], how)
    return joined.select(*[name(c) for c in rows.columns])
