"""Datasets whose files were written with different columns and types."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ferry.operators.matching import name
from ferry.sources.objects import read_dataset

# From the narrowest to the widest: each holds the numbers of those before it,
# except that a double holds whole numbers up to 2**53.
NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
WHOLE = NUMBERS[:4]
MOST_DIGITS = 38


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number type."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    sizes = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    return (sizes[type(kind)], 0) if type(kind) in sizes else None


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that both can be turned into.

    Whole numbers widen to longer ones and, beside a double, to double; exact
    decimals to one that has room for both; dates to times; structs and arrays by
    their elements; anything else of two kinds to text.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in NUMBERS and type(b) in NUMBERS:
        top = max(NUMBERS.index(type(a)), NUMBERS.index(type(b)))
        mixed = (type(a) in WHOLE) != (type(b) in WHOLE)
        return T.DoubleType() if mixed else NUMBERS[top]()
    exact = _digits(a), _digits(b)
    if all(exact):
        before, after = (max(x) for x in zip(*exact))
        return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else T.StringType()
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return united(a, b)
    return T.StringType()


def united(a: T.StructType, b: T.StructType) -> T.StructType:
    """All columns of both, by name, those of ``a`` first, in types wide enough for both."""
    fields = {f.name: f.dataType for f in a}
    for f in b:
        fields[f.name] = widest(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(c, kind) for c, kind in fields.items()])


def widen(column: Column, old: T.DataType, new: T.DataType) -> Column:
    """``column`` in the wider type; a long that a double cannot hold fails loudly."""
    if old == new:
        return column
    if isinstance(old, T.LongType) and isinstance(new, T.DoubleType):
        exact = column.between(-(2**53), 2**53) | column.isNull()
        return F.when(exact, column.cast("double")).otherwise(
            F.raise_error(F.concat(column.cast("string"), F.lit(" is beyond the whole numbers that a double holds"))).cast("double")
        )
    if isinstance(new, T.StringType) and isinstance(old, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column)
    if isinstance(new, T.StructType) and isinstance(old, T.StructType):
        own = {f.name: f.dataType for f in old}
        made = [
            (widen(column.getField(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in new
        ]
        return F.when(column.isNotNull(), F.struct(*made))
    if isinstance(new, T.ArrayType) and isinstance(old, T.ArrayType):
        return F.transform(column, lambda x: widen(x, old.elementType, new.elementType))
    return column.cast(new)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and wider types of ``schema``, NULL where it has no such column."""
    own = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (widen(name(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, in their united columns."""
    schema = reduce(united, (p.schema for p in parts))
    return reduce(DataFrame.unionAll, (conform(p, schema) for p in parts))


def alike_files(
    files: Sequence[str], merged: Callable[[Sequence[str]], T.StructType]
) -> list[tuple[T.StructType, list[str]]]:
    """Groups of files whose schemas merge, and the schema of each group.

    ``merged`` gives the schema of some files, or raises where their types clash;
    then each half is tried. Files stand in the order they were written in, in which
    types change rarely, so there are few groups and few trials.
    """
    try:
        found = [(merged(files), list(files))]
    except Exception as e:  # comes from the JVM, as a kind of its own or a plain one
        if len(files) == 1 or "CANNOT_MERGE" not in str(e):
            raise
        half = len(files) // 2
        found = alike_files(files[:half], merged) + alike_files(files[half:], merged)
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, some in found:
        key = schema.json()
        groups[key] = (schema, groups[key][1] + some if key in groups else some)
    return list(groups.values())


def read_widened(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Read a dataset whose parts differ in columns and types.

    Columns are united by name and get the narrowest type wide enough for all parts.
    Parquet files are told apart by their footers, which Spark reads in parallel;
    files of one schema are one scan, and nothing is shuffled. JSON is typed by
    Spark, over all files. Partition columns are columns like others.
    """
    if format != "parquet":
        return read_dataset(spark, path, format)
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("path", "modificationTime").orderBy("modificationTime", "path")
    )
    files = [r["path"] for r in listed.collect()]  # as many as the scan itself has to know
    if not files:
        raise FileNotFoundError(f"no files in {path}")
    reader = spark.read.option("mergeSchema", "true").option("basePath", path)
    groups = alike_files(files, lambda some: reader.parquet(*some).schema)
    return union_by_name([spark.read.schema(s).option("basePath", path).parquet(*some) for s, some in groups])
