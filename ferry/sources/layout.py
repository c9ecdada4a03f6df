"""What a partitioned dataset keeps beside its files: its schema, and how it is laid out.

Partition values are text in folder names, so a reader has to guess their types,
and an empty string cannot be told from NULL. A small file in the dataset, hidden
from Spark's readers, holds what is needed to give the values back.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from ferry.operators.matching import name
from ferry.sources.scratch import _file_system

FILE = "_layout.json"
# Fixed value: the folder name that stands for NULL.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
EMPTY = "\\E"


@dataclass(frozen=True)
class Layout:
    """schema    all columns, partition columns among them
    partition_by  the partition columns, in the order of the folders
    key, buckets  for a keyed dataset: the key, and over how many folders it is spread
    """

    schema: str
    partition_by: list[str] = field(default_factory=list)
    key: str | None = None
    buckets: int = 0

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))

    @property
    def escaped(self) -> list[str]:
        kinds = {f.name: f.dataType for f in self.struct}
        return [c for c in self.partition_by if isinstance(kinds[c], StringType)]


def layout_of(df: DataFrame, partition_by: Sequence[str], key: str | None = None, buckets: int = 0) -> Layout:
    return Layout(df.schema.json(), list(partition_by), key, buckets)


def _file(spark: SparkSession, path: str):
    fs, folder = _file_system(spark, path)
    return fs, spark._jvm.org.apache.hadoop.fs.Path(folder, FILE)


def keep(spark: SparkSession, path: str, layout: Layout) -> None:
    fs, file = _file(spark, path)
    out = fs.create(file, True)
    try:
        out.write(json.dumps(asdict(layout)).encode())
    finally:
        out.close()


def kept(spark: SparkSession, path: str) -> Layout | None:
    """The layout kept in the dataset, or None where there is none."""
    if any(c in path for c in "*?{}[]"):
        return None
    fs, file = _file(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        text = spark._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A").next()
    finally:
        stream.close()
    return Layout(**json.loads(text))


def joined(old: Layout, new: Layout, path: str) -> Layout:
    """The layout of a dataset that rows of another schema are appended to.

    Columns are united by name. Other partition columns, or a column of another
    type, would not be found again and are errors.
    """
    if old.partition_by != new.partition_by:
        raise ValueError(f"{path} is partitioned by {old.partition_by}, not by {new.partition_by}")
    fields = {f.name: f for f in old.struct}
    for f in new.struct:
        there = fields.setdefault(f.name, f)
        if there.dataType != f.dataType:
            raise ValueError(
                f"column {f.name} of {path} is {there.dataType.simpleString()}, not {f.dataType.simpleString()}"
            )
    return Layout(StructType(list(fields.values())).json(), old.partition_by, old.key, old.buckets)


def _escape(value: Column) -> Column:
    marked = value.startswith("\\") | (value == NULL_FOLDER)
    return F.when(value == "", EMPTY).when(marked, F.concat(F.lit("\\"), value)).otherwise(value)


def _unescape(value: Column) -> Column:
    inner = F.when(value.startswith("\\"), F.substring(value, F.lit(2), F.length(value))).otherwise(value)
    return F.when(value == EMPTY, "").otherwise(inner)


def _with(df: DataFrame, columns: Sequence[str], change) -> DataFrame:
    chosen = set(columns)
    return df.select(*[change(name(c)).alias(c) if c in chosen else name(c) for c in df.columns])


def escaped(df: DataFrame, layout: Layout) -> DataFrame:
    """``df`` with partition values that can name folders: '' and what would be read as NULL."""
    return _with(df, layout.escaped, _escape)


def restored(df: DataFrame, layout: Layout) -> DataFrame:
    """``df`` as read, with its partition values as they were; filters on them still prune folders."""
    return _with(df, [c for c in layout.escaped if c in df.columns], _unescape)
