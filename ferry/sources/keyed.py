"""Datasets spread over folders by a key, so that a change rewrites only what it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ferry.operators.matching import broadcastable, hot_keys, match, measure, name
from ferry.sources import layout as layouts
from ferry.sources.objects import read_dataset, write_dataset
from ferry.sources.scratch import _file_system, stage
from ferry.sources.sizing import input_bytes

BUCKET = "_bucket"
# A folder holds so many bytes of input by default, and there are this many at least
# and at most: one number for each touched folder goes through the driver.
FOLDER_BYTES = 128 * 1024 * 1024
LEAST_FOLDERS, MOST_FOLDERS = 16, 100_000


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(name(key).cast("string")), F.lit(buckets)).cast("int")


def keyed_layout(spark: SparkSession, path: str) -> layouts.Layout | None:
    """The layout of a keyed dataset, None for any other place."""
    found = layouts.kept(spark, path)
    return found if found and found.key else None


def write_keyed(df: DataFrame, path: str, format: str, key: str, buckets: int | None = None) -> int:
    """Write a dataset anew, spread by ``key`` over ``buckets`` folders; returns its rows.

    All rows of a key lie in one folder. A NULL key is a key.
    """
    if buckets is None:
        buckets = min(max(input_bytes(df) // FOLDER_BYTES, LEAST_FOLDERS), MOST_FOLDERS)
    spread = df.withColumn(BUCKET, bucket_of(key, buckets))
    rows = write_dataset(spread, path, format, "overwrite", BUCKET)
    layouts.keep(df.sparkSession, path, layouts.layout_of(spread, [BUCKET], key, buckets))
    return rows


def append_keyed(df: DataFrame, path: str, format: str) -> int:
    """Add rows to their folders; no file that is there is touched."""
    layout = keyed_layout(df.sparkSession, path)
    spread = df.withColumn(BUCKET, bucket_of(layout.key, layout.buckets))
    return write_dataset(spread, path, format, "append", BUCKET)


def touched(keys: DataFrame, layout: layouts.Layout) -> list[int]:
    """The folders that hold the keys: a number each, and no more than there are folders."""
    buckets = keys.select(bucket_of(layout.key, layout.buckets).alias(BUCKET)).distinct()
    return sorted(r[0] for r in buckets.collect())


def read_keyed(spark: SparkSession, path: str, format: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows, or those of some folders; the others are not listed by the scan."""
    some = None if buckets is None else F.col(BUCKET).isin(list(buckets))
    return read_dataset(spark, path, format, folders=some)


def replace_buckets(rows: DataFrame, path: str, format: str, buckets: Sequence[int]) -> int:
    """Replace the content of some folders by ``rows``, which may be computed from it.

    ``rows`` are all rows that these folders shall hold. They are complete in
    scratch before anything is replaced; then Spark moves new folders into place
    one by one, and files of other folders stay as they are. A reader meanwhile
    sees a folder as it was or as it will be. Two writers that touch the same folder
    must not run at a time.
    """
    spark = rows.sparkSession
    layout = keyed_layout(spark, path)
    spread = rows.withColumn(BUCKET, bucket_of(layout.key, layout.buckets))
    copy = stage(spread, "keyed")
    filled = {r[0] for r in copy.rows.select(BUCKET).distinct().collect()}
    astray = sorted(filled - set(buckets))
    if astray:
        raise ValueError(f"rows belong to folders {astray[:10]} that were not to be replaced")
    written = 0
    if filled:
        written = write_dataset(
            copy.rows, path, format, "overwrite", BUCKET, {"partitionOverwriteMode": "dynamic"}
        )
    for bucket in sorted(set(buckets) - filled):  # all its keys are gone
        fs, folder = _file_system(spark, f"{path.rstrip('/')}/{BUCKET}={bucket}")
        fs.delete(folder, True)
    return written


def replace_keys(spark: SparkSession, path: str, format: str, updates: DataFrame, keys: DataFrame) -> int:
    """Replace all rows of ``keys`` by ``updates``, which has rows of these keys alone.

    A key without an update is gone afterwards. Returns the rows written, those of
    other keys in the touched folders included.
    """
    layout = keyed_layout(spark, path)
    keys = stage(keys.select(name(layout.key)).distinct(), "keys").rows
    folders = touched(keys, layout)
    there = read_keyed(spark, path, format, folders)
    if broadcastable(*measure(keys, layout.key)):
        kept = there.join(F.broadcast(keys), layout.key, "left_anti").select(*map(name, there.columns))
    else:
        kept = match(there, keys, layout.key, "left_anti", hot_keys(there, layout.key))
    return replace_buckets(kept.unionByName(updates, allowMissingColumns=True), path, format, folders)
