"""Datasets in an object store or file system."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from ferry.fixed_values import OBJECT_SCHEME
from ferry.operators.matching import name
from ferry.sources import layout as layouts
from ferry.sources.scratch import _file_system, path_exists
from ferry.sources.sizing import sized_for
from ferry.sources.sniffing import typed

# CSV options under which NULL, '', blanks, quotes and line breaks come back as
# they were written. Files whose values may hold line breaks cannot be split, so
# writing bounds the rows of a file instead.
EXACT_CSV = {
    "header": "true",
    "nullValue": "\\N",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

EXACT_CSV_READ = {"multiLine": "true"}
EXACT_CSV_WRITE = {"maxRecordsPerFile": "1000000"}

# Written with microseconds; readers recognise them, and other forms, by default.
EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Columns holding only NULLs stay visible to a reader that infers the schema.
EXACT_JSON_WRITE = {"ignoreNullFields": "false"}

# Formats whose partitioned datasets keep their schema beside them; delta has its own.
LAID_OUT = ("parquet", "json", "csv", "orc")

# Headerless pipe-separated extracts.
PIPE_DAT = {
    "sep": "|",
    "header": "false",
    "quote": "",
    "pathGlobFilter": "*.dat",
}


# -- addresses ---------------------------------------------------------------


def object_path(
    bucket: str,
    layer: str | None = None,
    name: str | None = None,
    directory: bool = False,
    scheme: str = OBJECT_SCHEME,
) -> str:
    """``s3a://bucket/layer/name``, with a final slash for a directory."""
    path = scheme + "/".join(p for p in (bucket, layer, name) if p)
    return path if not directory or path.endswith("/") else path + "/"


def resolve_path(
    path: str | None = None,
    bucket: str = "",
    filename: str | None = None,
    default_path: str | None = None,
    scheme: str = OBJECT_SCHEME,
) -> tuple[str, str, str]:
    """(uri, bucket, key) from a full URI, a relative path or a file name.

    The bucket of a full URI wins over ``bucket``. Without a path, a file name
    is looked for under the default path.
    """
    if path and path.startswith(scheme):
        bucket, _, key = path[len(scheme):].partition("/")
        return path, bucket, key
    if path:
        key = path
    elif filename:
        key = f"{default_path or 'data/csv'}/{filename}"
    else:
        key = default_path or "data"
    return f"{scheme}{bucket}/{key}", bucket, key


# -- reading -----------------------------------------------------------------


def _format_defaults(format: str, writing: bool) -> dict[str, str]:
    if format == "csv":
        return EXACT_CSV | (EXACT_TIMES | EXACT_CSV_WRITE if writing else EXACT_CSV_READ)
    if format == "json" and writing:
        return EXACT_JSON_WRITE | EXACT_TIMES
    if format == "delta" and writing:
        return {"mergeSchema": "true", "overwriteSchema": "true"}
    return {}


def read_dataset(
    spark: SparkSession,
    path: str,
    format: str,
    schema: StructType | str | None = None,
    options: Mapping[str, Any] | None = None,
    folders: Column | None = None,
) -> DataFrame:
    """Read csv, json, parquet, delta or any other installed format.

    Give ``schema`` for text formats where you can: inferring it reads the
    whole dataset once more. A partitioned dataset of this library has its schema
    beside it, so its columns come back in their order and type, and its partition
    values as they were, with or without one. ``folders`` is a condition on the
    folders of a keyed dataset, whose numbers are not among its columns.
    """
    layout = layouts.kept(spark, path) if format in LAID_OUT else None
    if layout is not None:
        schema = layout.struct if schema is None else schema
    reader = spark.read.format(format).options(
        **{**_format_defaults(format, writing=False), **(options or {})}
    )
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if layout is None:
        return df
    order = [f.name for f in layout.struct if f.name in df.columns]
    order += [c for c in df.columns if c not in order]
    if folders is not None:
        df = df.where(folders)
    hidden = layout.partition_by if layout.key else ()
    return layouts.restored(df, layout).select(*[name(c) for c in order if c not in hidden])


def format_of(path: str) -> str:
    """By extension: parquet, json, otherwise csv."""
    for known in ("parquet", "json"):
        if path.endswith("." + known):
            return known
    return "csv"


def read_file(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Read a file, or a folder of such files, whose format its name tells.

    CSV has a header unless ``options`` say otherwise, and its records may hold
    line breaks within quotes. Without a schema a CSV column gets the narrowest type
    that gives all its values back (``sniffing.column_types``), for which the file is
    read once more; options such as inferSchema leave the types to Spark.
    """
    format = format_of(path)
    given = {k.lower() for k in options or {}}
    sniff = format == "csv" and schema is None and not given & {"inferschema", "header"}
    df = read_dataset(spark, path, format, schema, options)
    return typed(df) if sniff else df


def read_parts(
    spark: SparkSession,
    path: str,
    pattern: str = "part-*.csv",
    schema: StructType | str | None = None,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """All files under ``path`` whose name fits ``pattern``."""
    return read_dataset(
        spark, path, format_of(pattern), schema,
        {**(options or {}), "pathGlobFilter": pattern},
    )


def read_pipe_dat(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Headerless ``.dat`` files; types are inferred unless a schema is given."""
    merged = {**PIPE_DAT, **(options or {})}
    if schema is None:
        merged.setdefault("inferSchema", "true")
    reader = spark.read.options(**merged)
    return (reader if schema is None else reader.schema(schema)).csv(path)


def _status(status) -> tuple[str, int, float]:
    return status.getPath().toString(), status.getLen(), status.getModificationTime() / 1000


def _hidden(spark: SparkSession, path: str) -> list[tuple[str, int, float]]:
    """Objects whose name, or that of a folder above them, begins with _ or a dot.

    Spark's readers leave them out, but not partitions such as _a=1. They mark and
    describe datasets, so there are few of them; the file system is asked for them
    level by level.
    """
    fs, root = _file_system(spark, path)
    at = spark._jvm.org.apache.hadoop.fs.Path
    found, level = {}, root.toString().rstrip("/")
    while True:
        for status in fs.globStatus(at(f"{level}/[_.]*")) or ():
            called, folder = status.getPath().getName(), status.isDirectory()
            if called.startswith("_") and "=" in called and (folder or status.getLen()):
                continue
            if not folder:
                found[status.getPath().toString()] = _status(status)
                continue
            inside = fs.listFiles(status.getPath(), True)
            while inside.hasNext():
                below = inside.next()
                found[below.getPath().toString()] = _status(below)
        level += "/*"
        if not len(fs.globStatus(at(level)) or ()):
            return list(found.values())


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(name, size, last_modified) of every object below ``path``, markers included.

    Only file status is read; the contents are pruned from the scan. Folders are no
    objects.
    """
    seen = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.col("path").alias("name"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("last_modified"),
        )
    )
    hidden = spark.createDataFrame(_hidden(spark, path), "name string, size bigint, seconds double")
    return seen.unionByName(
        hidden.select("name", "size", F.timestamp_millis(F.round(F.col("seconds") * 1000).cast("bigint")).alias("last_modified"))
    )


# -- writing -----------------------------------------------------------------


def _refuse(df: DataFrame, columns: Sequence[str], wrong: Callable[[Column], Column], why: str) -> DataFrame:
    """``df``, which fails as it is written if a value of ``columns`` is wrong."""
    if not columns:
        return df
    checked = set(columns)
    return df.select(
        *[
            F.when(wrong(name(c)), F.raise_error(F.lit(f"column {c}: {why}"))).otherwise(name(c)).alias(c)
            if c in checked
            else name(c)
            for c in df.columns
        ]
    )


def _loud(df: DataFrame, format: str, partitions: Sequence[str], options: Mapping[str, Any]) -> DataFrame:
    """``df``, which fails where a reader would not find a value as it was written."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    if format not in LAID_OUT:
        df = _refuse(
            df, [c for c in texts if c in partitions], lambda c: c == "", "a partition cannot be named by an empty string"
        )
    if format != "csv":
        return df
    inside = [c for c in texts if c not in partitions]
    if options.get("quote") == "":
        breaks = "".join({options.get("sep", options.get("delimiter", ",")), "\n", "\r"})
        return _refuse(
            df, inside, lambda c: F.translate(c, breaks, "") != c, "a separator or line break, and nothing quotes it"
        )
    null = options.get("nullValue")
    return _refuse(df, inside, lambda c: c == F.lit(null), f"{null} stands for NULL") if null else df


def write_dataset(
    df: DataFrame,
    path: str,
    format: str,
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    options: Mapping[str, Any] | None = None,
    output_filename: str | None = None,
    rebalance: bool = True,
) -> int:
    """Write and return the number of rows, counted by the write itself.

    The counter sits in the last stage, where Spark counts each finished task
    once, so a task that runs again does not add to it. With ``partition_by``
    rows are first rebalanced on those columns (unless ``rebalance`` is false,
    for rows that lie together already): files stay few, and adaptive execution
    splits a value that holds much of the data over several tasks. The schema is
    kept beside the files, so partition values come back in their type, '' and
    NULL told apart; rows appended to such a dataset must fit it.

    A value that the format cannot give back is an error: in CSV the mark for
    NULL, without quotes a separator or line break.
    """
    spark = df.sparkSession
    if output_filename:
        path = f"{path.rstrip('/')}/{output_filename}"
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    options = {**_format_defaults(format, writing=True), **(options or {})}
    # Of an overwrite of some folders only, the others stay, and so does the layout.
    stays = str(options.get("partitionOverwriteMode", "")).lower() == "dynamic"
    layout = _layout(df, path, "append" if stays else mode, columns) if format in LAID_OUT else None
    df = _loud(df, format, columns, options)
    if layout is not None:
        df = layouts.escaped(df, layout)
    if columns and rebalance and spark.conf.get("spark.sql.adaptive.enabled", "true") == "true":
        df = df.hint("rebalance", *columns)
    rows = Observation()
    writer = (
        df.observe(rows, F.count(F.lit(1)).alias("n"))
        .write.format(format)
        .mode(mode)
        .options(**options)
    )
    if columns:
        writer = writer.partitionBy(*columns)
    with sized_for(df):
        writer.save(path)
    if layout is not None:
        layouts.keep(spark, path, layout)
    return rows.get["n"]


def _layout(df: DataFrame, path: str, mode: str, columns: Sequence[str]) -> layouts.Layout | None:
    """The layout to keep once ``df`` is written, if there is one to keep."""
    new = layouts.layout_of(df, columns)
    if mode == "overwrite":
        return new if columns else None
    old = layouts.kept(df.sparkSession, path)
    if old is None:
        # What lies there already, if anything, is not known.
        return new if columns and not path_exists(df.sparkSession, path) else None
    return layouts.joined(old, new, path)
