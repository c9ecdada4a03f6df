"""Intermediate tables in the folder every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ferry.sources.sizing import sized_for

_local_roots: dict[str, str] = {}


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not is_local(spark):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that all executors share"
        )
    app = spark.conf.get("spark.app.id", "")
    if app not in _local_roots:
        root = tempfile.mkdtemp(prefix="ferry-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _local_roots[app] = root
    return _local_roots[app]


# The paths handed out inside the innermost ``own_scratch``.
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def scratch_path(spark: SparkSession, name: str = "stage") -> str:
    """A path nobody has used yet."""
    path = f"{scratch_root(spark)}/ferry/{name}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def own_scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Remove what is staged inside once it ends well; nothing may read it then.

    Take a path off the list to keep it. After an error everything stays, as it
    may be all that is left of the rows.
    """
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield paths
    finally:
        _owned.reset(token)
    for path in paths:
        fs, jvm_path = _file_system(spark, path)
        fs.delete(jvm_path, True)


class Staged(NamedTuple):
    rows: DataFrame
    path: str


def stage(df: DataFrame, name: str = "stage") -> Staged:
    """Write ``df`` to scratch and read it back.

    The copy is computed once, outlives lost executors, has a known size for
    the optimizer and can be counted from file footers.
    """
    path = scratch_path(df.sparkSession, name)
    with sized_for(df):
        df.write.parquet(path)
    return Staged(df.sparkSession.read.schema(df.schema).parquet(path), path)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """The rows of ``stage``, for plans that go on from them."""
    return stage(df, name).rows


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _file_system(spark, path)
    return fs.exists(jvm_path)


def make_folder(spark: SparkSession, path: str) -> str:
    fs, jvm_path = _file_system(spark, path)
    fs.mkdirs(jvm_path)
    return path


def discard(staged: Staged) -> None:
    """Remove a staged copy that nothing reads any more."""
    fs, jvm_path = _file_system(staged.rows.sparkSession, staged.path)
    fs.delete(jvm_path, True)
