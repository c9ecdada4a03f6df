"""Document collections: a document store, or a folder of JSON lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ferry.fixed_values import LEDGER_CONTAINER
from ferry.sources.endpoint import Endpoint
from ferry.sources.objects import read_dataset, write_dataset


def read_collection(
    spark: SparkSession,
    endpoint: Endpoint,
    collection: str = LEDGER_CONTAINER,
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a collection; its schema is inferred unless given."""
    schema = schema or endpoint.schemas.get(collection)
    merged = {**endpoint.options, **(options or {})}
    if endpoint.format != "mongodb":
        return read_dataset(
            spark, endpoint.path(collection), endpoint.format, schema, merged
        )
    reader = spark.read.format("mongodb").options(**merged)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("collection", collection).load()


def write_collection(
    df: DataFrame,
    endpoint: Endpoint,
    collection: str = LEDGER_CONTAINER,
    mode: str = "append",
    options: Mapping[str, str] | None = None,
) -> int:
    """Write a collection and return the number of rows."""
    merged = {**endpoint.options, **(options or {})}
    if endpoint.format != "mongodb":
        return write_dataset(
            df, endpoint.path(collection), endpoint.format, mode, options=merged
        )
    rows = Observation()
    (
        df.observe(rows, F.count(F.lit(1)).alias("n"))
        .write.format("mongodb")
        .options(**merged)
        .option("collection", collection)
        .mode(mode)
        .save()
    )
    return rows.get["n"]
