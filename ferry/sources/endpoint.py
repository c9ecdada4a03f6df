"""What a store is: its kind, its Spark data source and how to reach it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import StructType

from ferry.fixed_values import DATABASES, STORAGES


@dataclass(frozen=True)
class Endpoint:
    """One store.

    kind     mongodb, postgresql, s3 or minio (the last two mean the same)
    format   the Spark data source to use: jdbc, mongodb, parquet, json, csv,
             delta, ... It is never replaced by another one; if its connector
             is not on the class path, reading and writing fail.
    root     folder of the containers, for file formats
    options  data source options, credentials included; nothing is built in
    schemas  known schemas by container; a text format read without one is
             read once more in full to infer it
    splits   for tables, by container: the column by whose values reading is split
             into parts of like size, and how many of them
    """

    kind: str
    format: str
    root: str = ""
    options: Mapping[str, str] = field(default_factory=dict)
    schemas: Mapping[str, StructType] = field(default_factory=dict)
    splits: Mapping[str, tuple[str, int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in DATABASES + STORAGES:
            raise ValueError(
                f"unsupported store {self.kind!r}; use one of "
                f"{', '.join(DATABASES + STORAGES)}"
            )

    def __repr__(self) -> str:
        return f"Endpoint({self.kind}, {self.format}, {self.root!r})"

    @property
    def is_database(self) -> bool:
        return self.kind in DATABASES

    @property
    def is_table_store(self) -> bool:
        return self.format == "jdbc"

    def path(self, name: str) -> str:
        """Where the container or dataset called ``name`` lies."""
        if "://" in name or name.startswith("/") or not self.root:
            return name
        return f"{self.root.rstrip('/')}/{name}"
