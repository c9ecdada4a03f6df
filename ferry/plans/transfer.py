"""Transfers between stores.

``Stores`` names the stores of a deployment once; its methods read, write and
transfer between them by kind.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ferry.fixed_values import (
    DATABASES,
    FIRST_VERSION,
    LEDGER_CONTAINER,
    STORAGES,
    USER_TABLE_LENGTHS,
)
from ferry.operators import ledger as ledgers
from ferry.operators.matching import broadcastable, hot_keys, match, measure, name
from ferry.operators.quality import drop_surrogate_key, validate_all
from ferry.operators.verification import require_same
from ferry.schemas import LEDGER, RAW_USER, fits_user_table
from ferry.sources import documents, keyed, layout as layouts, objects, tables
from ferry.sources.endpoint import Endpoint
from ferry.sources.scratch import own_scratch, path_exists, stage


# Formats that have to be read to be counted.
TEXT_FORMATS = ("csv", "json")


class TransferError(RuntimeError):
    """A transfer that cannot be made, or has nothing to move."""


@dataclass(frozen=True)
class Transferred:
    """Outcome of a plain transfer."""

    success: bool
    row_count: int
    source: str
    target: str


@dataclass(frozen=True)
class UsersTransferred:
    """Outcome of a validated transfer.

    ``invalid`` is everything that is not valid, duplicates included.
    ``written`` is less than ``valid`` by the rows a table would refuse, which are
    kept in the dataset ``refused_to``, and in append mode by the ``known`` ones.
    """

    total: int
    valid: int
    invalid: int
    written: int
    source: str
    target: str
    refused: int = 0
    refused_to: str | None = None
    known: int = 0


def _tidy(call: Callable) -> Callable:
    """A method of ``Stores`` that leaves nothing behind in scratch once it ends well."""

    @functools.wraps(call)
    def tidy(self: Stores, *given: Any, **more: Any) -> Any:
        with own_scratch(self.spark):
            return call(self, *given, **more)

    return tidy


class Stores:
    """The stores of one deployment, by kind; s3 and minio are one store."""

    def __init__(self, spark: SparkSession, endpoints: Sequence[Endpoint]) -> None:
        self.spark = spark
        self._by_kind = {self._kind(e.kind): e for e in endpoints}

    @staticmethod
    def _kind(kind: str) -> str:
        return "s3" if kind in STORAGES else kind

    def endpoint(self, kind: str) -> Endpoint:
        if kind not in DATABASES + STORAGES:
            raise ValueError(f"unsupported store: {kind!r}")
        try:
            return self._by_kind[self._kind(kind)]
        except KeyError:
            raise ValueError(f"no endpoint was given for {kind!r}") from None

    # -- reading and writing -------------------------------------------------

    def read(
        self,
        kind: str,
        name: str,
        schema: StructType | None = None,
        format: str | None = None,
        options: Mapping[str, Any] | None = None,
    ) -> DataFrame:
        """Read a table, a collection or a dataset."""
        store = self.endpoint(kind)
        if not name:
            raise ValueError(f"reading {kind} needs the name of a container or a path")
        if store.is_table_store:
            _unused(kind, schema=schema, format=format)
            options = dict(options or {})
            if name in store.splits and not options:
                column, parts = store.splits[name]
                options = {"partition_column": column, "num_partitions": parts, "by_depth": True}
            return tables.read_table(self.spark, store, name, **options)
        if store.is_database:
            _unused(kind, format=format)
            return documents.read_collection(self.spark, store, name, schema, options)
        return objects.read_dataset(
            self.spark, store.path(name), format or store.format,
            schema or store.schemas.get(name), {**store.options, **(options or {})},
        )

    def read_database(self, kind: str, name: str = LEDGER_CONTAINER) -> DataFrame:
        if kind not in DATABASES:
            raise ValueError(f"{kind!r} is not a database; use {', '.join(DATABASES)}")
        return self.read(kind, name)

    def read_storage(self, path: str, format: str | None = None, **more: Any) -> DataFrame:
        return self.read("s3", path, format=format, **more)

    def write(
        self,
        df: DataFrame,
        kind: str,
        name: str,
        mode: str | None = None,
        format: str | None = None,
        partition_by: str | Sequence[str] | None = None,
        output_filename: str | None = None,
        options: Mapping[str, Any] | None = None,
        staged: bool = False,
    ) -> int:
        """Write and return the rows written.

        Databases append and storages overwrite unless ``mode`` is given.
        """
        store = self.endpoint(kind)
        if not name:
            raise ValueError(f"writing {kind} needs the name of a container or a path")
        mode = mode or ("append" if store.is_database else "overwrite")
        if store.is_database:
            _unused(kind, format=format, partition_by=partition_by, output_filename=output_filename)
        if store.is_table_store:
            return tables.write_table(df, store, name, mode, staged=staged, **(options or {}))
        if store.is_database:
            return documents.write_collection(df, store, name, mode, options)
        return objects.write_dataset(
            df, store.path(name), format or store.format, mode, partition_by,
            {**store.options, **(options or {})}, output_filename,
        )

    def write_database(
        self, df: DataFrame, kind: str, name: str = LEDGER_CONTAINER, mode: str = "append"
    ) -> int:
        if kind not in DATABASES:
            raise ValueError(f"{kind!r} is not a database; use {', '.join(DATABASES)}")
        return self.write(df, kind, name, mode)

    def write_storage(self, df: DataFrame, path: str, **more: Any) -> int:
        return self.write(df, "s3", path, **more)

    def store_file(
        self,
        file: str,
        path: str,
        schema: StructType | None = None,
        options: Mapping[str, Any] | None = None,
        **more: Any,
    ) -> int:
        """Put a csv, json or parquet file that executors can read into storage."""
        return self.write_storage(objects.read_file(self.spark, file, schema, options), path, **more)

    # -- readiness -----------------------------------------------------------

    def count(self, kind: str, name: str = LEDGER_CONTAINER) -> int:
        """Rows of a container; a database table counts itself."""
        store = self.endpoint(kind)
        if store.is_table_store:
            return tables.count_rows(self.spark, store, name)
        if store.root and not path_exists(self.spark, store.path(name)):
            raise FileNotFoundError(f"no such folder: {store.path(name)}")
        # Counting needs no columns; naming one spares JSON the pass that infers them.
        schema = StructType().add("_id", "string") if store.format == "json" else None
        return self.read(kind, name, schema).count()

    def probe(self, kind: str, name: str = LEDGER_CONTAINER) -> None:
        """Fail unless the store can be reached; reads no rows.

        A store in a folder is reached when the folder exists, another when
        the container can be opened.
        """
        store = self.endpoint(kind)
        if not store.root:
            self.read(kind, name).schema
        elif not path_exists(self.spark, store.root):
            raise FileNotFoundError(f"no such folder: {store.root}")

    def readiness(self, wanted: Sequence[tuple[str, str]]) -> DataFrame:
        """(source, ok, row_count, error) for each (kind, container).

        One count per container; a failing one does not hide the others.
        """
        rows = []
        for kind, name in wanted:
            label = f"{kind}:{name}"
            try:
                rows.append((label, True, self.count(kind, name), None))
            except Exception as e:
                rows.append((label, False, None, _message(e)))
        return self.spark.createDataFrame(
            rows, "source string, ok boolean, row_count bigint, error string"
        )

    def require(self, *kinds: str) -> None:
        """Raise one error naming every store that cannot be reached.

        Without kinds, all stores are tried.
        """
        failures = []
        for kind in kinds or self._by_kind:
            try:
                self.probe(kind)
            except Exception as e:
                failures.append(f"{kind}: {_message(e)}")
        if failures:
            raise TransferError("stores not ready:\n" + "\n".join(failures))

    def require_ends(self, source: str, target: str) -> None:
        """Raise one error naming every end of a transfer that cannot be reached.

        The source must exist; a target in a folder may be made by the transfer,
        but its file system must answer. A relational database must accept a
        connection. A document store shows when its connector reads or writes.
        """
        failures = []
        for kind, is_target in ((source, False), (target, True)):
            store = self.endpoint(kind)
            try:
                if store.root and is_target:
                    path_exists(self.spark, store.root)
                elif store.root:
                    self.probe(kind)
                elif store.is_table_store:
                    tables.reach(self.spark, store)
            except Exception as e:
                failures.append(f"{kind}: {_message(e)}")
        if failures:
            raise TransferError("stores not ready:\n" + "\n".join(failures))

    # -- transfers -----------------------------------------------------------

    def transfer(
        self,
        source: str,
        source_name: str,
        target: str,
        target_name: str,
        mode: str | None = None,
        source_schema: StructType | None = None,
        source_format: str | None = None,
        source_options: Mapping[str, Any] | None = None,
        verify: bool = False,
        **write_options: Any,
    ) -> Transferred:
        """Copy a container from any store to any store.

        An empty source is an error and leaves the target alone. The source is
        read once; the row count comes from the write. With ``verify``, which needs
        a target that is overwritten, both ends are read again and their content
        compared; where it differs, the error names the differing buckets.
        """
        store = self.endpoint(target)
        if verify and (mode or ("append" if store.is_database else "overwrite")) != "overwrite":
            raise ValueError("only a target that is overwritten can be verified")
        self.require_ends(source, target)
        df = self.read(source, source_name, source_schema, source_format, source_options)
        if df.isEmpty():
            raise TransferError(f"{source} {source_name} holds no rows to move")
        rows = self.write(df, target, target_name, mode, **write_options)
        if verify:
            if store.is_table_store:
                df = drop_surrogate_key(df)
            named = target_name
            if write_options.get("output_filename"):
                named = f"{target_name.rstrip('/')}/{write_options['output_filename']}"
            format = write_options.get("format")
            schema = df.schema if (format or store.format) in ("json", "csv") else None
            require_same(df, self.read(target, named, schema, format), f"{target} {target_name}")
        return Transferred(True, rows, source, target)

    @_tidy
    def transfer_users(
        self,
        target: str,
        source_name: str,
        target_name: str,
        mode: str = "overwrite",
        source: str = "s3",
        order_by: str | None = None,
        source_format: str | None = None,
        check_table_limits: bool = True,
        refused_to: str | None = None,
    ) -> UsersTransferred:
        """Validate raw users from storage and write the valid ones.

        The raw rows are counted (for Parquet from file footers) and read once
        in full; text sources are staged for that, so that they are read once and
        what is counted is what is validated. The valid rows are staged, so the
        target is touched only when there is something to write, and everything
        after reads the stage. Valid rows that a relational user table has no room
        for are added to the storage dataset ``refused_to``, by default ``refused/``
        and the target's name. In append mode, users whose e-mail the target has are
        left out and counted.
        """
        if target not in DATABASES:
            raise ValueError(f"{target!r} is not a database; use {', '.join(DATABASES)}")
        self.require_ends(source, target)
        raw = self.read(source, source_name, format=source_format)
        if (source_format or self.endpoint(source).format) in TEXT_FORMATS:
            wanted = [c for c in raw.columns if c in RAW_USER.fieldNames() or c == order_by]
            raw = stage(raw.select(*map(name, wanted)), "raw").rows
        total = raw.count()
        if total == 0:
            raise TransferError(f"{source_name} holds no rows to move")
        copy = stage(validate_all(raw, order_by=order_by), "users")
        rows, valid, refused = copy.rows, copy.rows.count(), 0
        if valid == 0:
            raise TransferError("validation leaves no rows to write")
        table = target == "postgresql"
        if table and check_table_limits:
            fits = F.coalesce(fits_user_table(), F.lit(False))
            refused = rows.filter(~fits).count()
            if refused:
                refused_to = refused_to or f"refused/{target_name}"
                self.write(rows.filter(~fits), source, refused_to, "append")
                rows = rows.filter(fits)
        known = 0
        if mode == "append":
            fresh = stage(self._without_known(rows, target, target_name), "fresh").rows
            known = rows.count() - fresh.count()
            rows = fresh
        if self.endpoint(target).is_table_store:
            types = {c: f"VARCHAR({n})" for c, n in USER_TABLE_LENGTHS.items()}
            written = self.write(
                rows, target, target_name, mode, options={"column_types": types}, staged=True
            )
        else:
            written = self.write(rows, target, target_name, mode)
        return UsersTransferred(
            total, valid, total - valid, written, source, target, refused, refused_to if refused else None, known
        )

    def _without_known(self, users: DataFrame, kind: str, container: str) -> DataFrame:
        """``users`` (staged, an e-mail once) without those whose e-mail a container has.

        The container is cut to the e-mails in question first: by a broadcast of
        them, their size having been measured, or else by a join on the shuffle that
        spreads e-mails the container has very often.
        """
        store = self.endpoint(kind)
        if store.is_table_store:
            there = tables.table_exists(self.spark, store, container)
        else:
            there = not store.root or path_exists(self.spark, store.path(container))
        if not there:
            return users
        asked = users.select("email")
        schema = None if store.is_table_store else StructType().add("email", "string")
        held = self.read(kind, container, schema).select("email")
        if broadcastable(*measure(asked, "email")):
            held = held.join(F.broadcast(asked), "email", "left_semi")
        else:
            held = match(held, asked, "email", "left_semi", hot_keys(held, "email"))
        known = stage(held.distinct(), "known").rows
        if broadcastable(*measure(known, "email")):
            return users.join(F.broadcast(known), "email", "left_anti").select(*users.columns)
        return match(users, known, "email", "left_anti")

    # -- the ledger in a store -----------------------------------------------

    def read_ledger(self, kind: str, name: str = LEDGER_CONTAINER) -> DataFrame:
        """The ledger in a store, or an empty one where there is none yet."""
        store = self.endpoint(kind)
        if store.root and not path_exists(self.spark, store.path(name)):
            return self.spark.createDataFrame([], store.schemas.get(name, LEDGER))
        return self.read(kind, name)

    def _keyed(self, kind: str, name: str) -> layouts.Layout | None:
        store = self.endpoint(kind)
        return keyed.keyed_layout(self.spark, store.path(name)) if store.root else None

    @_tidy
    def key_ledger(self, kind: str, name: str = LEDGER_CONTAINER, buckets: int | None = None) -> int:
        """Spread the ledger in a folder store by key, over ``buckets`` folders.

        From then on moving keys rewrites only the folders these keys lie in.
        """
        store = self.endpoint(kind)
        if not store.root:
            raise ValueError(f"{kind} keeps no ledger in a folder")
        copy = stage(self.read_ledger(kind, name), "ledger")
        try:
            return keyed.write_keyed(copy.rows, store.path(name), store.format, "db", buckets)
        except Exception as e:
            raise TransferError(f"{kind} {name} not replaced; the rows are in {copy.path}") from e

    def _replace_keys(
        self, kind: str, name: str, keys: DataFrame, moved: Callable[[DataFrame], ledgers.Moved]
    ) -> int | None:
        """Where a store can replace the rows of some keys alone, do so, else None.

        Gives the rows written to folders, of a table the rows it then has.
        """
        store = self.endpoint(kind)
        layout = self._keyed(kind, name)
        if layout is not None:
            keys = stage(ledgers.distinct_keys(keys), "keys").rows
            folders = keyed.touched(keys, layout)
            there = keyed.read_keyed(self.spark, store.path(name), store.format, folders)
            return keyed.replace_buckets(moved(there).into(there), store.path(name), store.format, folders)
        if store.is_table_store:
            rows = moved(self.read_ledger(kind, name)).rows
            tables.replace_rows(rows, store, name, "db", ("test_version", "updated_at"))
            return tables.count_rows(self.spark, store, name)
        return None

    def latest_version(
        self, kind: str, key: str, name: str = LEDGER_CONTAINER
    ) -> float | None:
        """The highest version of one key, or None; the store filters by key."""
        rows = ledgers.of_key(self.read_ledger(kind, name), key)
        return rows.agg(F.max("test_version")).first()[0]

    @_tidy
    def create_versions(
        self,
        kind: str,
        keys: DataFrame,
        version: float = FIRST_VERSION,
        name: str = LEDGER_CONTAINER,
        as_of: ledgers.AsOf = None,
    ) -> int:
        """Append a first row for each key."""
        like = self.read_ledger(kind, name)
        rows = ledgers.new_rows(keys, like, version, as_of)
        if self._keyed(kind, name) is not None:
            store = self.endpoint(kind)
            return keyed.append_keyed(rows, store.path(name), store.format)
        return self.write(rows, kind, name, "append")

    @_tidy
    def bump_versions(
        self,
        kind: str,
        keys: DataFrame | None = None,
        new_version: float | None = None,
        name: str = LEDGER_CONTAINER,
        as_of: ledgers.AsOf = None,
        tie_break: str | None = None,
    ) -> int:
        """Move keys of a store's ledger on, or set them to ``new_version``.

        Returns the rows written, for a table the rows it then has. With ``keys``, a
        keyed ledger (``key_ledger``) has only their folders rewritten, and a table gets
        their rows appended and the superseded ones deleted; other ledgers are replaced
        as a whole.
        """
        if keys is not None:
            written = self._replace_keys(
                kind, name, keys, lambda rows: ledgers.bumped_rows(rows, keys, new_version, as_of, tie_break)
            )
            if written is not None:
                return written
        moved = ledgers.bump(self.read_ledger(kind, name), keys, new_version, as_of, tie_break)
        return self.write_ledger(moved, kind, name)

    @_tidy
    def compact_ledger(
        self, kind: str, name: str = LEDGER_CONTAINER, tie_break: str | None = None
    ) -> int:
        """Keep only the most recently updated row of each key.

        Of a keyed ledger only folders with a key of several rows are rewritten.
        """
        layout = self._keyed(kind, name)
        if layout is not None:
            store = self.endpoint(kind)
            several = self.read_ledger(kind, name).groupBy("db").count().where("count > 1")
            folders = keyed.touched(several, layout)
            there = keyed.read_keyed(self.spark, store.path(name), store.format, folders)
            return keyed.replace_buckets(ledgers.compact(there, tie_break), store.path(name), store.format, folders)
        return self.write_ledger(ledgers.compact(self.read_ledger(kind, name), tie_break), kind, name)

    @_tidy
    def write_ledger(self, df: DataFrame, kind: str, name: str = LEDGER_CONTAINER) -> int:
        """Replace the ledger in a store with rows computed from it.

        The new ledger is complete in scratch before the old one is touched,
        and stays there if the store fails on the way. A keyed ledger stays keyed.
        """
        layout = self._keyed(kind, name)
        copy = stage(df, "ledger")
        store = self.endpoint(kind)
        try:
            if layout is not None:
                return keyed.write_keyed(copy.rows, store.path(name), store.format, "db", layout.buckets)
            rows = self.write(copy.rows, kind, name, "overwrite", staged=store.is_table_store)
        except Exception as e:
            raise TransferError(f"{kind} {name} not replaced; the rows are in {copy.path}") from e
        return rows

    @_tidy
    def transfer_versions(
        self,
        source: str,
        target: str,
        keys: DataFrame | None = None,
        source_name: str = LEDGER_CONTAINER,
        target_name: str = LEDGER_CONTAINER,
        as_of: ledgers.AsOf = None,
        tie_break: str | None = None,
    ) -> int:
        """Set keys of the target's ledger to the source's versions.

        The key is the kind of the source unless ``keys`` are given.
        """
        for kind in (source, target):
            if kind not in DATABASES:
                raise ValueError(f"{kind!r} keeps no ledger; use {', '.join(DATABASES)}")
        self.require(source, target)
        if keys is None:
            keys = self.spark.createDataFrame([(source,)], "db string")
        given = self.read_ledger(source, source_name)
        written = self._replace_keys(
            target, target_name, keys, lambda rows: ledgers.handed_rows(given, rows, keys, as_of, tie_break)
        )
        if written is not None:
            return written
        moved = ledgers.transfer_versions(given, self.read_ledger(target, target_name), keys, as_of, tie_break)
        return self.write_ledger(moved, target, target_name)


def _unused(kind: str, **given: Any) -> None:
    """Refuse what this kind of store would ignore."""
    ignored = [k for k, v in given.items() if v is not None]
    if ignored:
        raise ValueError(f"{kind} does not use {', '.join(ignored)}")


def _message(e: Exception) -> str:
    """The first line of an error that says something."""
    cause = getattr(e, "java_exception", None)
    text = str(cause.getMessage() if cause is not None else e).strip()
    return text.splitlines()[0] if text else type(e).__name__
