"""The version ledger: many keys at a time instead of one per call.

A ledger is a DataFrame with at least (db, test_version, created_at,
updated_at). Further columns, such as an id, travel with their row. Per-key
choices are ``max`` over a struct, so each task reduces a key to one row before
the shuffle however many rows that key has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, MapType, StringType, TimestampType, VariantType

from ferry.fixed_values import FIRST_VERSION
from ferry.functions.rules import next_version, version_or_first
from ferry.operators.matching import (
    broadcastable,
    holds,
    hot_keys,
    hottest,
    match,
    measure,
    name,
    places_for,
)
from ferry.sources.scratch import materialize

AsOf = str | datetime | None

# Up to this many keys, and bytes of them, become a filter.
FILTER_KEYS = 1000
FILTER_BYTES = 64 * 1024


# How string ledgers keep times: UTC, in milliseconds.
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _utc(as_of: str | datetime) -> str:
    """``as_of`` in UTC; without a zone it is UTC already."""
    if isinstance(as_of, str):
        try:
            as_of = datetime.fromisoformat(as_of)
        except ValueError:
            return as_of
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return str(as_of)


def _moment(as_of: AsOf, kind: DataType) -> Column:
    """``as_of`` (default: now), in UTC, in the type the ledger keeps its times in."""
    if as_of is None:
        now = F.current_timestamp()
        if isinstance(kind, TimestampType):
            return now
        moment = F.to_utc_timestamp(now, F.current_timezone()).cast("timestamp_ntz")
    else:
        moment = F.lit(_utc(as_of)).cast("timestamp_ntz")
    if isinstance(kind, StringType):  # rounded up, so never before a finer time already kept
        return F.date_format(moment + F.expr("INTERVAL '0.000999' SECOND"), STAMP)
    if isinstance(kind, TimestampType):  # the same instant in any session zone
        return F.from_utc_timestamp(moment.cast("timestamp"), F.current_timezone())
    return moment.cast(kind)


def _sortable(kind: DataType) -> bool:
    return not holds(kind, MapType, VariantType)


def _top_row(ledger: DataFrame, order: list[str], count_as: str | None = None) -> DataFrame:
    """The greatest row of each key by ``order``, then by the other columns.

    Times kept as text are ordered as times. Columns without an order, such as
    maps, travel with their row.
    """
    kinds = {f.name: f.dataType for f in ledger.schema}
    rest = [c for c in ledger.columns if c != "db" and c not in order]
    times = [
        F.try_to_timestamp(name(c)).alias(f"_time_{i}")
        for i, c in enumerate(order)
        if c in ("created_at", "updated_at") and isinstance(kinds[c], StringType)
    ]
    ranked, ordered = [], [*[name(c) for c in order], *[name(c) for c in rest if _sortable(kinds[c])]]
    if times:  # a time goes before its text, which stays in the struct to be given back
        first = order[: order.index("updated_at")] if "updated_at" in order else []
        ranked = [*[name(c).alias(f"_first_{i}") for i, c in enumerate(first)], *times]
    rank = F.struct(*ranked, *ordered)
    carried = [c for c in rest if not _sortable(kinds[c])]
    found = [F.max(rank).alias("_top")]
    if carried:
        found.append(F.max_by(F.struct(*[name(c) for c in carried]), rank).alias("_carried"))
    if count_as:
        found.append(F.count(F.lit(1)).alias(count_as))
    return ledger.groupBy("db").agg(*found).select(
        *[
            F.col("db") if c == "db" else F.col("_carried" if c in carried else "_top")[c].alias(c)
            for c in ledger.columns
        ],
        *([count_as] if count_as else []),
    )


def _checked(rows: DataFrame) -> DataFrame:
    """The rows; a NULL key among them is an error, as it would match nothing."""
    refusal = F.raise_error(F.lit("a ledger key is NULL")).cast("string")
    return rows.withColumn("db", F.coalesce(F.col("db"), refusal))


def distinct_keys(keys: DataFrame) -> DataFrame:
    """The keys, once each."""
    return _checked(keys.select("db")).distinct()


class Asked(NamedTuple):
    """Distinct keys, staged: computed once, counted and measured."""

    rows: DataFrame
    count: int
    size: int

    @property
    def few(self) -> bool:
        return self.count <= FILTER_KEYS and self.size <= FILTER_BYTES

    @property
    def small(self) -> bool:
        return self.few or broadcastable(self.count, self.size)


def _asked(keys: DataFrame) -> Asked:
    rows = materialize(distinct_keys(keys), "keys")
    return Asked(rows, *measure(rows, "db"))


def _narrowed(ledger: DataFrame, asked: Asked) -> DataFrame:
    """The ledger's rows of few or a small number of keys, without a shuffle.

    A handful becomes an IN filter, which a database or Parquet reader applies
    itself; more are broadcast, their size having been measured.
    """
    if asked.few:
        return ledger.filter(F.col("db").isin([r["db"] for r in asked.rows.collect()]))
    return ledger.join(F.broadcast(asked.rows), "db", "left_semi").select(*ledger.columns)


def _about(ledger: DataFrame, asked: Asked) -> DataFrame:
    """The ledger, narrowed to the asked keys where that takes no shuffle."""
    return _narrowed(ledger, asked) if asked.small else ledger


def _best(
    ledger: DataFrame, asked: Asked, tie_break: str | None
) -> tuple[DataFrame, list[str] | None]:
    """Rows of the highest versions of at least the asked keys, and hot keys.

    Where the whole ledger is gone over, rows are counted in the same pass.
    """
    if asked.small:
        return latest_version(_narrowed(ledger, asked), tie_break), None
    counted = materialize(_top_row(ledger, _by_version(tie_break), "_rows"), "best")
    return counted.drop("_rows"), hottest(counted, "db", "_rows", places_for(ledger))


def of_key(ledger: DataFrame, key: str | None) -> DataFrame:
    """Rows of one key; the filter reaches the store. NULL matches nothing."""
    return ledger.filter(F.col("db") == F.lit(key))


def of_keys(ledger: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is among ``keys``."""
    asked = _asked(keys)
    if asked.small:
        return _narrowed(ledger, asked)
    return match(ledger, asked.rows, "db", "left_semi", hot_keys(ledger, "db"))


def _by_version(tie_break: str | None) -> list[str]:
    return ["test_version", "updated_at"] + ([tie_break] if tie_break else [])


def latest_version(ledger: DataFrame, tie_break: str | None = None) -> DataFrame:
    """Per key the row with the highest version.

    Equal versions go to the latest update, then to the highest ``tie_break``.
    """
    return _top_row(ledger, _by_version(tie_break))


def highest_versions(ledger: DataFrame) -> DataFrame:
    """(db, test_version) only: a hash aggregate over two columns."""
    return ledger.groupBy("db").agg(F.max("test_version").alias("test_version"))


def latest_version_or_zero(ledger: DataFrame, keys: DataFrame) -> DataFrame:
    """For every asked key its highest version, or 0 where it has none."""
    asked = _asked(keys)
    return asked.rows.join(highest_versions(_about(ledger, asked)), "db", "left").select(
        "db", F.coalesce("test_version", F.lit(0.0)).alias("test_version")
    )


def compact(ledger: DataFrame, tie_break: str | None = None) -> DataFrame:
    """Per key only the most recently updated row."""
    return _top_row(ledger, ["updated_at"] + ([tie_break] if tie_break else []))


def new_rows(
    keys: DataFrame,
    like: DataFrame,
    version: float = FIRST_VERSION,
    as_of: AsOf = None,
) -> DataFrame:
    """First rows for keys, in the columns of ``like``."""
    made = {
        "db": F.col("db"),
        "test_version": F.lit(float(version)),
        "created_at": _moment(as_of, like.schema["created_at"].dataType),
        "updated_at": _moment(as_of, like.schema["updated_at"].dataType),
    }
    return distinct_keys(keys).select(
        *[
            made.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
            for f in like.schema.fields
        ]
    )


def create(
    ledger: DataFrame,
    keys: DataFrame,
    version: float = FIRST_VERSION,
    as_of: AsOf = None,
) -> DataFrame:
    """The ledger with one further row per key."""
    return ledger.unionByName(new_rows(keys, ledger, version, as_of))


def replace_by_key(
    target: DataFrame, updates: DataFrame, key: str, hot: Sequence[Any] | None = None
) -> DataFrame:
    """Rows of ``target`` whose key is not in ``updates``, and the updates.

    ``updates`` is read several times, so pass something staged. Small updates
    are broadcast, their size having been measured, and the target is not
    shuffled. Otherwise hot keys of the target are spread over many tasks; they
    are counted unless ``hot`` names them (empty for a key without repeats).
    """
    small = broadcastable(*measure(updates, key))
    return _replace(target, updates, key, small, hot)


def _replace(
    target: DataFrame, updates: DataFrame, key: str, small: bool, hot: Sequence[Any] | None
) -> DataFrame:
    names = updates.select(key)
    if small:
        kept = target.join(F.broadcast(names), key, "left_anti").select(*target.columns)
    else:
        hot = hot_keys(target, key) if hot is None else hot
        kept = match(target, names, key, "left_anti", hot)
    return kept.unionByName(updates)


def _with_versions(rows: DataFrame, version: Column, as_of: AsOf, like: DataFrame) -> DataFrame:
    """Rows keyed by db, with columns of ``like`` present or NULL, moved on to ``version``."""
    created = _moment(as_of, like.schema["created_at"].dataType)
    updated = _moment(as_of, like.schema["updated_at"].dataType)
    made = {
        "test_version": version,
        "created_at": F.coalesce(F.col("created_at"), created),
        "updated_at": updated,
    }
    return rows.select(*[made.get(c, F.col(c)).alias(c) for c in like.columns])


class Moved(NamedTuple):
    """New rows of some keys, staged: one per key."""

    rows: DataFrame
    small: bool
    hot: list[str] | None = None

    def into(self, ledger: DataFrame) -> DataFrame:
        """``ledger`` with these rows in place of all rows of their keys."""
        return _replace(ledger, self.rows, "db", self.small, self.hot)


def bumped_rows(
    ledger: DataFrame,
    keys: DataFrame,
    new_version: float | None = None,
    as_of: AsOf = None,
    tie_break: str | None = None,
) -> Moved:
    """The rows that ``bump`` gives ``keys``; ``ledger`` may be cut to what holds the keys."""
    asked = _asked(keys)
    best, hot = _best(ledger, asked, tie_break)
    version = _step(new_version)
    moved = _with_versions(asked.rows.join(best, "db", "left"), version, as_of, ledger)
    return Moved(materialize(moved), asked.small, hot)


def _step(new_version: float | None) -> Column:
    if new_version is not None:
        return F.lit(float(new_version))
    return F.coalesce(next_version("test_version"), F.lit(FIRST_VERSION))


def bump(
    ledger: DataFrame,
    keys: DataFrame | None = None,
    new_version: float | None = None,
    as_of: AsOf = None,
    tie_break: str | None = None,
) -> DataFrame:
    """Move keys one version on, or set them to ``new_version`` (0.0 counts).

    An absent key starts at ``new_version`` or 1.0. ``created_at`` and any id
    stay those of the highest version; only the new row of a key remains.
    Without ``keys`` every key moves and the result is one aggregate.
    """
    if keys is None:
        best = latest_version(_checked(ledger), tie_break)
        return _with_versions(best, _step(new_version), as_of, ledger)
    return bumped_rows(ledger, keys, new_version, as_of, tie_break).into(ledger)


def _given(rows: DataFrame) -> DataFrame:
    return highest_versions(rows).withColumnRenamed("test_version", "_given")


def handed_rows(
    source: DataFrame,
    target: DataFrame,
    keys: DataFrame,
    as_of: AsOf = None,
    tie_break: str | None = None,
) -> Moved:
    """The rows that ``transfer_versions`` gives ``keys`` in the target."""
    asked = _asked(keys)
    best, hot = _best(target, asked, tie_break)
    handed = asked.rows.join(_given(_about(source, asked)), "db", "left").join(best, "db", "left")
    moved = _with_versions(handed, version_or_first("_given"), as_of, target)
    return Moved(materialize(moved), asked.small, hot)


def transfer_versions(
    source: DataFrame,
    target: DataFrame,
    keys: DataFrame | None = None,
    as_of: AsOf = None,
    tie_break: str | None = None,
) -> DataFrame:
    """The target ledger after setting its keys to the source's versions.

    A key the source lacks, or holds at 0.0, is set to 1.0. Without ``keys``
    all keys of the source are handed over.
    """
    if keys is not None:
        return handed_rows(source, target, keys, as_of, tie_break).into(target)
    best = latest_version(target, tie_break)
    handed = _given(_checked(source)).join(best, "db", "left")
    moved = materialize(_with_versions(handed, version_or_first("_given"), as_of, target))
    return replace_by_key(target, moved, "db")
