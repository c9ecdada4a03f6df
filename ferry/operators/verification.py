"""Whether two tables hold the same rows, whatever their order, and where they differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType, VariantType

from ferry.operators.matching import holds, name
from ferry.sources.scratch import materialize

BUCKETS = 256


class ContentError(RuntimeError):
    """Two tables that should hold the same rows do not."""


def _as(found: DataFrame, expected: DataFrame) -> DataFrame:
    """``found`` in the columns and types of ``expected``; a missing column is an error."""
    missing = [c for c in expected.columns if c not in found.columns]
    if missing:
        raise ContentError(f"no column {', '.join(missing)}")
    return found.select(*[name(f.name).cast(f.dataType).alias(f.name) for f in expected.schema])


def _hash(df: DataFrame, seed: int) -> Column:
    """A hash of all columns; NULL differs from every value and keeps its place."""
    parts = []
    for f in df.schema:
        value = name(f.name)
        parts += [value.isNull(), F.to_json(F.struct(value)) if holds(f.dataType, MapType, VariantType) else value]
    return F.xxhash64(F.lit(seed), *parts)


def _hashed(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` with _h, _g and _bucket; two hashes tell rows apart by 128 bits."""
    hashed = df.withColumns({"_h": _hash(df, 1), "_g": _hash(df, 2)})
    return hashed.withColumn("_bucket", F.pmod(F.col("_h"), F.lit(buckets)).cast("int"))


def fingerprint(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, rows, total and mix: count, sum of a hash and exclusive or of another per bucket.

    None of them depends on the order of rows, and a row that is lost, doubled or
    changed shows in the count or the sum. Tasks reduce to a row per bucket before
    anything moves. An empty table has no buckets.
    """
    return _hashed(df, buckets).groupBy(F.col("_bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("_h").cast("decimal(38,0)")).alias("total"),
        F.bit_xor("_g").alias("mix"),
    )


def differing_buckets(expected: DataFrame, found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, expected_rows and found_rows of the buckets whose fingerprints differ.

    ``found`` is compared in the columns and types of ``expected``; its further
    columns are left out of account.
    """
    ours = fingerprint(expected, buckets).select("bucket", F.struct("rows", "total", "mix").alias("ours"))
    theirs = fingerprint(_as(found, expected), buckets).select("bucket", F.struct("rows", "total", "mix").alias("theirs"))
    return (
        ours.join(theirs, "bucket", "full")
        .where(~F.col("ours").eqNullSafe(F.col("theirs")))
        .select(
            "bucket",
            F.coalesce("ours.rows", F.lit(0)).alias("expected_rows"),
            F.coalesce("theirs.rows", F.lit(0)).alias("found_rows"),
        )
    )


def differences(expected: DataFrame, found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows that differ, with ``missing``: how often more a row is expected than found.

    Negative where a row is found more often than expected. Fingerprints come
    first; only rows of the buckets that differ, of which there are ``buckets`` at
    most, are shuffled, a row and its count for each different one of a task.
    """
    found = _as(found, expected)
    differing = [r["bucket"] for r in differing_buckets(expected, found, buckets).select("bucket").collect()]
    sides = [
        _hashed(side, buckets).where(F.col("_bucket").isin(differing)).withColumn("_sign", F.lit(sign))
        for side, sign in ((expected, 1), (found, -1))
    ]
    row = F.struct(*map(name, expected.columns))
    counted = sides[0].unionByName(sides[1]).groupBy("_h", "_g").agg(
        F.sum(F.col("_sign").cast("long")).alias("_missing"), F.any_value(row).alias("_row")
    )
    counted = counted.where("_missing <> 0")
    return counted.select(
        *[F.col("_row").getField(c).alias(c) for c in expected.columns], F.col("_missing").alias("missing")
    )


def require_same(expected: DataFrame, found: DataFrame, what: str, buckets: int = BUCKETS) -> None:
    """Raise ``ContentError`` naming the buckets and counts unless both hold the same rows."""
    wrong = materialize(differing_buckets(expected, found, buckets), "differing")
    total = wrong.agg(F.count(F.lit(1)), F.sum("expected_rows"), F.sum("found_rows")).first()
    if total[0]:
        some = ", ".join(str(r["bucket"]) for r in wrong.orderBy("bucket").limit(10).collect())
        raise ContentError(
            f"{what} differs in {total[0]} of {buckets} buckets ({some}{', ...' if total[0] > 10 else ''}): "
            f"{total[1]} rows expected there, {total[2]} found"
        )
