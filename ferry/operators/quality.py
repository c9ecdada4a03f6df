"""Header repair, de-duplication and row validation of user records.

Everything here is lazy and reads column names from the plan only, so checking
headers costs no scan. ``validate_all`` is one plan with one shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ferry.fixed_values import REQUIRED_TO_VALIDATE, USER_COLUMNS
from ferry.functions.rules import valid_user


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _reject_repeated(df: DataFrame, names: Sequence[str]) -> None:
    wanted = {n.lower() for n in names}
    seen = Counter(c.lower() for c in df.columns)
    repeated = sorted(n for n in wanted if seen[n] > 1)
    if repeated:
        raise ValueError(f"columns occur more than once: {', '.join(repeated)}")


def headers_match(df: DataFrame, columns: Sequence[str] = USER_COLUMNS) -> bool:
    """Exactly these names, in this order, in this case."""
    _reject_repeated(df, columns)
    return df.columns == list(columns)


def conform_headers(
    df: DataFrame,
    columns: Sequence[str] = USER_COLUMNS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Drop other columns, add missing ones as NULL strings, put in order.

    Names are compared in their exact case: ``Email`` is not ``email``.
    ``keep`` names further columns to carry along after the others.
    """
    _reject_repeated(df, [*columns, *keep])
    present = set(df.columns)
    return df.select(
        *[
            _named(c) if c in present else F.lit(None).cast("string").alias(c)
            for c in columns
        ],
        *[_named(c) for c in keep],
    )


def dedup_email(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """One row per email; NULL emails form one group.

    The survivor is the row with the smallest ``order_by``, then the smallest
    remaining values, so the outcome does not depend on partitioning. It is a
    plain ``min`` over a struct: every task reduces each email to one row
    before the shuffle, and an email that fills a third of the table sends no
    more than one row per task. A filter on email moves below it.
    """
    if "email" not in df.columns:
        return df
    _reject_repeated(df, ["email"])
    others = [c for c in df.columns if c != "email"]
    if not others:
        return df.distinct()
    ordered = [order_by] if order_by else []
    ordered += [c for c in others if c != order_by]
    first = df.groupBy("email").agg(
        F.min(F.struct(*[_named(c) for c in ordered])).alias("_first")
    )
    return first.select(
        *[
            F.col("email") if c == "email" else F.col("_first")[c].alias(c)
            for c in df.columns
        ]
    )


def validate_rows(df: DataFrame) -> DataFrame:
    """Keep valid rows; a missing required column is an error."""
    missing = [c for c in REQUIRED_TO_VALIDATE if c not in df.columns]
    if missing:
        raise ValueError(f"columns the row rule needs are absent: {', '.join(missing)}")
    return df.filter(valid_user())


def validate_all(
    df: DataFrame, fix_headers: bool = True, order_by: str | None = None
) -> DataFrame:
    """Conform (or strictly check) headers, de-duplicate, then filter rows.

    De-duplication comes first: a valid row loses to an invalid earlier one of
    the same email. The email rule concerns the grouping key only, so the
    optimizer applies it before the shuffle without changing that.
    ``order_by`` chooses the survivor and is not part of the result.
    """
    if fix_headers:
        keep = [order_by] if order_by and order_by not in USER_COLUMNS else []
        conformed = conform_headers(df, keep=keep)
    else:
        keep = []
        if not headers_match(df.drop(order_by) if order_by else df):
            raise ValueError(
                f"headers are {df.columns}, expected {USER_COLUMNS}"
            )
        conformed = df
    return validate_rows(dedup_email(conformed, order_by)).select(*USER_COLUMNS)


def validation_summary(
    df: DataFrame, order_by: str | None = None
) -> DataFrame:
    """One row (total, valid, invalid); duplicates count as invalid.

    The total reads no columns at all; the valid count shuffles only rows
    whose email can still be valid.
    """
    total = df.agg(F.count(F.lit(1)).alias("total"), F.lit(0).cast("bigint").alias("valid"))
    valid = validate_all(df, order_by=order_by).agg(
        F.lit(0).cast("bigint").alias("total"), F.count(F.lit(1)).alias("valid")
    )
    return (
        total.unionByName(valid)
        .agg(F.sum("total").alias("total"), F.sum("valid").alias("valid"))
        .withColumn("invalid", F.col("total") - F.col("valid"))
    )


def drop_surrogate_key(df: DataFrame, name: str = "id") -> DataFrame:
    """Leave the generated key to the database."""
    return df.drop(name)
