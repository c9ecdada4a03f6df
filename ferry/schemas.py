"""Schemas by name, and the limits of the relational user table."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ferry.fixed_values import GENDERS, USER_COLUMNS, USER_TABLE_LENGTHS

RAW_USER = StructType([StructField(c, StringType(), True) for c in USER_COLUMNS])

USER = StructType([StructField("id", IntegerType(), False), *RAW_USER.fields])

LEDGER = StructType(
    [
        StructField("db", StringType(), False),
        StructField("test_version", DoubleType(), False),
        StructField("created_at", TimestampType(), False),
        StructField("updated_at", TimestampType(), False),
    ]
)

LEDGER_DOCUMENT = StructType(
    [
        StructField("_id", StringType(), True),
        StructField("created_at", StringType(), True),
        StructField("db", StringType(), True),
        StructField("test_version", DoubleType(), True),
        StructField("updated_at", StringType(), True),
    ]
)

_BY_NAME = {"raw_valid_data_user": RAW_USER, "db_connect": LEDGER, "user": USER}


def schema_by_name(name: str) -> StructType:
    """The registered schema called ``name``; unknown names are a ValueError."""
    try:
        return _BY_NAME[name]
    except KeyError:
        raise ValueError(
            f"no schema named {name!r}; known: {', '.join(_BY_NAME)}"
        ) from None


def user_column_types() -> str:
    """``createTableColumnTypes`` for the relational user table."""
    return ", ".join(f"{c} VARCHAR({n})" for c, n in USER_TABLE_LENGTHS.items())


def fits_user_table() -> Column:
    """True for rows the user table accepts.

    NULL passes both the length limits and the gender check, as in SQL.
    """
    ok = F.col("gender").isNull() | F.col("gender").isin(*GENDERS)
    for name, limit in USER_TABLE_LENGTHS.items():
        ok = ok & (F.col(name).isNull() | (F.length(name) <= limit))
    return ok
