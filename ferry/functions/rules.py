"""Record rules as Column expressions; all run inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ferry.fixed_values import (
    EMAIL_PATTERN,
    FIRST_VERSION,
    PHONE_PATTERN,
    VERSION_STEP,
)


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_email(c: Column | str = "email", pattern: str = EMAIL_PATTERN) -> Column:
    return _column(c).rlike(pattern)


def valid_phone(c: Column | str = "phone", pattern: str = PHONE_PATTERN) -> Column:
    return _column(c).rlike(pattern)


def nonblank(c: Column | str) -> Column:
    """Neither NULL nor only spaces (a tab is not a space here)."""
    c = _column(c)
    return c.isNotNull() & (F.trim(c) != "")


def valid_user() -> Column:
    """The row rule: address, both names and phone. Gender is not looked at."""
    return (
        valid_email("email")
        & nonblank("first_name")
        & nonblank("last_name")
        & valid_phone("phone")
    )


def next_version(c: Column | str) -> Column:
    """One step up, rounded half-even to one decimal; 9.9 gives 10.0."""
    return F.bround(_column(c) + F.lit(VERSION_STEP), 1)


def version_or_first(c: Column | str) -> Column:
    """The version to hand over: a missing or zero version becomes the first."""
    c = _column(c)
    return F.when(c.isNull() | (c == 0.0), F.lit(FIRST_VERSION)).otherwise(c)
