"""Types for columns of text, such that every value comes back as it was written."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ferry.operators.matching import name

# Longer texts are no number, date or time.
LONGEST = 64
DECIMAL = r"^-?(?:0|[1-9][0-9]*)\.[0-9]+$"
MOST_DIGITS = 38
# Forms in which times with and without a zone are written.
ZONED_FORMS = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX")
LOCAL_FORMS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss",
)


class Form(NamedTuple):
    """A type, and how its values are written."""

    kind: str
    text: Callable[[Column], Column]

    def keeps(self, column: Column) -> Column:
        """Whether a text is read as this type and written as it was."""
        read = column.try_cast(self.kind)
        return F.coalesce(self.text(read) == column, F.lit(False))


def _plain(value: Column) -> Column:
    return value.cast("string")


def _as(pattern: str) -> Callable[[Column], Column]:
    return lambda value: F.date_format(value, pattern)


# From the narrowest to the widest; what fits none of them stays text.
FORMS = (
    Form("boolean", _plain),
    Form("int", _plain),
    Form("bigint", _plain),
    Form("double", _plain),
    Form("date", _plain),
    *(Form("timestamp", _as(p)) for p in ZONED_FORMS),
    *(Form("timestamp_ntz", _as(p)) for p in LOCAL_FORMS),
)


def _fits(column: Column, fits: Column) -> Column:
    """Whether a condition holds for all values; null where all values are."""
    short = F.coalesce(F.char_length(column) <= LONGEST, F.lit(True))
    return F.bool_and(F.when(column.isNotNull(), F.when(short, fits).otherwise(False)))


def column_types(texts: DataFrame) -> dict[str, str]:
    """For each text column the narrowest type that gives every value back, else string.

    One aggregate over ``texts``. A type is taken only if the text of what was read
    equals the text that stood there, so '007', '1e3', '+1' and '1.50' beside '1.5'
    stay text, and values of equal scale such as '1.50' are decimals. Times must all
    be in one of the forms above. A column of NULLs only, or of no rows, is text.
    """
    columns = [f.name for f in texts.schema if isinstance(f.dataType, StringType)]
    asked = []
    for i, column in enumerate(map(name, columns)):
        asked += [_fits(column, form.keeps(column)).alias(f"{i}_{j}") for j, form in enumerate(FORMS)]
        point = F.instr(column, ".")
        exact = column.rlike(DECIMAL) & ~column.rlike(r"^-[0.]+$")
        scale = F.char_length(column) - point
        asked += [
            _fits(column, exact).alias(f"{i}_exact"),
            F.min(scale).alias(f"{i}_least"),
            F.max(scale).alias(f"{i}_most"),
            F.max(point - 1).alias(f"{i}_before"),
        ]
    if not asked:
        return {}
    found = texts.agg(*asked).first().asDict()
    types = {}
    for i, column in enumerate(columns):
        kept = [form.kind for j, form in enumerate(FORMS) if found[f"{i}_{j}"]]
        scale, before = found[f"{i}_most"], found[f"{i}_before"]
        if not kept and found[f"{i}_exact"] and found[f"{i}_least"] == scale and before + scale <= MOST_DIGITS:
            kept = [f"decimal({before + scale},{scale})"]
        types[column] = kept[0] if kept else "string"
    return types


def typed(texts: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """``texts`` with its text columns in ``types``, by default their ``column_types``."""
    types = column_types(texts) if types is None else types
    return texts.select(*[name(c).cast(types.get(c, "string")).alias(c) if c in types else name(c) for c in texts.columns])
