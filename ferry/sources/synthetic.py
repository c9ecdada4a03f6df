"""Generated user records and the literal ledger documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ferry.fixed_values import (
    FIRST_NAMES,
    GENDERS,
    INVALID_EMAIL_DOMAINS,
    LAST_NAMES,
    LITERAL_LEDGER_DOCUMENTS,
    SYNTHETIC_ROWS,
    USER_MIX,
    VALID_EMAIL_DOMAIN,
    VALID_PHONE_PREFIXES,
)
from ferry.functions.draws import digest, draw, pick
from ferry.schemas import LEDGER_DOCUMENT

# Which part of which digest decides what.
KIND, FIRST, LAST, SIDE = range(4)  # digest 0, also drawn for an earlier id
GENDER, DOMAIN, EARLIER, PREFIX = range(4)  # digest 1
DIGITS, FAULT, TENTH = range(3)  # digest 2


def _is_kind(roll: Column, name: str) -> Column:
    """Whether a draw from 0 to 99 falls into the share of this kind."""
    kinds = list(USER_MIX)
    at = kinds.index(name)
    low = sum(USER_MIX[k] for k in kinds[:at])
    return (roll >= low) & (roll < low + USER_MIX[name])


# Six ways for a phone number to be wrong; none of them fits the rule: a wrong
# prefix, eight digits, nine digits, eleven digits, letters, another prefix.
BAD_PREFIXES = ["01", "", "", "06", "abc", "07"]


def _bad_phone(numbers: Column, eight: Column) -> Column:
    fault = draw(numbers, FAULT, len(BAD_PREFIXES))
    return F.concat(
        pick(numbers, FAULT, BAD_PREFIXES),
        F.substring(eight, F.lit(1), F.when(fault == 4, 7).otherwise(8)),
        F.when(fault.isin(2, 3), draw(numbers, TENTH, 10).cast("string")).otherwise(""),
    )


def users_for(ids: DataFrame, id_column: str, seed: int = 0) -> DataFrame:
    """One user record per row of ``ids``, some of them faulty on purpose.

    About 70 % are valid, 10 % have a wrong email domain, 10 % a wrong phone,
    5 % lack a name and 5 % repeat the address of an earlier id. Every value is
    drawn from the row's id: a repeating row draws an earlier id and recomputes
    that id's address, so nothing is joined, collected or kept between rows.
    Ids are whole numbers from 0 on.
    """
    c = F.col
    key, roll = c("id"), c("roll")
    rows = (
        ids.select(c(id_column).cast("bigint").alias("id"))
        .withColumns({n: digest(key, i, seed) for i, n in enumerate(("person", "choices", "numbers"))})
        .withColumn("roll", draw(c("person"), KIND, 100))
        .withColumn(
            "earlier",
            F.when(_is_kind(roll, "duplicate_email") & (key > 0), draw(c("choices"), EARLIER, key)),
        )
        .withColumn("other", F.when(c("earlier").isNotNull(), digest(c("earlier"), 0, seed)))
        .withColumn("other_roll", draw(c("other"), KIND, 100))
    )
    # Whose address it is: the earlier id's where that one has a good address.
    repeats = ~_is_kind(c("other_roll"), "invalid_email") & ~_is_kind(c("other_roll"), "duplicate_email")
    rows = rows.select(
        "choices",
        "numbers",
        roll,
        F.when(repeats, c("earlier")).otherwise(key).alias("of"),
        F.when(repeats, c("other_roll")).otherwise(roll).alias("of_roll"),
        *[pick(c("person"), part, names).alias(n)
          for n, part, names in (("first", FIRST, FIRST_NAMES), ("last", LAST, LAST_NAMES))],
        (draw(c("person"), SIDE, 2) == 0).alias("no_first"),
        F.when(repeats, c("other")).otherwise(c("person")).alias("of_person"),
    )
    missing, of_missing = _is_kind(roll, "missing_name"), _is_kind(c("of_roll"), "missing_name")
    of_no_first = draw(c("of_person"), SIDE, 2) == 0
    eight = (draw(c("numbers"), DIGITS, 90_000_000) + 10_000_000).cast("string")
    return rows.select(
        F.when(~(missing & c("no_first")), c("first")).alias("first_name"),
        F.when(missing & ~c("no_first"), "").otherwise(c("last")).alias("last_name"),
        F.concat(
            F.when(of_missing & of_no_first, "user").otherwise(
                F.lower(pick(c("of_person"), FIRST, FIRST_NAMES))
            ),
            F.lit("."),
            F.when(of_missing & ~of_no_first, "test").otherwise(
                F.lower(pick(c("of_person"), LAST, LAST_NAMES))
            ),
            c("of").cast("string"),
            F.lit("@"),
            F.when(
                _is_kind(roll, "invalid_email"), pick(c("choices"), DOMAIN, INVALID_EMAIL_DOMAINS)
            ).otherwise(VALID_EMAIL_DOMAIN),
        ).alias("email"),
        F.when(_is_kind(roll, "invalid_phone"), _bad_phone(c("numbers"), eight))
        .otherwise(F.concat(pick(c("choices"), PREFIX, VALID_PHONE_PREFIXES), eight))
        .alias("phone"),
        pick(c("choices"), GENDER, GENDERS).alias("gender"),
    )


def users(spark: SparkSession, rows: int = SYNTHETIC_ROWS, seed: int = 0) -> DataFrame:
    """Synthetic users with ids 0 to ``rows`` - 1."""
    return users_for(spark.range(rows), "id", seed)


def literal_documents(spark: SparkSession) -> DataFrame:
    """The three literal ledger documents, of a size the optimizer knows."""
    rows = [
        F.struct(*[F.lit(d[f.name]).cast(f.dataType).alias(f.name) for f in LEDGER_DOCUMENT])
        for d in LITERAL_LEDGER_DOCUMENTS
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))
