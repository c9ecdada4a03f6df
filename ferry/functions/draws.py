"""Repeatable pseudo-random draws from a row's own key.

A draw depends only on (seed, key), never on partitioning or task order, so a
lost task that is run again yields the same rows. md5 is used because any SQL
engine can recompute it. One digest serves four draws; keep it in a column so
that it is computed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def digest(key: Column, block: int, seed: int = 0) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{block}:"), key.cast("string")))


def draw(digest: Column, part: int, n: int | Column) -> Column:
    """An integer in [0, n) from one of the four parts of a digest."""
    value = F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("bigint")
    return value % (F.lit(n) if isinstance(n, int) else n)


def pick(digest: Column, part: int, values: list[str]) -> Column:
    """One of ``values``, chosen by a draw."""
    return F.element_at(
        F.array(*[F.lit(v) for v in values]),
        (draw(digest, part, len(values)) + 1).cast("int"),
    )
