"""What each of several filters removes, in every order they can be applied in."""

from __future__ import annotations

import itertools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.words import attach, free_name, quoted, whole
from ferry.sources.scratch import materialize

# What stands between words here, and what filter D looks for.
BLANKS = r"[\x20\x09-\x0D]+"
SIGNS = r"[#$%&*|]"
LEAST_WORDS = 200
# All orders of the filters are tried: 5! = 120 of 5 steps, 6! = 720 of 6.
MOST_FILTERS = 6
SUMS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_filters(text: Column | str = "text") -> dict[str, Column]:
    """Failure conditions that need one text alone, by letter.

    A: under 200 words. B: 100 x distinct words < 50 x words. C: 100 x capitals
    A-Z > 3 x code points. D: holds any of # $ % & * |. Words lie between blanks;
    null text is empty text.
    """
    text = whole(text)
    words = F.array_remove(F.split(text, BLANKS), "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * capitals > 3 * F.char_length(text),
        "D": text.rlike(SIGNS),
    }


def _flags(labels: DataFrame, id_column: str) -> DataFrame:
    """id, good and toxic; of repeated labels of an id any counts."""
    any_of = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    return (
        labels.where(quoted(id_column).isNotNull())
        .groupBy(quoted(id_column).alias("id"))
        .agg(any_of("quality").alias("good"), any_of("toxic").alias("toxic"))
    )


def cells(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column] | None = None,
    part_column: str = "lang",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """part, mask and the long counts n, good and toxic of the documents there.

    Bit i of ``mask`` says that the document fails the i-th of ``filters``; the
    bit after them that a smaller id of the whole table has the same text. Texts
    are read once. Rows that share id, text and part are counted together before
    the labels are attached, and each text is reduced to a row per part and label
    before texts meet, so a text or id may hold any share of the rows.
    """
    filters = text_filters(quoted(text_column)) if filters is None else filters
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(filters.values())), F.lit(0))
    rows = docs.select(
        quoted(id_column).alias("id"),
        F.coalesce(quoted(part_column).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole(quoted(text_column)).cast("binary"), 256)).alias("sha"),
        mask.alias("mask"),
    )
    rows = materialize(rows.groupBy("id", "part", "sha", "mask").agg(F.count("*").alias("n")), "audited")
    rows = attach(rows, materialize(_flags(labels, id_column), "labels"), "id")
    held = F.when(F.col("id").isNotNull(), F.struct("id", "n"))
    texts = rows.groupBy(
        "sha", "part", "mask", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic"))
    ).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0)).alias("named"),
        F.min(held).alias("first"),
    )
    # A text has as many rows here as there are parts and labels.
    earliest = F.min("first.id").over(Window.partitionBy("sha"))
    texts = texts.withColumn("earliest", earliest)
    originals = F.when(F.col("first.id") == F.col("earliest"), F.col("first.n")).otherwise(0)
    copies = F.coalesce(F.col("named") - originals, F.lit(0))
    copy_bit = 1 << len(filters)
    split = F.array(
        F.struct(F.col("mask").alias("mask"), (F.col("n") - copies).alias("n")),
        F.struct((F.col("mask") + copy_bit).alias("mask"), copies.alias("n")),
    )
    counted = lambda c: F.sum(F.when(F.col(c), F.col("cell.n")).otherwise(0)).alias(c)
    return (
        texts.select("part", "good", "toxic", F.explode(split).alias("cell"))
        .where("cell.n > 0")
        .groupBy("part", F.col("cell.mask").alias("mask"))
        .agg(F.sum("cell.n").alias("n"), counted("good"), counted("toxic"))
    )


def _folded(orders: list[tuple[int, ...]]) -> Column:
    """For a cell, a struct of SUMS for each step of each order, one after the other.

    The fold of an order carries whether the cell's documents are still there.
    """
    mask, n = F.col("mask"), F.col("n")
    none = F.lit(0).cast("long")

    def step(state: Column, bit: Column) -> Column:
        fails, alive = mask.bitwiseAND(bit) != 0, state["alive"]
        here = alive & fails
        values = {
            "kept": F.when(alive & ~fails, n),
            "removed": F.when(here, n),
            "redundant": F.when(~alive & fails, n),
            "unique_fails": F.when(mask == bit, n),
            "good_lost": F.when(here, F.col("good")),
            "toxic_lost": F.when(here, F.col("toxic")),
        }
        made = F.struct(*(F.coalesce(values[c], none).alias(c) for c in SUMS))
        return F.struct((alive & ~fails).alias("alive"), F.array_append(state["steps"], made).alias("steps"))

    kind = "array<struct<" + ",".join(f"{c}:bigint" for c in SUMS) + ">>"
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(kind).alias("steps"))
    given = F.array(*(F.array(*map(F.lit, order)) for order in orders))
    return F.flatten(F.transform(given, lambda order: F.aggregate(order, start, step, lambda s: s["steps"])))


def fold_orders(cells: DataFrame, names: str | list[str]) -> DataFrame:
    """A row per part, order and step, from ``cells`` whose bits are ``names`` in turn.

    Columns: part, filter_order (the names run together), step from 1, and long
    counts within the part: kept after the step, removed by it, redundant
    (failing its filter, removed earlier), unique_fails (failing its filter only),
    good_lost and toxic_lost (removed here), shapley (its filter's removed, summed
    over all orders). A part has a row for each step of each order, zeros included.

    Every cell folds over all orders, and the structs are added up place by place;
    tasks add up before anything moves, to as many rows as there are steps and parts.
    """
    names = list(names)
    if len(names) > MOST_FILTERS:
        raise ValueError(f"{len(names)} filters have too many orders; {MOST_FILTERS} at most")
    orders = list(itertools.permutations(range(len(names))))
    bits = [tuple(1 << i for i in order) for order in orders]
    steps = cells.select("part", F.posexplode(_folded(bits)).alias("place", "found"))
    sums = steps.groupBy("part", "place").agg(*(F.sum(f"found.{c}").alias(c) for c in SUMS))
    labels = F.array(*(F.lit("".join(names[i] for i in order)) for order in orders))
    letters = F.array(*(F.lit(names[i]) for order in orders for i in order))
    per_filter = Window.partitionBy("part", "letter")
    return sums.withColumn("letter", F.get(letters, F.col("place"))).select(
        "part",
        F.get(labels, F.floor(F.col("place") / len(names)).cast("int")).alias("filter_order"),
        (F.col("place") % len(names) + 1).alias("step"),
        *SUMS,
        F.sum("removed").over(per_filter).alias("shapley"),
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column] | None = None,
    copies: str = "E",
    part_column: str = "lang",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``fold_orders`` of the documents' ``cells``; ``copies`` names the filter of copies.

    Null text is empty text, a null part the empty string. A null id has no order:
    it is never a copy, and no copy has it for a smaller id. Rows that repeat an id
    count each, and only a smaller id makes them copies. An id without a label is
    neither good nor toxic; of repeated labels any counts. An empty table has no
    parts and gives no rows. Further columns change nothing.
    """
    filters = text_filters(quoted(text_column)) if filters is None else dict(filters)
    if copies in filters:
        raise ValueError(f"{copies!r} names two filters")
    found = materialize(cells(docs, labels, filters, part_column, id_column, text_column), "cells")
    return fold_orders(found, [*filters, copies])


def removals(audited: DataFrame, order: str) -> DataFrame:
    """The steps of one order, the filters in turn: what a report shows for a chosen order."""
    name = free_name(audited, "filter")
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    return audited.where(F.col("filter_order") == order).withColumn(name, letter)
