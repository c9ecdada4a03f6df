"""Boilerplate lines by the number of sites that have them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.words import free_name, quoted, whole
from ferry.sources.scratch import materialize

# Lines on so many sites are boilerplate.
MIN_SITES = 10
# Sketches have 2^12 registers; a standard error of theirs is 1.04 / 64.
REGISTERS_LOG2 = 12
# Estimates within so many standard errors of the threshold, and within one
# site, are counted exactly.
ERRORS = 4
# Up to so many lines that go are a condition of the scan; more are looked up.
LISTED_LINES = 10_000
# Blanks around a line, which do not tell lines apart.
BLANKS = " \t\x0b\x0c\r"


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _hash(line: Column) -> Column:
    """128 bits of a line without the blanks around it."""
    bare = _bare(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b"))


def _split(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    text_column: str = "text",
    site_column: str = "source",
) -> DataFrame:
    """a, b: hashes of the lines that stand on ``min_sites`` sites or more."""
    line = _bare(F.col("line"))
    lines = docs.select(
        F.xxhash64(quoted(site_column)).alias("site"),
        F.explode(_split(whole(quoted(text_column)))).alias("line"),
    ).where(F.length(line) > 0)
    lines = lines.select("site", _hash(F.col("line")).alias("h")).select("h.*", "site")
    spread = lines.groupBy("a", "b").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(REGISTERS_LOG2))).alias("sites")
    )
    band = max(1.0, ERRORS * 1.04 / math.sqrt(2**REGISTERS_LOG2) * min_sites)
    spread = materialize(spread.where(F.col("sites") >= min_sites - band), "spread")
    near = spread.where(F.col("sites") <= min_sites + band).select("a", "b")
    exact = (
        lines.join(near, ["a", "b"], "left_semi")
        .distinct()
        .groupBy("a", "b")
        .count()
        .where(F.col("count") >= min_sites)
        .select("a", "b")
    )
    sure = spread.where(F.col("sites") > min_sites + band).select("a", "b")
    return materialize(sure.unionByName(exact), "boilerplate")


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    text_column: str = "text",
    site_column: str = "source",
) -> DataFrame:
    """``docs`` without boilerplate lines, plus n_lines and n_removed of each row.

    Lines are equal if they are equal without blanks around them (space, tab, CR,
    vertical tab, form feed); blank lines belong to no site and stay. A null site
    counts as one site. Null text stays null, with one line and none removed. Other
    lines keep their order and bytes. An empty table gives an empty result.

    A task reduces a line to one sketch before the shuffle, however many rows have
    it. Few lines that go are a condition that is applied where a text is read, and
    no text moves. Of more, documents look up their own lines by text hash, so
    copies share the lookup and only lines that go are gathered, per text.
    """
    bad = boilerplate(docs, min_sites, text_column, site_column)
    if bad.count() > LISTED_LINES:
        return _looked_up(docs, bad, text_column)
    n, k = (free_name(docs, c) for c in ("n_lines", "n_removed"))
    first, second = ([r[0] for r in bad.select(c).collect()] for c in "ab")
    lines = _split(quoted(text_column))
    goes = lambda x: F.xxhash64(_bare(x)).isin(first) & F.xxhash64(F.lit(1), _bare(x)).isin(second)
    kept_name = free_name(docs, "kept_lines")
    kept = F.filter(lines, lambda x: ~goes(x)) if first else lines
    out = docs.withColumns({kept_name: kept, n: F.coalesce(F.size(lines), F.lit(1))})
    size = F.coalesce(F.size(quoted(kept_name)), F.lit(1))
    new_text = F.when(size == F.col(n), quoted(text_column)).otherwise(F.array_join(quoted(kept_name), "\n"))
    rest = [new_text.alias(c) if c == text_column else quoted(c) for c in docs.columns]
    return out.select(*rest, F.col(n), (F.col(n) - size).alias(k))


def _looked_up(docs: DataFrame, bad: DataFrame, text_column: str) -> DataFrame:
    """``remove_boilerplate`` of any number of lines."""
    text = whole(quoted(text_column))
    found = docs.select(F.md5(text).alias("key"), F.explode(_split(text)).alias("line"))
    found = found.select("key", _hash(F.col("line")).alias("h")).select("key", "h.*")
    key, gone, n, k = (free_name(docs, c) for c in ("key", "gone", "n_lines", "n_removed"))
    found = (
        found.join(bad, ["a", "b"], "left_semi")
        .groupBy(F.col("key").alias(key))
        .agg(F.collect_set(F.struct("a", "b")).alias(gone))
    )
    lines = _split(quoted(text_column))
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col(gone), _hash(x)))
    n_lines = F.coalesce(F.size(lines), F.lit(1))
    out = docs.withColumn(key, F.md5(text)).join(found, key, "left").withColumn(
        gone, F.when(quoted(text_column).isNotNull(), F.col(gone))
    )
    out = out.withColumns({n: n_lines, k: F.when(F.col(gone).isNull(), n_lines).otherwise(F.size(kept))})
    new_text = F.when(F.col(gone).isNull(), quoted(text_column)).otherwise(F.array_join(kept, "\n"))
    rest = [new_text.alias(c) if c == text_column else quoted(c) for c in docs.columns]
    return out.select(*rest, F.col(n), (F.col(n) - F.col(k)).alias(k))
