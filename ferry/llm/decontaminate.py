"""Benchmark passages in documents, found by spaced seeds."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.words import MB, free_name, quoted, whole, words
from ferry.sources.scratch import materialize

# A window of so many words counts as an overlap if at most MISSES of them differ.
WINDOW, MISSES = 13, 2
# Masks of six words. Whichever two words of a window differ,
# one of these masks lies in the window without touching them.
MASKS = ("11101011", "1010001111")
# An item under WINDOW words must stand there whole, from so many words on with
# at most SHORT_MISSES changed; shorter ones, phrases, are matched word for word.
LEAST_WORDS, SHORT_MISSES = 5, 1
# Benchmark postings are broadcast up to this size, otherwise joined by hash.
BROADCAST_BYTES = 64 * MB


def _offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def _weights(masks: list[str]) -> list[list[str]]:
    return [[m for m in masks if m.count("1") == w] for w in sorted({m.count("1") for m in masks})]


def short_masks(length: int) -> list[str]:
    """Masks one of which, somewhere in a text of so many words, misses any one changed word.

    The halves of the text; of five words, the first three, the last three, and
    three around the middle one.
    """
    if length == 5:
        return ["111", "1101"]
    return sorted({"1" * (length // 2), "1" * (length - length // 2)})


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def seeds(rows: DataFrame, masks: list[str], *keep: str) -> DataFrame:
    """A row per word place and mask that fits there: ``keep``, at, seed.

    The masks have one weight. They are data, so that one short expression hashes
    all of them: generated code beyond 8000 bytes is not compiled by the JVM.
    ``keep`` may hold the words. Up to the next union, shuffle or sort they are
    passed by reference; beyond it each row would hold a copy.
    """
    weight = masks[0].count("1")
    masks_of = F.array(*[F.array(*map(F.lit, _offsets(m))) for m in masks])
    at = rows.select(*keep, "tokens", F.posexplode_outer("tokens").alias("at", "_"))
    at = at.select(*keep, "tokens", "at", F.explode(masks_of).alias("mask"))
    word = [F.get("tokens", F.col("at") + F.get("mask", F.lit(i))) for i in range(weight)]
    gap = F.get("mask", F.lit(weight - 1))  # with the middle, tells masks of one weight apart
    return at.where(F.col("at") + gap < F.size("tokens")).select(
        *keep, "at", F.xxhash64(gap, F.get("mask", F.lit(weight // 2)), *word).alias("seed")
    )


def _stretch(same: Column) -> Column:
    """Longest run of places of ``same`` (booleans) with at most MISSES false ones."""
    false = F.filter(
        F.transform(same, lambda x, i: F.when(~x, i)), lambda i: i.isNotNull()
    )
    ends = F.array_repeat(F.size(same), MISSES + 1)
    cuts = F.concat(F.array(F.lit(-1)), false, ends)
    apart = F.zip_with(
        F.slice(cuts, MISSES + 2, F.size(cuts)),
        F.slice(cuts, 1, F.greatest(F.size(cuts) - (MISSES + 1), F.lit(0))),
        lambda high, low: high - low - 1,
    )
    return F.array_max(apart)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    keys: dict[str, Column],
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Keys of the document, item_id and the best overlap of each such pair.

    An overlap is a window of 13 words of the item that stands in the document
    at the same relative places with at most 2 words changed. Items of 5 to 12
    words must stand there whole, with at most 1 word changed; phrases of 1 to 4
    words word for word (``phrase`` is true). Null documents and items, and items
    without words, overlap with nothing; empty tables give no rows. Columns: the
    keys, item_id, and of the best, then earliest alignment start_word (the place of
    the item's first word, negative where the item's beginning is missing),
    overlap_words (its longest run with at most 2 changed words) and same_words;
    alignments counts all. Rows with equal keys count as one document. Whole texts
    are searched, however long; further columns of either table change nothing.
    """
    items = benchmark.select(
        quoted(item_column).alias("item_id"), words(quoted(item_text)).alias("tokens")
    ).where(F.size("tokens") > 0)
    items = materialize(items, "items")
    length = F.size("tokens")
    rows = docs.select(
        *[c.alias(k) for k, c in keys.items()], words(quoted(text_column)).alias("tokens")
    )
    phrases = items.where(length < LEAST_WORDS)
    found = _aligned(rows, items.where(length >= LEAST_WORDS), keys, broadcast_bytes)
    if phrases.isEmpty():
        return found.withColumn("phrase", F.lit(False))
    told = _phrases(rows, phrases, keys, broadcast_bytes)
    return found.withColumn("phrase", F.lit(False)).unionByName(told.withColumn("phrase", F.lit(True)))


def _phrases(rows: DataFrame, items: DataFrame, keys: dict[str, Column], broadcast_bytes: int) -> DataFrame:
    """Where phrases of 1 to 4 words stand word for word."""
    parts = []
    for n in range(1, LEAST_WORDS):
        mask = ["1" * n]
        own = items.where(F.size("tokens") == n)
        posts = seeds(own, mask, "item_id", "tokens").select("item_id", F.col("tokens").alias("item"), "seed")
        size = own.count() * (24 * n + 64)
        if not size:
            continue
        posts = F.broadcast(posts) if size <= broadcast_bytes else posts
        hits = seeds(rows, mask, *keys, "tokens").join(posts, "seed")
        parts.append(hits.where(F.slice("tokens", F.col("at") + 1, n) == F.col("item")).select(*keys, "item_id", "at", F.lit(n).alias("n")))
    # A word may stand at one place only once for each row; equal rows count as one document.
    starts = _union(parts).groupBy(*keys, "item_id", "n").agg(F.min("at").alias("first"), F.count_distinct("at").alias("alignments"))
    long = lambda c: F.col(c).cast("long")
    return starts.select(
        *keys, "item_id", long("first").alias("start_word"), long("n").alias("overlap_words"), long("n").alias("same_words"), "alignments"
    )


def _aligned(rows: DataFrame, items: DataFrame, keys: dict[str, Column], broadcast_bytes: int) -> DataFrame:
    """Overlaps with items of 5 words and more."""
    long = items.where(F.size("tokens") >= WINDOW)
    short = items.where(F.size("tokens") < WINDOW)
    lengths = sorted(r[0] for r in short.select(F.size("tokens")).distinct().collect())  # 8 at most
    posts = seeds(long, list(MASKS), "item_id", "tokens")
    masks = list(MASKS)
    for n in lengths:
        masks += [m for m in short_masks(n) if m not in masks]
        for same_weight in _weights(short_masks(n)):
            own = seeds(short.where(F.size("tokens") == n), same_weight, "item_id", "tokens")
            posts = posts.unionByName(own)
    posts = materialize(
        posts.select(
            "item_id", F.col("tokens").alias("item"), F.col("at").alias("item_at"), "seed"
        ),
        "seeds",
    )
    size = posts.agg(F.sum(F.size("item") * 24 + 64)).collect()[0][0] or 0
    if size <= broadcast_bytes:
        # The words stay in reach, so hits are verified where they are found.
        hits = _union([seeds(rows, m, *keys, "tokens").join(F.broadcast(posts), "seed") for m in _weights(masks)])
    else:
        places = _union([seeds(rows, m, *keys) for m in _weights(masks)]).join(posts, "seed")
        start = (F.col("at") - F.col("item_at")).alias("at")
        places = places.select(*keys, "item_id", "item", start, F.lit(0).alias("item_at")).distinct()
        same_key = [places[k].eqNullSafe(rows[k]) for k in keys]
        hits = places.join(rows, same_key).select(*[places[c] for c in places.columns], "tokens")
    length, start = F.size("item"), F.col("at") - F.col("item_at")
    from_word = F.greatest(start, F.lit(0))
    skipped = from_word - start
    passage = F.slice("tokens", from_word + 1, F.greatest(length - skipped, F.lit(0)))
    # The seeds of one alignment fall together in the task that finds them. Stored,
    # so that the checks below are not moved into the search for seeds.
    hits = materialize(
        hits.select(
            *keys, "item_id", start.alias("start_word"), passage.alias("passage"), "item"
        ).distinct(),
        "hits",
    )
    aligned = F.zip_with(
        "passage",
        F.slice("item", F.greatest(-F.col("start_word"), F.lit(0)) + 1, length),
        lambda a, b: F.coalesce(a == b, F.lit(False)),
    )
    hits = hits.select(*keys, "item_id", "start_word", length.alias("length"), aligned.alias("same"))
    hits = hits.select(
        *keys,
        "item_id",
        "start_word",
        "length",
        F.size(F.filter("same", lambda x: x)).alias("same_words"),
        _stretch(F.col("same")).alias("overlap_words"),
    )
    windows = (F.col("length") >= WINDOW) & (F.col("overlap_words") >= WINDOW)
    near = (F.col("length") < WINDOW) & (F.col("same_words") >= F.col("length") - SHORT_MISSES)
    once = hits.where(windows | near).distinct()
    best = F.max(F.struct("overlap_words", "same_words", (-F.col("start_word")).alias("back")))
    return (
        once.groupBy(*keys, "item_id")
        .agg(best.alias("best"), F.count("*").alias("alignments"))
        .select(
            *keys,
            "item_id",
            (-F.col("best.back")).cast("long").alias("start_word"),
            F.col("best.overlap_words").cast("long").alias("overlap_words"),
            F.col("best.same_words").cast("long").alias("same_words"),
            "alignments",
        )
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", phrases: bool = False
) -> DataFrame:
    """``docs`` without the rows that overlap with any benchmark text, all columns as they were.

    Overlaps are those of ``overlaps``; phrases of 1 to 4 words, which ordinary
    texts hold too, count with ``phrases`` only. Equal texts stay or go together,
    whatever their ids; null and empty texts stay, as does everything if the
    benchmark is empty. An empty table gives an empty result.
    """
    key = F.md5(whole(quoted(text_column)))
    found = overlaps(docs, benchmark, {"key": key}, text_column)
    if not phrases:
        found = found.where(~F.col("phrase"))
    name = free_name(docs, "leaked")
    bad = materialize(found.select(F.col("key").alias(name)).distinct(), "leaks")
    return docs.join(bad, key == F.col(name), "left_anti")
