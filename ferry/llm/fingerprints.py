"""Threshold-scaled sketches of documents: every shingle hash below a fixed fraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.words import attach, bytes_of, free_name, quoted, whole, words
from ferry.operators.matching import broadcastable
from ferry.sources.scratch import materialize
from ferry.sources.sizing import shuffle_partitions

WORDS = 5
# Hashes below RANGE / FRACTION are kept, of a text of up to WHOLE shingles all.
FRACTION, WHOLE = 8, 64
# A shingle's hash is the sum of its words' CRC-32, each times the
# multiplier of its place, modulo RANGE. The sum stays below 2**63.
RANGE = 2**56 - 5
PLACES = (203_445_013, 251_174_521, 167_870_539, 229_648_847, 184_230_161)
# Hexadecimal digits of a hash.
DIGITS = 14
# Words hashed at a time in a worker, at least a text.
HASHED = 1 << 20
FINGERPRINT = "struct<whole:boolean,hashes:array<bigint>>"
# Texts paired at a time in a worker.
PAIRED = 512


def _hashes(codes: np.ndarray, counts: np.ndarray, fraction: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes of texts whose words' codes lie one after the other, and how many each text has."""
    texts = len(counts)
    ends = np.cumsum(counts)
    starts = ends - counts
    total = codes * np.uint64(PLACES[0])
    for k in range(1, WORDS):
        total[:-k] += codes[k:] * np.uint64(PLACES[k])
    for i in np.flatnonzero((counts > 0) & (counts < WORDS)):
        words_of = codes[starts[i] : ends[i]].tolist()
        total[starts[i]] = sum(c * p for c, p in zip(words_of, PLACES, strict=False))
    total %= np.uint64(RANGE)
    runs = np.where(counts > 0, np.maximum(counts - (WORDS - 1), 1), 0)
    text = np.repeat(np.arange(texts), counts)
    is_run = np.arange(len(codes)) - np.repeat(starts, counts) < np.repeat(runs, counts)
    kept = np.flatnonzero(is_run & ((counts < WHOLE + WORDS)[text] | (total < np.uint64(RANGE // fraction))))
    text, total = text[kept], total[kept]
    order = np.lexsort((total, text))
    text, total = text[order], total[order]
    once = np.ones(len(total), bool)
    once[1:] = (total[1:] != total[:-1]) | (text[1:] != text[:-1])
    return total[once].astype(np.int64), np.bincount(text[once], minlength=texts)


def _by_codes(batch: pa.ListArray, fraction: int) -> pa.StructArray:
    """The fingerprints of a batch, some texts at a time."""
    offsets = batch.offsets.to_numpy().astype(np.int64)
    codes = batch.values.to_numpy().astype(np.uint64, copy=False)
    found, sizes, low = [], [], 0
    while low < len(batch):
        high = max(int(np.searchsorted(offsets, offsets[low] + HASHED, "right")) - 1, low + 1)
        hashes, counts = _hashes(codes[offsets[low] : offsets[high]], np.diff(offsets[low : high + 1]), fraction)
        found.append(hashes)
        sizes.append(counts)
        low = high
    flat = np.concatenate(found) if found else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], *map(np.cumsum, [np.concatenate(sizes)] if sizes else [])]).astype(np.int32)
    whole_text = pa.array(np.diff(offsets) < WHOLE + WORDS, pa.bool_())
    return pa.StructArray.from_arrays([whole_text, pa.ListArray.from_arrays(bounds, pa.array(flat))], ["whole", "hashes"])


def with_fingerprint(df: DataFrame, text_column: str, name: str, fraction: int = FRACTION) -> DataFrame:
    """``df`` with a column struct<whole: boolean, hashes: array<bigint>>.

    The hashes of the text's runs of five words that are below RANGE / ``fraction``,
    each once and in order. ``whole`` says that the text has 64 such runs at most:
    then all hashes are kept, so that a short text is not left without any. A text
    of one to four words is one run; a text without words, empty or null, has none.
    Equal texts have equal fingerprints, as have texts that differ in case (A-Z as
    well as others) or in what stands between words.
    """

    @F.arrow_udf(FINGERPRINT)
    def fingerprint(codes: pa.Array) -> pa.Array:
        return _by_codes(codes, fraction)

    codes = F.transform(words(quoted(text_column)), lambda w: F.crc32(w.cast("binary")))
    return df.withColumn(name, fingerprint(codes))


def as_text(fingerprint: Column, fraction: int = FRACTION) -> Column:
    """``1:`` (all hashes) or ``8:`` (every hash below an eighth), then the hashes in hexadecimal."""
    digits = F.transform(fingerprint["hashes"], lambda h: F.lpad(F.lower(F.hex(h)), DIGITS, "0"))
    return F.concat(F.when(fingerprint["whole"], "1:").otherwise(f"{fraction}:"), F.concat_ws("", digits))


def _at_one_fraction(a: Column, b: Column, fraction: int) -> tuple[Column, Column]:
    """The hashes of both as if each had been kept at the smaller of the two fractions."""

    def cut(x: Column, other: Column) -> Column:
        coarse = F.filter(x["hashes"], lambda h: h < RANGE // fraction)
        return F.when(x["whole"] & ~other["whole"], coarse).otherwise(x["hashes"])

    return cut(a, b), cut(b, a)


def likeness(a: Column, b: Column, fraction: int = FRACTION) -> Column:
    """Estimated Jaccard similarity of two texts, exact where both are whole.

    Two texts without words are alike (1.0); a sampled text of which nothing was
    kept is like no short one (0.0).
    """
    ours, theirs = _at_one_fraction(a, b, fraction)
    shared, united = F.size(F.array_intersect(ours, theirs)), F.size(F.array_union(ours, theirs))
    empty = (a["whole"] & b["whole"]).cast("double")
    return F.when(united > 0, shared / united).otherwise(empty)


def containment(a: Column, b: Column, fraction: int = FRACTION) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; null where none of ``a`` was kept."""
    ours, theirs = _at_one_fraction(a, b, fraction)
    n = F.size(ours)
    return F.when(n > 0, F.size(F.array_intersect(ours, theirs)) / n)


# -- sketches of many documents ----------------------------------------------


def sketch(docs: DataFrame, key: str, text_column: str = "text", fraction: int = FRACTION) -> DataFrame:
    """key and hash: what is below the fraction in all texts of a key, each once.

    ``key`` may be the document or anything coarser. Sketches merge: the union of
    two, or of the parts of a coarser key, with repeats removed, is the sketch of all
    their texts. A sketch is rows rather than one value, so one key may hold any share
    of the corpus. Texts of which nothing is kept have no rows; a null key is a key.
    """
    slim = docs.select(quoted(key).alias("key"), quoted(text_column).alias("text"))
    kept = with_fingerprint(slim, "text", "found", fraction).select("key", F.explode("found.hashes").alias("hash"))
    return kept.where(F.col("hash") < RANGE // fraction).distinct()


def merge(sketched: DataFrame, groups: DataFrame) -> DataFrame:
    """The sketch of each group, from ``sketched`` and ``groups`` (key, once each, and group)."""
    joined = attach(sketched, groups.select("key", "group"), "key", "inner")
    return joined.select(F.col("group").alias("key"), "hash").distinct()


def contained(asked: DataFrame, held: DataFrame) -> DataFrame:
    """asked, held, shared and containment for every pair of keys that share a hash.

    Both are sketches at one fraction, of any two sizes: ``containment`` estimates
    the share of the asked key's shingles that the held key has. The asked sketches
    are broadcast if they are measured small. Pairs that share nothing are left out.
    """
    asked = materialize(asked.select(F.col("key").alias("asked"), "hash"), "asked")
    sizes = asked.groupBy("asked").agg(F.count("*").alias("size"))
    few = F.broadcast(asked) if broadcastable(*bytes_of(asked)) else asked
    pairs = held.select(F.col("key").alias("held"), "hash").join(few, "hash")
    shared = pairs.groupBy("asked", "held").agg(F.count("*").alias("shared"))
    return shared.join(sizes, shared["asked"].eqNullSafe(sizes["asked"])).select(
        shared["asked"], "held", "shared", (F.col("shared") / F.col("size")).alias("containment")
    )


# -- each document beside the next -------------------------------------------


def _edited(texts: pa.ChunkedArray, others: pa.ChunkedArray) -> list[str]:
    made = []
    for value, other in zip(texts, others, strict=True):
        text = value.as_py()
        third = len(text) // 3
        made.append(text[: len(text) - third] + other.as_py()[:third])
    return made


def _beside(rows: pa.Table, following: pa.Table) -> Iterator[pa.RecordBatch]:
    """Each of ``rows`` with its edited text and the fingerprint of the row that follows."""
    for low in range(0, rows.num_rows, PAIRED):
        ours, others = rows.slice(low, PAIRED), following.slice(low, PAIRED)
        edited = pa.array(_edited(ours.column("text"), others.column("text")), pa.string())
        out = pa.table(
            {
                "id": ours.column("id"),
                "n_chars": pa.array([len(t.as_py()) for t in ours.column("text")], pa.int64()),
                "edited": edited,
                "own": ours.column("own"),
                "next": others.column("own"),
            }
        )
        yield from out.combine_chunks().to_batches()


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row of a partition but the last beside the next one; one row is held over."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        last = rows.num_rows - 1
        yield from _beside(rows.slice(0, last), rows.slice(1))
        held = pa.Table.from_batches([batch.take(pa.array([batch.num_rows - 1]))])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last row of a partition, which may be one."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if last is None:
            yield batch.slice(0, 1).append_column("is_last", pa.array([False]))
        last = batch.take(pa.array([batch.num_rows - 1]))
    if last is not None:
        yield last.append_column("is_last", pa.array([True]))


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each partition's last row beside the next partition's first, the very last beside the very first."""
    first = last = None
    for batch in batches:
        for i, is_last in enumerate(batch.column("is_last").to_pylist()):
            row = pa.Table.from_batches([batch.take(pa.array([i]))])
            if is_last:
                last = row
                continue
            if last is not None:
                yield from _beside(last, row)
            first = first if first is not None else row
    if last is not None:
        yield from _beside(last, first)


def edited_pairs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fraction: int = FRACTION
) -> DataFrame:
    """id, n_chars, edited, own and next of every row.

    ``edited`` is the text whose last floor(n_chars / 3) code points were replaced
    by the first as many, or all, of the next text; ``own`` and ``next`` are the
    fingerprints of the text and of the next text. Rows follow each other by
    descending id, null ids last, equal ids by their texts (a hash, then the text),
    and after the last comes the first; a single row follows itself.

    Texts move once, into ranges of ids. A task pairs the rows of a range as they
    come; the two end rows of each range, one pair for each partition, are brought
    together by a second branch that reads the same shuffle.
    """
    text = whole(quoted(text_column))
    rows = docs.select(quoted(id_column).alias("id"), F.xxhash64(text).alias("spread"), text.alias("text"))
    order = [F.col("id").desc_nulls_last(), F.col("spread")]
    ranges = rows.repartitionByRange(shuffle_partitions(rows), *order).sortWithinPartitions(*order, "text")
    kind = dict(rows.dtypes)["id"]
    paired = f"id {kind}, n_chars bigint, edited string, own {FINGERPRINT}, next {FINGERPRINT}"
    inside = with_fingerprint(ranges.select("id", "text"), "text", "own", fraction).mapInArrow(_within, paired)
    ends = ranges.select("id", "text", F.spark_partition_id().alias("place"))
    ends = ends.mapInArrow(_ends, f"id {kind}, text string, place int, is_last boolean")
    ends = ends.repartition(1).sortWithinPartitions("place", "is_last")
    across = with_fingerprint(ends, "text", "own", fraction).mapInArrow(_between, paired)
    return inside.unionByName(across)


def compare_edited(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fraction: int = FRACTION
) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints as text, near_edited and near_next, per row.

    Rows that repeat an id stand for themselves. Null text is empty text. Further
    columns change nothing, and an empty table gives an empty result.
    """
    rows = with_fingerprint(edited_pairs(docs, id_column, text_column, fraction), "edited", "changed", fraction)
    own, changed, following = F.col("own"), F.col("changed"), F.col("next")
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(own, fraction).alias("fingerprint"),
        as_text(changed, fraction).alias("edited_fingerprint"),
        likeness(own, changed, fraction).alias("near_edited"),
        likeness(own, following, fraction).alias("near_next"),
    )
