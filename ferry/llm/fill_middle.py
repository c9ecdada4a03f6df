"""Documents rewritten for fill-in-the-middle training, cut between lines."""

from __future__ import annotations

import itertools
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.words import free_name, quoted, whole

# What marks the parts of a rewritten text.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
# Of 100 documents, so many are rewritten, and of 100 of those so many suffix first.
REWRITTEN, SUFFIX_FIRST = 100, 50
# A chunk ends where the rolling hash of its last WINDOW bytes has this many zero
# bits in front, so after 256 bytes on average, within these bounds.
WINDOW, ZERO_BITS = 32, 8
LEAST_CHUNK, MOST_CHUNK = 64, 4096
# Bytes hashed at a time, and bytes of chunks a task remembers, at most.
HASHED, REMEMBERED = 1 << 18, 8 << 20
# A value of the rolling hash for each byte.
GEAR = np.array([zlib.crc32(bytes([b, 255 - b])) for b in range(256)], np.uint32)


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of ``data`` end. Equal passages get equal chunks but at their rims.

    The hash is a gear hash: every byte shifts it by a bit, so 32 bits hold the
    last 32 bytes. It is added up from runs of 1, 2, 4, 8 and 16 bytes.
    """
    found = []
    for low in range(0, len(data), HASHED):
        rim = max(low - (WINDOW - 1), 0)
        rolled = GEAR[np.frombuffer(data[rim : low + HASHED], np.uint8)]
        run = 1
        while run < WINDOW:
            rolled[run:] += rolled[:-run] << np.uint32(run)
            run *= 2
        ends = np.flatnonzero(rolled >> np.uint32(32 - ZERO_BITS) == 0) + rim + 1
        found.append(ends[ends > low])
    cuts, last = [], 0
    for end in itertools.chain(*(f.tolist() for f in found), (len(data),)):
        while end - last > MOST_CHUNK:
            last += MOST_CHUNK
            cuts.append(last)
        if end - last >= LEAST_CHUNK or end == len(data) > last:
            cuts.append(end)
            last = end
    return cuts


def _points(data: bytes) -> int:
    """Code points that begin in ``data``, which may begin or end within one."""
    codes = np.frombuffer(data, np.uint8)
    return int(len(codes) - np.count_nonzero((codes & 0xC0) == 0x80))


class Summary(NamedTuple):
    lines: int  # line ends
    points: int  # code points that begin here


class Summaries:
    """Summaries of chunks, made once for equal chunks of a task.

    The chunk itself is the key, so a summary is found by hash and then verified
    by content. What has not been met for long is forgotten: of two generations
    the younger one fills up and then becomes the older one.
    """

    def __init__(self, most: int = REMEMBERED) -> None:
        self.most = most
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}
        self.size = self.made = 0

    def of(self, chunk: bytes) -> Summary:
        known = self.young.get(chunk)
        if known is None:
            known = self.old.get(chunk)
            if known is None:
                known = Summary(chunk.count(b"\n"), _points(chunk))
                self.made += 1
            self.young[chunk] = known
            self.size += len(chunk)
            if self.size > self.most // 2:
                self.old, self.young, self.size = self.young, {}, 0
        return known


class Lines:
    """The lines of one text, as sums over its chunks."""

    def __init__(self, data: bytes, summaries: Summaries) -> None:
        self.data = data
        self.ends = [0, *chunk_ends(data)]
        found = [summaries.of(data[a:b]) for a, b in itertools.pairwise(self.ends)]
        self.lines = [0, *itertools.accumulate(s.lines for s in found)]
        self.points = [0, *itertools.accumulate(s.points for s in found)]
        # What follows the last line end is a line too.
        self.count = self.lines[-1] + (not data.endswith(b"\n") if data else 0)

    def points_of(self, lines: int) -> int:
        """Code points of the first ``lines`` lines; only the chunk they end in is read."""
        if lines == 0:
            return 0
        if lines > self.lines[-1]:
            return self.points[-1]
        chunk = bisect_left(self.lines, lines) - 1
        at = self.ends[chunk]
        for _ in range(lines - self.lines[chunk]):
            at = self.data.index(b"\n", at) + 1
        return self.points[chunk] + _points(self.data[self.ends[chunk] : at])


def _draws(id_column: str, seed: int) -> list[Column]:
    """Four numbers below 2**32 that follow from the id; a null id counts as no digits."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(quoted(id_column).cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _cuts(text: Column, first: Column, second: Column) -> Column:
    """n, and the code points of prefix and middle, cut after draw % (n + 1) lines."""

    @F.arrow_udf("struct<n:bigint,prefix:bigint,middle:bigint>")
    def cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        summaries = Summaries()
        for texts, ones, others in batches:
            rows = []
            for value, a, b in zip(texts, ones.to_pylist(), others.to_pylist(), strict=True):
                lines = Lines(value.as_py().encode(), summaries)
                n = lines.count
                low, high = sorted((a % (n + 1), b % (n + 1)))
                before = lines.points_of(low)
                rows.append((n, before, lines.points_of(high) - before))
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["n", "prefix", "middle"]
            )

    return cuts(text, first, second)


def rewrite(
    docs: DataFrame,
    seed: int = SEED,
    rewritten: int = REWRITTEN,
    suffix_first: int = SUFFIX_FIRST,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output.

    n counts the lines, a last one without a line end included. Of ``rewritten``
    in 100 documents the prefix, the middle and the suffix are whole lines, any of
    them perhaps none, cut at places that follow from seed and id. Form psm is
    <P>prefix<S>suffix<M>middle, spm, in ``suffix_first`` of 100 of them, is
    <S>suffix<P>prefix<M>middle. Other texts, empty ones and those that hold one of
    the marks are plain: the output is the text, and the lengths (in code points)
    are null. Null text is empty text, a null id an empty one; rows that share an
    id get the same draws. New columns whose names are taken get an underscore. An
    empty table gives an empty result.

    Lines are counted chunk by chunk; a task remembers the counts of chunks, so a
    passage that many documents share is counted once, and adds up what it needs.
    """
    names = [free_name(docs, c) for c in ("n", "form", "prefix_chars", "middle_chars", "output")]
    cuts, text_name, form_name = (free_name(docs, c) for c in ("_cuts", "_whole_text", "_form"))
    text = quoted(text_name)
    h1, h2, h3, h4 = _draws(id_column, seed)
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | text.contains(mark)
    form = (
        F.when((text == "") | marked | (h3 % 100 >= rewritten), "plain")
        .when(h4 % 100 < suffix_first, "spm")
        .otherwise("psm")
    )
    rows = docs.withColumn(text_name, whole(quoted(text_column)))
    rows = rows.withColumn(cuts, _cuts(text, h1, h2)).withColumn(form_name, form)
    before, inside = (quoted(cuts)[c].cast("int") for c in ("prefix", "middle"))
    prefix = F.substring(text, F.lit(1), before)
    middle = F.substring(text, before + 1, inside)
    suffix = F.substring(text, before + inside + 1, F.char_length(text))
    end = F.lit(MIDDLE), middle
    output = (
        F.when(quoted(form_name) == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, *end))
        .when(quoted(form_name) == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, *end))
        .otherwise(text)
    )
    cut = quoted(form_name) != "plain"
    made = [
        quoted(cuts)["n"],
        quoted(form_name),
        F.when(cut, quoted(cuts)["prefix"]),
        F.when(cut, quoted(cuts)["middle"]),
        output,
    ]
    return rows.select(*map(quoted, docs.columns), *(c.alias(n) for c, n in zip(made, names, strict=True)))


def restore(output: Column | str, form: Column | str) -> Column:
    """The text that ``rewrite`` made ``output`` of; null where either is null.

    A mark begins with the one character that ends no other mark's beginning, so
    the first place of each mark is its own, whatever stands beside it.
    """
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    p, s, m = (F.instr(output, mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    part = lambda at, end: F.substring(output, at + 3, end - at - 3)
    middle = F.substring(output, m + 3, F.char_length(output))
    return (
        F.when(form == "psm", F.concat(part(p, s), middle, part(s, m)))
        .when(form == "spm", F.concat(part(p, m), middle, part(s, p)))
        .when(form == "plain", output)
    )


def digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, the lengths, and SHA-256 of output and restored text, per row."""
    slim = docs.select("doc_id", "text")
    made = rewrite(slim, **options)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restore("output", "form").cast("binary"), 256).alias("restored_sha256"),
    )
