"""Near-duplicate texts: chosen-path join on word shingles."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.components import components
from ferry.llm.words import BETWEEN, free_name, quoted, small_batches, whole
from ferry.sources.scratch import materialize
from ferry.sources.sizing import shuffle_partitions

WORDS, SIMILARITY = 5, 0.8
# Every pair at the threshold or above is found with this probability at least.
RECALL = 0.999
# A bucket of more texts is split again, at most DEPTH times; one that is still
# larger holds alike texts and is compared in blocks of this size.
BLOCK, DEPTH = 1024, 3
# Bins of a text's sketch, and how many standard errors below the threshold a
# sketch may lie before the exact comparison is left out.
BINS, ERRORS = 64, 5.0
# Keys of texts with a likely link that may be broadcast: 16 bytes each and the row
# overhead of a hash table, under 100 MB at this number.
BROADCAST_KEYS = 1_000_000
# A block also holds so many shingles at most, in the mean or by a single text.
BLOCK_SHINGLES = 1 << 20
# Shingles compared at a time within two blocks.
COLUMNS = 1024
# Pairs of node and shingle that are drawn at a time.
DRAWN = 1 << 20
# Odd multipliers for mixing 64-bit hashes.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)

_between = re.compile(BETWEEN)


def runs_for(recall: float, similarity: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``.

    In each step a text follows 1 / similarity tokens on average, so a pair shares
    one token on average even if one text contains the other.
    """
    meet = 1.0
    for _ in range(depth):
        meet = 1 - math.exp(-meet)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(MIX[0])
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Sets of shingle hashes; remembers the hashes of frequent words."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def shingles(self, text: str) -> np.ndarray:
        """Sorted 64-bit hashes of the text's runs of five words.

        A shorter text is one shingle, and a text without words has none.
        """
        import xxhash

        found = [w for w in _between.split(text.lower()) if w]
        if not found:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > 200_000:
            known.clear()
        hashes = np.array(
            [known[w] if w in known else known.setdefault(w, xxhash.xxh64_intdigest(w)) for w in found], np.uint64
        )
        n = max(len(found) - WORDS + 1, 1)
        total = np.zeros(n, np.uint64)
        for i in range(min(WORDS, len(found))):
            total = (total + hashes[i : i + n]) * np.uint64(MIX[i])
            total ^= total >> np.uint64(31)
        return np.unique(_mix(total + np.uint64(min(len(found), WORDS))))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of each of 64 bins, in 16 bits; 0 where a bin is empty."""
    edges = np.searchsorted(shingles, np.arange(BINS, dtype=np.uint64) << np.uint64(58))
    full = edges < np.append(edges[1:], len(shingles))
    out = np.zeros(BINS, np.uint16)
    low = shingles[edges[full]] >> np.uint64(10)
    out[full] = (_mix(low) >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
    return out


def _drawn(shingles: np.ndarray, nodes: np.ndarray, limit: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Which nodes follow which shingles, a bounded number of draws at a time."""
    which, token = [], []
    many = max(DRAWN // len(shingles), 1)
    for low in range(0, len(nodes), many):
        for start in range(0, len(shingles), DRAWN):
            some = shingles[start : start + DRAWN]
            a, b = np.nonzero(_mix(_mix(some[None, :] ^ nodes[low : low + many, None]) + np.uint64(MIX[2])) < limit)
            which.append(a + low)
            token.append(b + start)
    return np.concatenate(which), np.concatenate(token)


def paths(shingles: np.ndarray, runs: int, similarity: float, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(parents, nodes) of each depth: the tokens that a set follows in every run.

    At a node a token is followed if its hash, under the node's own seed, is
    below 1 / (similarity * size) of the range. Which nodes a set visits depends
    on itself alone, so texts need not meet to follow the same path.
    """
    limit = np.uint64(min(int(2.0**64 / (similarity * max(len(shingles), 1))), 2**64 - 1))
    nodes = _mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(MIX[1]))
    levels = []
    for _ in range(depth):
        if len(shingles) and len(nodes):
            which, token = _drawn(shingles, nodes, limit)
            parents = nodes[which]
            nodes = _mix(parents * np.uint64(MIX[3]) + shingles[token])
        else:
            parents = nodes = np.zeros(0, np.uint64)
        levels.append((parents, nodes))
    return levels


class Block(NamedTuple):
    """Texts of a bucket that one task compares: among themselves or side by side."""

    left: np.ndarray  # which belong to the first block; all if the blocks are one
    right: np.ndarray
    bucket: int
    buckets: list[np.ndarray]

    def fresh(self) -> np.ndarray:
        """Pairs to look at here: of the two sides, each once, and in no larger bucket.

        Alike texts meet in many buckets; the largest take most of their pairs, so
        few buckets need their shingles.
        """
        n = len(self.left)
        if (self.left == self.right).all():
            pairs = np.triu(np.ones((n, n), bool), 1)
        else:
            pairs = self.left[:, None] & self.right[None, :]
        owners = np.repeat(np.arange(n), [len(b) for b in self.buckets])
        flat = np.concatenate(self.buckets)
        early = flat < self.bucket
        shared = _shared(owners[early], flat[early], n)
        return pairs if shared is None else pairs & (shared == 0)


def _shared(owners: np.ndarray, values: np.ndarray, n: int) -> np.ndarray | None:
    """How many values each two of n owners have in common; None if nobody shares any."""
    values, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    common = counts > 1
    if not common.any():
        return None
    column = np.cumsum(common) - 1
    used = common[at]
    owners, at = owners[used], column[at[used]]
    total = np.zeros((n, n), np.float32)
    order = np.argsort(at, kind="stable")
    owners, at = owners[order], at[order]
    for low in range(0, int(common.sum()), COLUMNS):
        a, b = np.searchsorted(at, [low, low + COLUMNS])
        part = np.zeros((n, min(COLUMNS, int(common.sum()) - low)), np.float32)
        part[owners[a:b], at[a:b] - low] = 1
        total += part @ part.T
    return total


def plausible(sketches: np.ndarray, sizes: np.ndarray, pairs: np.ndarray, similarity: float) -> np.ndarray:
    """Which of ``pairs`` may reach the threshold by size and sketch."""
    least = (similarity * sizes - 1e-3).astype(np.float32)[:, None]
    larger = sizes.astype(np.float32) >= least
    a, b = np.nonzero(pairs & larger & larger.T)
    out = np.zeros_like(pairs)
    for low in range(0, len(a), 16384):
        i, j = a[low : low + 16384], b[low : low + 16384]
        x, y = sketches[i], sketches[j]
        used = ((x > 0) | (y > 0)).sum(1)
        same = ((x == y) & (x > 0)).sum(1)
        slack = ERRORS * np.sqrt(similarity * (1 - similarity) * used)
        fine = same >= similarity * used - slack
        out[i[fine], j[fine]] = True
    return out


def linked(sets: list[np.ndarray], pairs: np.ndarray, similarity: float) -> np.ndarray:
    """Which of ``pairs`` have a Jaccard similarity of ``similarity`` or more."""
    sizes = np.array([len(s) for s in sets])
    owners = np.repeat(np.arange(len(sets)), sizes)
    both = _shared(owners, np.concatenate(sets), len(sets))
    if both is None:
        return np.zeros_like(pairs)
    out = np.zeros_like(pairs)
    for low in range(0, len(sizes), 128):  # a few rows at a time, to hold little
        rows = slice(low, low + 128)
        union = sizes[rows, None] + sizes[None, :] - both[rows]
        out[rows] = pairs[rows] & (both[rows] + 1e-9 >= similarity * union)
    return out


def _least_linked(links: np.ndarray) -> np.ndarray:
    """The smallest index that each index is connected with."""
    links = links | links.T
    label = np.arange(len(links))
    a, b = np.nonzero(links)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _longs(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1]) if len(column) else []


def _by_block(work: Callable[[Block, pa.Table], pa.Table | None], schema: pa.Schema):
    """For mapInArrow: calls ``work`` for each block pair of sorted input."""

    def blocks(table: pa.Table) -> Iterator[pa.RecordBatch]:
        task = np.column_stack([table.column(c).to_numpy() for c in ("bucket", "bi", "bj")])
        cuts = np.flatnonzero((task[1:] != task[:-1]).any(1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(task)], strict=True):
            own = table.slice(a, b - a).combine_chunks()
            at = own.column("block").to_numpy()
            bucket, bi, bj = (int(v) for v in task[a])
            block = Block(at == bi, at == bj, bucket & (2**64 - 1), _longs(own.column("buckets")))
            out = work(block, own)
            if out is not None:
                yield from out.select(schema.names).cast(schema).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([waiting, table]) if waiting is not None else table
            last = np.ones(table.num_rows, bool)  # the last block pair may go on in the next batch
            for c in ("bucket", "bi", "bj"):
                values = table.column(c).to_numpy()
                last &= values == values[-1]
            cut = int(np.flatnonzero(~last)[-1]) + 1 if (~last).any() else 0
            if cut:
                yield from blocks(table.slice(0, cut))
            waiting = table.slice(cut)
        if waiting is not None and waiting.num_rows:
            yield from blocks(waiting)

    return run


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of a block pair side by side in one partition; pairs go to any partition."""
    task = ["bucket", "bi", "bj"]
    return rows.repartition(shuffle_partitions(rows), *task).sortWithinPartitions(*task)


def _path_table(docs: DataFrame, text_column: str, runs: int, similarity: float) -> DataFrame:
    """key, copies, size, sketch and p1, n1, ... (parents and nodes) of each different text with words."""
    text = whole(quoted(text_column))
    rows = docs.select(F.unhex(F.md5(text)).alias("key"), text.alias("text"))
    longs = [f"{a}{d}" for d in range(1, DEPTH + 1) for a in "pn"]
    schema = "key binary, size int, sketch binary, " + ", ".join(f"{c} array<bigint>" for c in longs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("key", "size", "sketch", *longs)}
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                found = shingler.shingles(text.as_py())
                if not len(found):
                    continue
                out["key"].append(key.as_py())
                out["size"].append(len(found))
                out["sketch"].append(sketch(found).tobytes())
                for d, level in enumerate(paths(found, runs, similarity, DEPTH), 1):
                    for name, values in zip("pn", level, strict=True):
                        out[f"{name}{d}"].append(values.view(np.int64))
            arrays = [
                pa.array(out["key"], pa.binary()),
                pa.array(out["size"], pa.int32()),
                pa.array(out["sketch"], pa.binary()),
                *(pa.array(out[c], pa.list_(pa.int64())) for c in longs),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=list(out))
            pa.default_memory_pool().release_unused()

    found = rows.mapInArrow(run, schema)
    firsts = [F.first(c).alias(c) for c in found.columns if c != "key"]  # alike for equal texts
    with small_batches(docs):
        return materialize(found.groupBy("key").agg(F.count("*").alias("copies"), *firsts), "paths")


def _code(n: Column, node: Column) -> Column:
    """A bucket's name, smaller for larger buckets: inverted size, then bits of its node.

    Should two buckets of one size ever share a name, they are compared as one.
    """
    size = F.least(n, F.lit(2**20 - 1))
    return F.shiftleft(2**20 - 1 - size, 43).bitwiseOR(F.shiftrightunsigned(node, 21))


def _buckets(table: DataFrame) -> DataFrame:
    """bucket, key and blocks of every final bucket with two texts or more."""
    parts, large = [], None
    for d in range(1, DEPTH + 1):
        rows = table.select("key", "size", F.explode(F.arrays_zip(f"p{d}", f"n{d}")).alias("x"))
        rows = rows.select("key", "size", F.col(f"x.p{d}").alias("parent"), F.col(f"x.n{d}").alias("bucket"))
        if large is not None:
            rows = rows.join(large, "parent", "left_semi")
        rows = rows.select("bucket", "key", "size").distinct()
        rows = rows if large is None else materialize(rows, "split")
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("shingles")).where("n > 1")
        sizes = materialize(sizes, "sizes")
        final = sizes if d == DEPTH else sizes.where(F.col("n") <= BLOCK)
        blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("shingles") / BLOCK_SHINGLES))
        final = final.select("bucket", "n", F.least(blocks, F.col("n")).cast("int").alias("blocks"))
        named = rows.join(final, "bucket")
        parts.append(named.select(_code(F.col("n"), F.col("bucket")).alias("bucket"), "key", "blocks"))
        large = sizes.where(F.col("n") > BLOCK).select(F.col("bucket").alias("parent"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return materialize(out, "buckets")


def links(
    docs: DataFrame, text_column: str = "text", similarity: float = SIMILARITY, recall: float = RECALL
) -> tuple[DataFrame, DataFrame]:
    """(key, links) and edges (u, v) between keys, the MD5 of texts.

    links counts the other rows, copies included, whose texts reach the
    similarity; the edges connect what is linked, with fewer rows than links.
    """
    runs = runs_for(recall, similarity, DEPTH)
    table = _path_table(docs, text_column, runs, similarity)
    buckets = _buckets(table)
    own = buckets.groupBy("key").agg(F.array_distinct(F.collect_list("bucket")).alias("buckets"))
    # A bucket of several blocks is compared pair of blocks by pair of blocks.
    i, j, other = F.col("block"), F.col("other"), F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = buckets.withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(other)).select(
        "bucket", "key", "block", F.least(i, j).alias("bi"), F.greatest(i, j).alias("bj")
    )
    seen = rows.join(table.select("key", "size", "sketch"), "key").join(own, "key")

    def may_link(block: Block, rows: pa.Table) -> pa.Table | None:
        drawn = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint16).reshape(-1, BINS)
        found = plausible(drawn, rows.column("size").to_numpy(), block.fresh(), similarity)
        either = found.any(0) | found.any(1)
        return rows.filter(pa.array(either)) if either.any() else None

    kept = [("bucket", pa.int64()), ("bi", pa.int32()), ("bj", pa.int32()), ("block", pa.int32()), ("key", pa.binary())]
    kept.append(("buckets", pa.list_(pa.int64())))
    left = materialize(
        _dealt(seen).mapInArrow(
            _by_block(may_link, pa.schema(kept)),
            "bucket long, bi int, bj int, block int, key binary, buckets array<bigint>",
        ),
        "plausible",
    )
    text = whole(quoted(text_column))
    texts = docs.select(F.unhex(F.md5(text)).alias("key"), text.alias("text"))
    keys = materialize(left.select("key").distinct(), "keys")
    if keys.count() <= BROADCAST_KEYS:  # else both sides are shuffled, texts included
        keys = F.broadcast(keys)
    texts = texts.join(keys, "key", "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            sets = [shingler.shingles(t.as_py()).view(np.int64) for t in batch.column(1)]
            arrays = [batch.column(0), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "shingles"])

    sets = texts.mapInArrow(read, "key binary, shingles array<bigint>")
    with small_batches(docs):
        sets = materialize(sets.dropDuplicates(["key"]), "sets")
    sets = sets.join(table.select("key", "copies"), "key")

    def link(block: Block, rows: pa.Table) -> pa.Table | None:
        found = linked(_longs(rows.column("shingles")), block.fresh(), similarity)
        if not found.any():
            return None
        copies = rows.column("copies").to_numpy()
        total = found @ copies + found.T @ copies
        keys = rows.column("key").to_pylist()
        roots = [keys[k] for k in _least_linked(found)]
        out = pa.table({"key": pa.array(keys, pa.binary()), "links": total, "root": pa.array(roots, pa.binary())})
        return out.filter(pa.array(total > 0))

    told = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])
    pairs = materialize(
        _dealt(left.join(sets, "key")).mapInArrow(_by_block(link, told), "key binary, links long, root binary"),
        "links",
    )
    counts = pairs.groupBy("key").agg(F.sum("links").alias("links"))
    return counts, pairs.select(F.col("key").alias("u"), F.col("root").alias("v")).where("u <> v")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """doc_id, class_id, links of every row.

    Rows are linked if the sets of their five-word shingles have a Jaccard
    similarity of 0.8 or more; links counts the other rows that a row is linked
    with, equal texts included. class_id is the smallest id of all rows connected
    by links. A text of one to four words is a single shingle. Null and wordless
    texts are linked with equal texts only. Null ids are never a class's id,
    unless all are null; repeated rows are linked with each other. An empty table
    gives an empty result.
    """
    counts, edges = links(docs, text_column, similarity, recall)
    near = components(edges).select(F.col("node").alias("key"), "root")
    rows = docs.select(
        quoted(id_column).alias("doc_id"), F.unhex(F.md5(whole(quoted(text_column)))).alias("key")
    )
    texts = rows.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    texts = texts.join(counts, "key", "left").join(near, "key", "left")
    texts = materialize(
        texts.select(
            "key",
            "least",
            F.coalesce("root", "key").alias("root"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        ),
        "texts",
    )
    classes = texts.groupBy("root").agg(F.min("least").alias("class_id"))
    return (
        rows.join(texts.join(classes, "root").select("key", "class_id", "links"), "key")
        .select("doc_id", "class_id", "links")
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id, null ids last."""
    key, row, root = (free_name(docs, c) for c in ("key", "row", "root"))
    _, edges = links(docs, text_column)
    near = components(edges).select(F.col("node").alias(key), F.col("root").alias(root))
    rows = docs.withColumns(
        {key: F.unhex(F.md5(whole(quoted(text_column)))), row: F.monotonically_increasing_id()}
    )
    rows = materialize(rows, "rows")
    slim = rows.select(key, row, quoted(id_column).alias("id")).join(near, key, "left")
    rank = F.struct(F.col("id").isNull(), "id", row)
    best = slim.groupBy(F.coalesce(root, key)).agg(F.min(rank).alias("best"))
    kept = best.select(F.col(f"best.{row}").alias(row))
    return rows.join(kept, row, "left_semi").select(*[quoted(c) for c in docs.columns])
