"""SentencePiece text: unigram Viterbi over a double-array trie, and back."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.llm.token_counts import file_bytes
from ferry.llm.words import free_name, quoted, whole

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed values of the format: the blank's stand-in, and how much worse than the
# worst piece an unknown character is.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
# Text a worker encodes at a time, and chunks whose pieces it remembers.
SLICE_CHARS = 250_000
REMEMBERED = 100_000


class DoubleArray:
    """A byte trie: the child of node s by byte c is base[s] + c + 1, if check agrees."""

    def __init__(self, keys: dict[bytes, int]):
        root: dict = {}
        for key, value in keys.items():
            node = root
            for byte in key:
                node = node.setdefault(byte, {})
            node[-1] = value
        base, check, value = [0], [0], [-1]

        def grow(upto: int) -> None:
            if upto >= len(check):
                more = upto + 1024 - len(check)
                base.extend([0] * more)
                check.extend([-1] * more)
                value.extend([-1] * more)

        free, top, queue = 257, 257, [(0, root)]  # from 257 on any byte fits any hole
        for place, node in queue:  # the queue grows as it is read
            value[place] = node.get(-1, -1)
            labels = sorted(c for c in node if c >= 0)
            if not labels:
                continue
            grow(max(free, top) + 1024)
            while check[free] >= 0:
                free += 1
                grow(free + 1024)
            # Single children fill the holes; families go near the end, where there is room.
            at = max((free if len(labels) == 1 else max(free, top - 256)) - labels[0] - 1, 0)
            while any(check[at + c + 1] >= 0 for c in labels):
                at += 1
                grow(at + 1024)
            base[place] = at
            for c in labels:
                check[at + c + 1] = place
                queue.append((at + c + 1, node[c]))
            top = max(top, at + labels[-1] + 1)
        grow(top + 512)  # a look-up never leaves the arrays
        self.base = np.array(base, np.int32)
        self.check = np.array(check, np.int32)
        self.value = np.array(value, np.int32)


class Pieces:
    """The pieces of a model file, ready for encoding; sent to each worker once."""

    def __init__(self, model: bytes):
        import sentencepiece

        read = sentencepiece.SentencePieceProcessor()
        read.LoadFromSerializedProto(model)
        ids = range(read.get_piece_size())
        normal = {
            read.id_to_piece(i): i
            for i in ids
            if not (read.is_control(i) or read.is_unknown(i) or read.is_byte(i) or read.is_unused(i))
        }
        self.scores = np.array([read.get_score(i) for i in ids])
        self.unknown = read.unk_id()
        self.byte_ids = np.full(256, self.unknown, np.int32)
        self.surface = [read.id_to_piece(i).replace(SPACE, " ").encode() for i in ids]
        for i in ids:
            if read.is_byte(i):
                byte = int(read.id_to_piece(i)[1:-1], 16)
                self.byte_ids[byte] = i
                self.surface[i] = bytes([byte])
            elif read.is_control(i):
                self.surface[i] = b""
        self.unknown_score = float(self.scores[list(normal.values())].min()) - UNKNOWN_PENALTY
        self.trie = DoubleArray({p.encode(): i for p, i in normal.items()})
        # Pieces end before a blank that follows something else, and never hold a
        # line break: text may be cut there without changing the best path.
        self.cuts_at_blanks = not any(SPACE in p.lstrip(SPACE) for p in normal)
        alone = "" if any("\n" in p for p in normal) else "\n"
        other = f"[^{SPACE}{alone}]"
        self.chunk = re.compile(
            (f"{alone}|" if alone else "") + f"{SPACE}+{other}*|{other}+" if self.cuts_at_blanks else r"(?s).+"
        )

    def chunks(self, text: str) -> list[str]:
        """Parts of a text whose best paths do not depend on each other."""
        return self.chunk.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best path of every chunk, one after the other, and their counts.

        The trie is walked from all characters of all chunks at once; the best
        scores then spread from left to right through all chunks together. Of
        equal paths the one whose last piece is longest wins, as in the format's
        own encoder. A character without a piece becomes its bytes.
        """
        n = len(chunks)
        data = np.frombuffer(b"".join(chunks), np.uint8)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        lengths = np.fromiter(map(len, chunks), np.int64, n)
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(n), lengths)
        end = (starts + lengths)[owner]
        first = np.flatnonzero((data & 0xC0) != 0x80)
        width = np.append(first[1:], len(data)) - first
        known = np.zeros(len(data), bool)
        char_end = np.zeros(len(data), np.int64)
        char_end[first] = first + width

        begin, at, node = first, first, np.zeros(len(first), np.int32)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(begin):
            child = self.trie.base[node] + data[at] + 1
            ok = self.trie.check[child] == node
            begin, at, node = begin[ok], at[ok] + 1, child[ok]
            value = self.trie.value[node]
            hit = value >= 0
            found.append((begin[hit], at[hit], value[hit]))
            single = at[hit] == char_end[begin[hit]]
            known[begin[hit][single]] = True
            more = at < end[begin]
            begin, at, node = begin[more], at[more], node[more]
        odd = first[~known[first]]
        found.append((odd, char_end[odd], np.full(len(odd), -1, np.int32)))
        begin, to, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        score = np.where(piece >= 0, self.scores[piece], self.unknown_score)

        own = owner[begin]
        place = to - starts[own]
        order = np.lexsort((to - begin, place))
        begin, to, piece, score, own, place = (x[order] for x in (begin, to, piece, score, own, place))
        left, right = begin + own, to + own  # a chunk has a place more than bytes
        best = np.full(len(data) + n, -np.inf)
        back = np.zeros(len(data) + n, np.int64)
        best[starts + np.arange(n)] = 0.0
        edges = np.append(np.flatnonzero(np.diff(place, prepend=0)), len(place))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            reached = best[left[a:b]] + score[a:b]
            into = right[a:b]
            np.maximum.at(best, into, reached)
            won = reached >= best[into]
            back[into[won]] = np.flatnonzero(won) + a  # the last one, the longest, stays

        here = starts + lengths + np.arange(n)
        stop = (starts + np.arange(n))[lengths > 0]
        here = here[lengths > 0]
        path = []
        while len(here):
            step = back[here]
            path.append(step)
            here = left[step]
            on = here != stop
            here, stop = here[on], stop[on]
        path = np.concatenate(path)
        path = path[np.argsort(begin[path], kind="stable")]
        many = np.where(piece[path] >= 0, 1, to[path] - begin[path])
        from_ = np.repeat(path, many)
        inner = np.arange(len(from_)) - np.repeat(np.cumsum(many) - many, many)
        ids = np.where(piece[from_] >= 0, piece[from_], self.byte_ids[data[begin[from_] + inner * (piece[from_] < 0)]])
        counts = np.bincount(own[path], weights=many, minlength=n).astype(np.int64)
        return ids.astype(np.int32), counts

    def decode(self, ids) -> str:
        """The text of ``ids``: stand-ins become blanks, byte pieces become characters."""
        data = b"".join([self.surface[i] for i in ids])
        text = data.decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


class _Memory:
    """Ids of chunks seen before in this task, forgotten when they are too many."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids, self.starts, self.counts = (np.zeros(0, np.int32), *(np.zeros(0, np.int64) for _ in "ab"))

    def slice(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``texts``, one after the other, and their counts."""
        if len(self.slots) > REMEMBERED:
            self.clear()
        known, slots = len(self.slots), self.slots
        per_text, seen = [], []
        for text in texts:
            chunks = self.pieces.chunks(text)
            per_text.append(len(chunks))
            seen += [slots.setdefault(c, len(slots)) for c in chunks]
        new = [c.encode() for c in list(slots)[known:]]
        if new:
            ids, counts = self.pieces.encode(new)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids])
        seen = np.array(seen, np.int64)
        many = self.counts[seen] if len(seen) else seen
        inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        flat = self.ids[np.repeat(self.starts[seen], many) + inner] if len(seen) else np.zeros(0, np.int32)
        text_of = np.repeat(np.arange(len(texts)), per_text)
        return flat, np.bincount(text_of, weights=many, minlength=len(texts)).astype(np.int64)


def _slices(texts: pa.ChunkedArray) -> Iterator[list[str]]:
    part, chars = [], 0
    for value in texts:
        text = value.as_py()
        part.append(text)
        chars += len(text)
        if chars >= SLICE_CHARS:
            yield part
            part, chars = [], 0
    if part:
        yield part


def encode_documents(docs: DataFrame, model_path: str = MODEL, text_column: str = "text") -> DataFrame:
    """``docs`` with ids, n_tokens and round_trip: whether the ids decode to the text.

    Null and empty texts have no ids and decode to the empty text. A text that
    holds the blank's stand-in itself decodes to a blank there: round_trip is
    false. Rows stand for themselves, so repeated ids and rows do no harm. New
    columns whose names are taken get an underscore. An empty table gives an
    empty result. A worker encodes some texts at a time, each of them whole.
    """
    spark = docs.sparkSession
    pieces = spark.sparkContext.broadcast(Pieces(file_bytes(spark, model_path)))
    ids_name, n_name, ok_name = (free_name(docs, c) for c in ("ids", "n_tokens", "round_trip"))
    row = free_name(docs, "whole_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = pieces.value
        memory = _Memory(tool)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            done = 0
            for part in _slices(table.column(row)):
                flat, counts = memory.slice(part)
                ends = np.cumsum(counts)
                listed = flat.tolist()
                fine = [
                    tool.decode(listed[e - c : e]) == t
                    for t, e, c in zip(part, ends.tolist(), counts.tolist(), strict=True)
                ]
                out = table.slice(done, len(part)).drop_columns([row])
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                out = out.append_column(ids_name, pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())))
                out = out.append_column(n_name, pa.array(counts, pa.int64()))
                out = out.append_column(ok_name, pa.array(fine, pa.bool_()))
                done += len(part)
                yield from out.combine_chunks().to_batches()
            pa.default_memory_pool().release_unused()

    given = docs.withColumn(row, whole(quoted(text_column)))
    new = T.StructType().add(ids_name, T.ArrayType(T.IntegerType())).add(n_name, "long").add(ok_name, "boolean")
    schema = T.StructType([*docs.schema.fields, *new.fields])
    return given.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, model_path: str = MODEL, ids_column: str = "ids") -> DataFrame:
    """``encoded`` with decoded: the text of the ids; null ids decode to empty text."""
    spark = encoded.sparkSession
    pieces = spark.sparkContext.broadcast(Pieces(file_bytes(spark, model_path)))

    @F.udf("string", useArrow=True)
    def decoded(ids):
        return pieces.value.decode(ids if ids is not None else [])

    return encoded.withColumn(free_name(encoded, "decoded"), decoded(quoted(ids_column)))
