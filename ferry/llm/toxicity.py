"""Toxicity by class-conditional Kneser-Ney models."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.words import attach, bytes_of, free_name, quoted, whole, words
from ferry.operators.matching import broadcastable, hot_keys, match
from ferry.sources.scratch import materialize

# Rows of these remainders of crc32(id) modulo FOLDS are never learnt from, and
# those of CALIBRATE only set the scale of the score.
FOLDS, HELD_OUT, CALIBRATE = 5, 0, 1
DISCOUNT = 0.75
# The part of either model that is the shared backoff distribution.
SHARED = 0.99
# Words that a worker looks up at most, 16 bytes each; the rarest beyond are joined.
LOOKUP_WORDS = 2_000_000
# Words looked up at a time.
LOOKED_UP = 1 << 18
# Sums are rounded to so many digits, so that their order does not matter.
DIGITS = 9
# Labelled rows that the scale is fitted on, at most.
CALIBRATION_ROWS = 20_000


class Scale(NamedTuple):
    """Weights of the score's logistic function: base, mean, mean by root of length, length."""

    base: float
    mean: float
    steady: float
    length: float


def fold(id_column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(quoted(id_column).cast("string").cast("binary")), F.lit(FOLDS))


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def learnt(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, key, toxic, share and fold of the rows that are learnt from.

    Of equal texts with one label only the smallest id counts; if rows repeat id
    and text, they share one count. Unlabelled, null and held-out ids are left out.
    """
    slim = docs.select(
        quoted(id_column).alias("id"), _key(whole(quoted(text_column))).alias("key"), fold(id_column).alias("fold")
    ).where((F.col("fold") != HELD_OUT) & F.col("id").isNotNull())
    told = labels.select(quoted(id_column).alias("id"), F.col("toxic").cast("int").alias("toxic"))
    told = told.where("toxic IN (0, 1)").distinct()
    one = (
        slim.join(told, "id")
        .groupBy("key", "toxic", "id", "fold")
        .agg(F.count("*").alias("rows"))
        .groupBy("key", "toxic")
        .agg(F.min(F.struct("id", "fold", "rows")).alias("one"))
    )
    return one.select("one.id", "key", "toxic", (1 / F.col("one.rows")).alias("share"), "one.fold")


def word_counts(docs: DataFrame, rows: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word, t and o: in how many different learnt texts of each class a word stands.

    ``rows`` are those of ``learnt``; the rows that set the scale do not count.
    """
    rows = rows.where(F.col("fold") != CALIBRATE).select("id", "key", "toxic", "share")
    rows = materialize(rows, "counted")
    rows = F.broadcast(rows) if broadcastable(*bytes_of(rows)) else rows
    text = whole(quoted(text_column))
    seen = docs.select(quoted(id_column).alias("id"), _key(text).alias("key"), text.alias("text"))
    seen = seen.join(rows, ["id", "key"]).select(F.explode(F.array_distinct(words("text"))).alias("word"), "toxic", "share")
    counts = seen.groupBy("word").agg(
        F.round(F.sum(F.col("share") * F.col("toxic"))).alias("t"),
        F.round(F.sum(F.col("share") * (1 - F.col("toxic")))).alias("o"),
    )
    return materialize(counts.where("t + o > 0"), "words")


def class_probabilities(counts: DataFrame) -> DataFrame:
    """word, seen, toxic and ordinary: what each class's model gives every learnt word.

    Kneser-Ney, interpolated: a share 1 - SHARED of a model are the class's own
    counts, each less the discount, over their sum; the rest, what the discounts
    free included, is the backoff distribution that both share: the word's part of
    the backoff counts, in how many learnt texts, its contexts, each word was seen.
    So a word that a class has rarely or never is smoothed by what both have. Every
    learnt word takes part, and each class sums to 1. A class whose counts are all
    discounted away is the backoff alone. Without texts of both classes there are
    no rows.
    """
    own = {c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) for c in "to"}
    sums = counts.agg(
        F.sum("t").alias("t"), F.sum("o").alias("o"), *(F.sum(own[c]).alias(f"own_{c}") for c in "to")
    ).first()
    if not sums["t"] or not sums["o"]:
        return counts.where("false").select("word", *(F.col("t").alias(c) for c in ("seen", "toxic", "ordinary")))
    seen = F.col("t") + F.col("o")
    backoff = seen / F.lit(sums["t"] + sums["o"])

    def probability(c: str) -> Column:
        total = sums[f"own_{c}"]
        return (1 - SHARED) * own[c] / total + SHARED * backoff if total else backoff

    return counts.select("word", seen.alias("seen"), probability("t").alias("toxic"), probability("o").alias("ordinary"))


class Evidence(NamedTuple):
    """How much likelier the toxic model finds each word, as a log ratio, by the word's hash.

    The words that most texts have are in the look-up table of every worker, up to a
    fixed number of them; the others, if any, are rows.
    """

    hashes: np.ndarray
    ratios: np.ndarray
    rest: DataFrame | None


def word_evidence(counts: DataFrame, lookup_words: int = LOOKUP_WORDS) -> Evidence:
    ratio = F.log(F.col("toxic")) - F.log(F.col("ordinary"))
    level = F.floor(8 * F.log2("seen")).cast("int")
    known = class_probabilities(counts).select(F.xxhash64("word").alias("hash"), ratio.alias("ratio"), level.alias("level"))
    # Not more levels than a count has eighths of a power of two.
    sizes = sorted(((r["level"], r["count"]) for r in known.groupBy("level").count().collect()), reverse=True)
    kept, least = 0, None
    for at, size in sizes:
        if kept + size > lookup_words:
            break
        kept, least = kept + size, at
    common = known.where(F.col("level") >= least if least is not None else F.lit(False))
    found = common.select("hash", "ratio").orderBy("hash").toArrow()
    hashes, ratios = (found.column(c).to_numpy() for c in ("hash", "ratio"))
    whole_table = kept == sum(size for _, size in sizes)
    rest = None if whole_table else known.where(F.col("level") < (least if least is not None else 1 << 30)).drop("level")
    return Evidence(hashes, ratios, rest)


def _looked_up(asked: np.ndarray, hashes: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The evidence of each hash, 0 where it is not in the table, and whether it is."""
    if not len(hashes):
        return np.zeros(len(asked)), np.zeros(len(asked), bool)
    at = np.searchsorted(hashes, asked)
    at[at == len(hashes)] = 0
    hit = hashes[at] == asked
    return np.where(hit, ratios[at], 0.0), hit


def _found(docs: DataFrame, evidence: Evidence, text_column: str) -> Column:
    """struct of total (evidence of the words looked up), n (words), rest (hashes of the words not found)."""
    tables = docs.sparkSession.sparkContext.broadcast((evidence.hashes, evidence.ratios))
    leave_rest = evidence.rest is not None

    @F.arrow_udf("struct<total:double,n:bigint,rest:array<bigint>>")
    def looked_up(texts: pa.Array) -> pa.Array:
        offsets = texts.offsets.to_numpy().astype(np.int64)
        asked = texts.values.to_numpy()
        totals, ends, rest, low = [], [np.zeros(1, np.int64)], [], 0
        while low < len(texts):  # some texts at a time, at least one, to hold little
            high = max(int(np.searchsorted(offsets, offsets[low] + LOOKED_UP, "right")) - 1, low + 1)
            own = offsets[low : high + 1]
            value, hit = _looked_up(asked[own[0] : own[-1]], *tables.value)
            sums = np.concatenate([[0.0], np.cumsum(value)])[own - own[0]]
            totals.append(np.round(np.diff(sums), DIGITS))
            if leave_rest:
                rest.append(asked[own[0] : own[-1]][~hit])
                missed = np.concatenate([[0], np.cumsum(~hit)])[own - own[0]]
                ends.append(ends[-1][-1] + missed[1:])
            low = high
        none = np.zeros(len(texts) + 1, np.int32)
        bounds = np.concatenate(ends).astype(np.int32) if leave_rest else none
        left = np.concatenate(rest) if rest else np.zeros(0, np.int64)
        columns = [
            pa.array(np.concatenate(totals) if totals else np.zeros(0)),
            pa.array(np.diff(offsets), pa.int64()),
            pa.ListArray.from_arrays(bounds, pa.array(left, pa.int64())),
        ]
        pa.default_memory_pool().release_unused()
        return pa.StructArray.from_arrays(columns, ["total", "n", "rest"])

    return looked_up(F.transform(words(quoted(text_column)), lambda w: F.xxhash64(w)))


def totals(docs: DataFrame, evidence: Evidence, keep: dict[str, Column], text_column: str = "text") -> DataFrame:
    """``keep``, length (words) and total (their evidence, each time they stand there) of every row.

    A word that was not learnt says nothing. Words beyond the look-up table, which
    few texts have, are joined by hash, one that very many have all the same spread
    over many tasks; the texts themselves do not move.
    """
    found = docs.select(*(c.alias(k) for k, c in keep.items()), _found(docs, evidence, text_column).alias("found"))
    if evidence.rest is None:
        return found.select(*keep, F.col("found.n").alias("length"), F.col("found.total").alias("total"))
    # Stored, so that the numbers of rows stay the same.
    rows = materialize(found.withColumn("row", F.monotonically_increasing_id()), "found")
    rare = materialize(evidence.rest, "rare")
    more = attach(rows.select("row", F.explode("found.rest").alias("hash")), rare, "hash", "inner")
    more = more.groupBy("row").agg(F.sum("ratio").alias("more"))
    total = F.round(F.col("found.total") + F.coalesce("more", F.lit(0.0)), DIGITS)
    return rows.join(more, "row", "left").select(*keep, F.col("found.n").alias("length"), total.alias("total"))


def _features(total: np.ndarray, length: np.ndarray) -> np.ndarray:
    n = np.maximum(length, 1)
    return np.column_stack([np.ones(len(n)), total / n, total / np.sqrt(n), np.log(n)])


def fit_scale(total: np.ndarray, length: np.ndarray, toxic: np.ndarray) -> Scale:
    """Logistic regression by Newton's method with a small ridge."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    if not 0 < share < 1:
        return Scale(np.log((share + 1e-6) / (1 - share + 1e-6)), 0.0, 0.0, 0.0)
    x = _features(total, length)
    unit = x.std(axis=0)
    unit[unit == 0] = 1.0
    x = x / unit
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (toxic - p) - 0.1 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Scale(*(w / unit).tolist())


class Model(NamedTuple):
    evidence: Evidence
    scale: Scale


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Both class models from the labelled rows, and the scale of their difference.

    The scale is fitted on at most 20,000 rows that the models have not seen, the
    first by hash of their texts. Without rows of both classes the score is the
    share of toxic rows, within a millionth of 0 or 1.
    """
    rows = materialize(learnt(docs, labels, id_column, text_column), "learnt")
    evidence = word_evidence(word_counts(docs, rows, id_column, text_column))
    sample = rows.where(F.col("fold") == CALIBRATE).orderBy("key", "toxic").limit(CALIBRATION_ROWS)
    sample = materialize(sample.select("id", "key", "toxic"), "sample")
    text = whole(quoted(text_column))
    held = docs.select(quoted(id_column).alias("id"), _key(text).alias("key"), text.alias("text"))
    held = held.join(F.broadcast(sample), ["id", "key"])
    found = totals(held, evidence, {"toxic": F.col("toxic")}).select("total", "length", "toxic").collect()
    columns = np.array(found, dtype=float).reshape(-1, 3)
    return Model(evidence, fit_scale(columns[:, 0], columns[:, 1], columns[:, 2]))


def _score(scale: Scale, total: Column, length: Column) -> Column:
    n = F.greatest(length, F.lit(1))
    at = F.lit(scale.base) + scale.mean * total / n + scale.steady * total / F.sqrt(n) + scale.length * F.log(n)
    return 1 / (1 + F.exp(-at))


def score_documents(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; equal texts score alike.

    The score is a logistic function of the length-normalised difference between
    the toxic and the ordinary log-likelihood of a text. Null and empty texts have no words and get the score of no evidence. Rows that repeat an
    id are rows of their own; a null id counts as held out. An empty table gives no
    rows.
    """
    model = fit(docs, labels, id_column, text_column)
    keep = {"doc_id": quoted(id_column), "held_out": F.coalesce(fold(id_column) == HELD_OUT, F.lit(True))}
    score = _score(model.scale, F.col("total"), F.col("length"))
    scored = totals(docs, model.evidence, keep, text_column).select(*keep, score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the rows whose text scores 0.5 or more, all columns as they were.

    Scores are those of ``score_documents``: null and empty texts score as texts
    without evidence, equal texts alike whatever their ids, and a null or repeated
    id changes nothing. An empty table gives an empty result. While all learnt words
    fit the look-up table, rows are scored where they are read, and nothing moves.
    """
    model = fit(docs, labels, id_column, text_column)
    if model.evidence.rest is None:
        found = free_name(docs, "found")
        rows = docs.withColumn(found, _found(docs, model.evidence, text_column))
        return rows.where(_score(model.scale, quoted(found)["total"], quoted(found)["n"]) < 0.5).drop(found)
    key = free_name(docs, "key")
    text = whole(quoted(text_column))
    scored = totals(docs, model.evidence, {key: _key(text)}, text_column)
    bad = scored.where(_score(model.scale, F.col("total"), F.col("length")) >= 0.5).select(key).distinct()
    bad = materialize(bad, "toxic")
    rows = docs.withColumn(key, _key(text))
    if broadcastable(*bytes_of(bad)):
        return rows.join(F.broadcast(bad), key, "left_anti").drop(key)
    return match(rows, bad, key, "left_anti", hot_keys(rows, key)).drop(key)
