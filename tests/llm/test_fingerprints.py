import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ferry.llm import fingerprints as fp
from tests.llm.cases import LONG, awkward, clashing, docs, empty, rows
from tests.llm.test_text import _words as found_words


def hashes(text):
    words = found_words(text)
    runs = [words[i : i + 5] for i in range(max(len(words) - 4, 1))] if words else []
    return {sum(zlib.crc32(w.encode()) * p for w, p in zip(run, fp.PLACES)) % fp.RANGE for run in runs}, len(runs)


def brute(text, fraction=fp.FRACTION):
    found, n = hashes(text)
    whole = n <= fp.WHOLE
    return whole, sorted(h for h in found if whole or h < fp.RANGE // fraction)


def alike(a, b, fraction=fp.FRACTION):
    sets = [set(h) for _, h in (a, b)]
    if a[0] != b[0]:
        sets = [{h for h in s if h < fp.RANGE // fraction} for s in sets]
    if not sets[0] | sets[1]:
        return 1.0 if a[0] and b[0] else 0.0
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def written(found):
    return f"{1 if found[0] else fp.FRACTION}:" + "".join(f"{h:014x}" for h in found[1])


def prose(seed, n, vocabulary=2000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def test_fingerprint_equals_brute_force(spark):
    texts = ["", " .;", "one", "One, two three FOUR", "a b c d e", "ünïcode Straße 日本語 x y z", LONG]
    texts += [prose(i, n) for i, n in enumerate((5, 6, 67, 68, 69, 70, 500, 3000))] + [prose(1, 90, 3)]
    df = fp.with_fingerprint(docs(spark, list(enumerate(texts))), "text", "found")
    got = {r["doc_id"]: (r["found"]["whole"], r["found"]["hashes"]) for r in df.collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_many_words_in_a_batch(spark, monkeypatch):
    monkeypatch.setattr(fp, "HASHED", 100)
    test_fingerprint_equals_brute_force(spark)


def expected(spark, given):
    """Brute force over (doc_id, text) in the documented order."""
    spread = {r[0]: r[1] for r in docs(spark, [(0, t or "") for _, t in given]).select("text", F.xxhash64("text")).collect()}
    order = sorted(given, key=lambda r: (r[0] is None, -(r[0] or 0), spread[r[1] or ""], r[1] or ""))
    out = []
    for i, (key, text) in enumerate(order):
        text, other = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        a, b, c = brute(text), brute(edited), brute(other)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((key, len(text), digest, written(a), written(b), alike(a, b), alike(a, c)))
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


COLUMNS = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_compare_equals_brute_force(spark, conf, partitions):
    conf(spark__sql__shuffle__partitions=partitions)
    given = [(i * 7 % 50, prose(i % 20, 3 + i * 9)) for i in range(50)] + [(None, "x"), (None, "y z"), (7, "again")]
    given += [(60, "日本語 ünï " * 40), (61, None), (62, ""), (63, "ab")]
    assert rows(fp.compare_edited(docs(spark, given)), *COLUMNS) == expected(spark, given)


def test_awkward_clashing_single_and_empty_tables(spark):
    given = [(r[0], r[1]) for r in awkward(spark).collect()]
    want = expected(spark, given)
    assert rows(fp.compare_edited(awkward(spark)), *COLUMNS) == want
    assert rows(fp.compare_edited(clashing(spark)), *COLUMNS) == want
    one = [(5, "one two three four five six seven eight nine ten")]
    assert rows(fp.compare_edited(docs(spark, one)), *COLUMNS) == expected(spark, one)
    assert fp.compare_edited(empty(spark)).collect() == []


def test_small_batches_meet(spark, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="2")
    given = [(i, prose(i, 20 + i)) for i in range(30)]
    assert rows(fp.compare_edited(docs(spark, given)), *COLUMNS) == expected(spark, given)


def test_texts_move_once(spark, sf):
    df = fp.compare_edited(spark.read.parquet(f"{sf}/documents.parquet"))
    used = df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")))
    used.collect()
    plan = used._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange rangepartitioning") - plan.count("ReusedExchange") <= 1


def test_estimates_between_unequal_texts(spark):
    large = prose(1, 20_000, 50_000)
    part = " ".join(large.split()[4000:5000])
    half = " ".join(large.split()[:500]) + " " + prose(2, 500, 50_000)
    df = docs(spark, [(1, large), (2, part), (3, half)])
    found = fp.with_fingerprint(df, "text", "f").select("doc_id", "f")
    ask, hold = (found.select(F.col("doc_id").alias(c), F.col("f").alias(f"f{c}")) for c in "ab")
    pairs = ask.where("a > 1").join(hold.where("b = 1"))
    got = dict(pairs.select("a", fp.containment(F.col("fa"), F.col("fb"))).collect())
    assert got[2] == 1.0 and abs(got[3] - 0.5) < 0.15
    sketched = fp.sketch(df, "doc_id")
    by_rows = fp.contained(sketched.where("key > 1"), sketched.where("key = 1")).collect()
    assert {r["asked"]: r["containment"] for r in by_rows} == pytest.approx(got)


def test_sketches_merge(spark):
    given = [(i, prose(i % 9, 300), "en", f"s{i % 3}") for i in range(30)] + [(99, None, None, None)]
    df = docs(spark, given)
    at_once = rows(fp.sketch(df, "source"), "key", "hash")
    groups = df.select(F.col("doc_id").alias("key"), F.col("source").alias("group"))
    assert rows(fp.merge(fp.sketch(df, "doc_id"), groups), "key", "hash") == at_once
    brute_force = {(s, h) for _, t, _, s in given if t for h in hashes(t)[0] if h < fp.RANGE // fp.FRACTION}
    assert set(at_once) == brute_force
    assert fp.sketch(empty(spark), "doc_id").collect() == []
