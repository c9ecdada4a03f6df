import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ferry.llm import filter_audit as audit
from ferry.llm import words as shared
from ferry.operators import matching
from tests.llm.cases import LABELS, awkward, clashing, docs, empty, rows

COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def fails(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
    }


def expected(given, labels=()):
    """Brute force: every order is applied to every document."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    all_docs = []
    for key, text, lang in given:
        found = fails(text)
        found["E"] = key is not None and any(
            k is not None and k < key and (t or "") == (text or "") for k, t, _ in given
        )
        all_docs.append((lang or "", key, {f for f in found if found[f]}))
    out, shapley = [], Counter()
    for part in {d[0] for d in all_docs}:
        mine = [d for d in all_docs if d[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[2]]
                earlier = [d for d in mine if f in d[2] and d not in left]
                left = [d for d in left if f not in d[2]]
                shapley[part, f] += len(gone)
                out.append([
                    part, order, step, len(left), len(gone),
                    sum(f in d[2] for d in mine) - len(gone),
                    sum(d[2] == {f} for d in mine),
                    sum(d[1] in good for d in gone), sum(d[1] in toxic for d in gone),
                ])
                assert len(earlier) <= out[-1][5]
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def corpus(seed, n):
    draw = random.Random(seed)
    texts = [
        " ".join(draw.choice(("alpha", "Beta", "GAMMA", "x#1", "y")) + str(draw.randrange(draw.choice((3, 400))))
                 for _ in range(draw.choice((3, 150, 250))))
        for _ in range(n // 2)
    ]
    given = [(i, draw.choice(texts), draw.choice(("en", "de", None, ""))) for i in range(n)]
    labels = [(draw.randrange(n), draw.choice((0, 1, None)), draw.choice((0, 1, None))) for _ in range(n)]
    return given, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_brute_force(spark, seed):
    given, labels = corpus(seed, 80)
    found = audit.audit(docs(spark, given), spark.createDataFrame(labels, LABELS))
    assert rows(found, *COLUMNS) == expected(given, labels)


def test_awkward_clashing_and_empty_tables(spark):
    none = empty(spark, LABELS)
    given = [(r["doc_id"], r["text"], r["lang"]) for r in awkward(spark).collect()]
    want = expected(given)
    assert rows(audit.audit(awkward(spark), none), *COLUMNS) == want
    assert rows(audit.audit(clashing(spark).withColumn("part", F.lit(1)), none), *COLUMNS) == want
    assert audit.audit(empty(spark), none).collect() == []
    nulls = spark.createDataFrame([(None, 1, 1), (1, None, None)], LABELS)
    assert rows(audit.audit(awkward(spark), nulls), *COLUMNS) == want


def test_rows_that_repeat_an_id_are_no_copies_of_each_other(spark):
    given = [(1, "same", "en"), (1, "same", "en"), (2, "same", "de"), (None, "same", "en")]
    found = audit.cells(docs(spark, given), empty(spark, LABELS))
    copies = found.where(F.col("mask").bitwiseAND(16) != 0)
    assert rows(copies, "part", "n") == [("de", 1)]


def test_all_orders_of_other_filters(spark):
    filters = {"x": F.length("text") > 3, "y": F.col("text").contains("a")}
    given = [(1, "aaaa", "en"), (2, "a", "en"), (3, "bbbb", "en"), (4, "bbbb", "en")]
    found = audit.audit(docs(spark, given), empty(spark, LABELS), filters, copies="z")
    assert found.count() == 18
    steps = rows(audit.removals(found, "xyz"), "step", "filter", "removed", "redundant", "kept")
    assert steps == [(1, "x", 3, 0, 1), (2, "y", 1, 1, 0), (3, "z", 0, 1, 0)]
    assert {r["shapley"] for r in found.where("step = 1 AND filter_order LIKE 'x%'").collect()} == {6 + 3 + 3}
    with pytest.raises(ValueError, match="two filters"):
        audit.audit(docs(spark, given), empty(spark, LABELS), filters, copies="x")
    with pytest.raises(ValueError, match="too many orders"):
        audit.fold_orders(found, "ABCDEFG")


def test_attach_spreads_hot_keys(spark, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false",
         spark__sql__shuffle__partitions="16")
    monkeypatch.setattr(shared, "broadcastable", lambda *_: False)
    monkeypatch.setattr(matching, "HOT_ROWS", 100)
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("key"), "id"
    ).repartition(8)
    right = spark.range(0, 30_000, 2).select(F.col("id").alias("key"), (-F.col("id")).alias("value"))
    for how in ("left", "inner"):
        found = shared.attach(left, right, "key", how)
        assert rows(found, "id", "value") == rows(left.join(right, "key", how), "id", "value")
        sizes = [len(p) for p in found.rdd.glom().collect()]
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)
