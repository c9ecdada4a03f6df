import hashlib
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ferry.llm import exact_dedup, sharding
from ferry.llm import words as shared
from ferry.operators import matching
from tests.llm.cases import AWKWARD, awkward, clashing, docs, empty, rows


def _normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_marks_equal_brute_force(spark):
    got = exact_dedup.mark_copies(awkward(spark)).collect()
    groups = defaultdict(list)
    for d, t, *_ in AWKWARD:
        groups[_normal(t)].append((-len(t or ""), d is None, d or 0, d))
    assert len(got) == len(AWKWARD)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): g for t, g in groups.items()}
    for r in got:
        group = by_sha[r.text_sha256]
        assert r.group_size == len(group)
        assert r.keep_id == min(group)[3]
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(list(by_sha))


def test_hash_collisions_are_told_apart_by_bytes(spark):
    few = lambda text: F.lpad(F.hex(F.length(text) % 2), 32, "0")  # noqa: E731  two hashes for all texts
    df = docs(spark, [(i, "x" * (i % 7)) for i in range(40)])
    same = exact_dedup.mark_copies(df)
    assert rows(exact_dedup.mark_copies(df, content_hash=few), *same.columns) == rows(same, *same.columns)


def test_one_group_of_a_third_of_all_rows_is_spread(spark, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false",
         spark__sql__shuffle__partitions="16")
    monkeypatch.setattr(shared, "broadcastable", lambda *_: False)
    monkeypatch.setattr(matching, "HOT_ROWS", 100)
    given = [(i, "the same" if i % 3 == 0 else f"text {i // 2}") for i in range(9000)]
    found = exact_dedup.mark_copies(docs(spark, given).repartition(8))
    sizes = [len(p) for p in found.rdd.glom().collect()]
    assert sum(sizes) == 9000 and max(sizes) <= 2 * 9000 / len(sizes)
    groups = Counter(t for _, t in given)
    first = {}
    for i, t in given:
        first.setdefault(t, i)
    want = [(i, first[t], groups[t], first[t] == i) for i, t in given]
    assert rows(found, "doc_id", "keep_id", "group_size", "kept") == want


def test_drop_copies_keeps_one_row_and_all_columns(spark):
    df = clashing(spark)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert kept.count() == len({_normal(r[1]) for r in AWKWARD})
    assert rows(kept.where("text like 'One%'"), "doc_id", "text") == [(None, "One  two three four five six seven.")]
    assert exact_dedup.drop_copies(empty(spark)).count() == 0
    assert exact_dedup.mark_copies(empty(spark)).count() == 0


def test_drop_copies_compares_bytes_as_mark_copies(spark):
    few = lambda text: F.lpad(F.hex(F.length(text) % 2), 32, "0")  # noqa: E731  two hashes for all texts
    df = docs(spark, [(i, "x" * (i % 7)) for i in range(40)])
    kept = rows(exact_dedup.mark_copies(df, content_hash=few).where("kept"), "doc_id")
    assert rows(exact_dedup.drop_copies(df, content_hash=few), "doc_id") == kept == [(i,) for i in range(7)]


def _jump(key, shards):
    key, b, j = key & (2**64 - 1), -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_equals_the_published_loop(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(2, 300), *(7**k for k in range(2, 22))]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for shards in (1, 2, 40, 41, 97):
        got = df.select("k", sharding.jump_shard(df.k, shards).alias("s")).collect()
        assert all(r.s == _jump(r.k, shards) for r in got)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    df = spark.range(20_000)
    df = df.select(sharding.jump_shard(df.id, 40).alias("a"), sharding.jump_shard(df.id, 41).alias("b"))
    moved = df.where("a <> b")
    assert moved.where("b <> 40").count() == 0
    assert abs(moved.count() - 20_000 / 41) < 100
    sizes = [r["count"] for r in df.groupBy("a").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 1.3 * 500


def test_shard_rows(spark):
    got = sharding.shard_rows(awkward(spark), 5).collect()
    assert len(got) == len(AWKWARD)
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in AWKWARD)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r.shard == _jump(r.doc_id or 0, 5) and r.grown_shard == _jump(r.doc_id or 0, 6)
        slots[r.shard].append((r.slot, r.doc_id or -1))
    for placed in slots.values():
        assert [s for s, _ in sorted(placed)] == list(range(len(placed)))
        assert [d for _, d in sorted(placed)] == sorted(d for _, d in placed)
    assert sharding.shard_rows(empty(spark), 5).count() == 0


def test_slots_of_one_hot_key(spark, conf):
    conf(spark__sql__shuffle__partitions="16")
    df = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = sharding.shard_rows(df, 40)
    assert sorted(r.slot for r in got.collect()) == list(range(5000))


def test_write_shards(spark, tmp_path):
    df = clashing(spark)
    sharding.write_shards(df, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(AWKWARD)
    assert sharding.assign_shards(df, 4, "lang", "by_lang").where("by_lang is null").count() == 0
