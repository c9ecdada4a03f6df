from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from check import connect, difference
from ferry.fixtures import AS_OF, ledger
from ferry.operators import ledger as L, matching
from suite import oracles
from tests.helpers import final_plan, plan, rows

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
NOW = datetime(2025, 1, 1)
COLUMNS = "db string, test_version double, created_at timestamp_ntz, updated_at timestamp_ntz, id int"


def make(spark, *records):
    return spark.createDataFrame(list(records), COLUMNS)


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "db string")


@pytest.fixture
def two(spark):
    """Key a: highest version is not the latest update. Key b: one row."""
    return make(
        spark, ("a", 1.5, T1, T1, 1), ("a", 1.2, T2, T3, 2), ("b", 9.9, T1, T2, 3)
    )


def test_latest_is_by_version_and_compaction_by_update(two):
    assert rows(L.latest_version(two, "id").select("db", "id")) == [("a", 1), ("b", 3)]
    assert rows(L.compact(two, "id").select("db", "id")) == [("a", 2), ("b", 3)]


def test_equal_versions_go_to_the_latest_update_then_the_highest_id(spark):
    df = make(spark, ("a", 1.0, T1, T1, 9), ("a", 1.0, T1, T2, 1), ("a", 1.0, T1, T2, 2))
    assert rows(L.latest_version(df, "id").select("id")) == [(2,)]


def test_latest_or_zero(spark, two):
    assert rows(L.latest_version_or_zero(two, keys(spark, "a", "c", "a"))) == [("a", 1.5), ("c", 0.0)]


def test_bump_steps_by_a_tenth(spark):
    df = make(spark, *[(f"k{i}", v, T1, T1, i) for i, v in enumerate((1.2, 9.9, 0.15, 0.0))])
    got = {r["db"]: r["test_version"] for r in L.bump(df, as_of=AS_OF).collect()}
    assert got == {"k0": 1.3, "k1": 10.0, "k2": 0.2, "k3": 0.1}


def test_bump_replaces_the_key_and_keeps_its_origin(spark, two):
    got = rows(L.bump(two, keys(spark, "a", "new"), as_of=AS_OF, tie_break="id"))
    assert got == [
        ("a", 1.6, T1, NOW, 1),
        ("b", 9.9, T1, T2, 3),
        ("new", 1.0, NOW, NOW, None),
    ]


def test_set_accepts_zero(spark, two):
    got = rows(L.bump(two, keys(spark, "a", "new"), 0.0, AS_OF, "id").select("db", "test_version"))
    assert got == [("a", 0.0), ("b", 9.9), ("new", 0.0)]


def test_bump_equals_append_then_prune(spark, sf):
    """With a newer ``as_of``, appending and pruning leave the same rows."""
    df = ledger(spark, sf)
    best = L.latest_version(df, "rid")
    appended = df.unionByName(
        best.withColumns({
            "test_version": F.bround(F.col("test_version") + 0.1, 1),
            "updated_at": F.lit(AS_OF).cast("timestamp_ntz"),
        })
    )
    assert rows(L.compact(appended, "rid")) == rows(L.bump(df, as_of=AS_OF, tie_break="rid"))


def test_empty_ledger(spark):
    got = rows(L.bump(make(spark), keys(spark, "a"), as_of=AS_OF))
    assert got == [("a", 1.0, NOW, NOW, None)]


def test_create_appends(spark, two):
    got = L.create(two, keys(spark, "a"), 3.0, AS_OF)
    assert got.count() == 4
    assert rows(got.filter("test_version = 3.0")) == [("a", 3.0, NOW, NOW, None)]


def test_null_keys_are_refused(spark, two):
    with pytest.raises(PySparkException, match="ledger key is NULL"):
        L.bump(two, keys(spark, None), as_of=AS_OF).collect()


def test_null_matches_nothing(two):
    assert L.of_key(two, None).count() == 0
    assert L.of_key(two, "a").count() == 2


def test_of_keys(spark, two):
    assert L.of_keys(two, keys(spark, "a", "a", "z")).count() == 2


def test_transfer_versions(spark, two):
    source = make(spark, ("a", 2.0, T1, T1, 1), ("a", 3.0, T1, T1, 2), ("zero", 0.0, T1, T1, 3))
    got = rows(L.transfer_versions(source, two, keys(spark, "a", "zero", "none"), AS_OF, "id"))
    assert got == [
        ("a", 3.0, T1, NOW, 1),
        ("b", 9.9, T1, T2, 3),
        ("none", 1.0, NOW, NOW, None),
        ("zero", 1.0, NOW, NOW, None),
    ]
    everything = L.transfer_versions(source, two, as_of=AS_OF)
    assert rows(everything.select("db")) == [("a",), ("b",), ("zero",)]


def test_string_times(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "2024-01-01T00:00:00.000Z", "2024-01-01T00:00:00.000Z")],
        "db string, test_version double, created_at string, updated_at string",
    )
    got = L.bump(df, as_of=AS_OF).first()
    assert got["created_at"] == "2024-01-01T00:00:00.000Z"
    assert got["updated_at"] == "2025-01-01T00:00:00.000Z"


def test_default_time_is_now(spark, two):
    got = L.bump(two).agg(F.min("updated_at")).first()[0]
    assert got > datetime(2025, 6, 1)


@pytest.mark.parametrize("sf, n", [("0.001", 75), ("0.01", 750)])
def test_fixture_counts(spark, sf, n):
    df = ledger(spark, f"/root/testdata/sf{sf}")
    assert L.latest_version(df, "rid").count() == n
    assert L.compact(df, "rid").count() == n
    assert L.bump(df, as_of=AS_OF).count() == n


def test_fixture_transfer(spark):
    """The recipe of FIXTURES.md section 3, against SQL."""
    sf = "/root/testdata/sf0.01"
    df = ledger(spark, sf)
    source = df.filter("rid % 2 = 0 AND rid % 5 <> 0")
    target = df.filter("rid % 2 = 1")
    wanted = df.filter("rid % 37 = 0").select("db").unionByName(keys(spark, "missing_db"))
    got = L.transfer_versions(source, target, wanted, AS_OF, "rid").drop("rid")
    sql = oracles.with_(
        oracles.LEDGER,
        "source AS (SELECT * FROM ledger WHERE rid % 2 = 0 AND rid % 5 <> 0)",
        "target AS (SELECT * FROM ledger WHERE rid % 2 = 1)",
        "keys AS (SELECT DISTINCT db FROM ledger WHERE rid % 37 = 0 UNION SELECT 'missing_db')",
        "given AS (SELECT db, max(test_version) AS v FROM source GROUP BY db)",
        oracles.best("best", "target"),
    ) + f"""SELECT {oracles.LEDGER_COLUMNS} FROM target WHERE db NOT IN (SELECT db FROM keys)
UNION ALL SELECT k.db, CASE WHEN g.v IS NULL OR g.v = 0 THEN 1.0 ELSE g.v END,
  coalesce(b.created_at, {oracles.AS_OF}), {oracles.AS_OF}
FROM keys k LEFT JOIN given g ON g.db = k.db LEFT JOIN best b ON b.db = k.db"""
    assert got.count() == 3635
    assert difference(got, connect(sf), sql) is None


# -- against the procedure for one key at a time ------------------------------


def one_key(records, key, new_version, now):
    """Append a row with the next version, then keep the latest of the key."""
    mine = [r for r in records if r[0] == key]
    if not mine:
        return records + [(key, 1.0 if new_version is None else new_version, now, now, None)]
    top = max(mine, key=lambda r: (r[1], r[3], r[4]))
    version = round(top[1] + 0.1, 1) if new_version is None else new_version
    appended = records + [(key, version, top[2], now, top[4])]
    latest = max((r for r in appended if r[0] == key), key=lambda r: r[3])
    return [r for r in appended if r[0] != key] + [latest]


moments = st.integers(1, 28).map(lambda d: datetime(2024, 1, d))
records = st.lists(
    st.tuples(st.sampled_from("abcd"), st.integers(0, 40).map(lambda n: n / 10), moments, moments),
    max_size=10,
).map(lambda rs: [(*r, i) for i, r in enumerate(rs)])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(records, st.lists(st.sampled_from("abxy"), min_size=1, max_size=3), st.sampled_from([None, 0.0, 2.5]))
def test_bump_equals_one_key_at_a_time(spark, rs, names, new_version):
    expected = rs
    for name in set(names):
        expected = one_key(expected, name, new_version, NOW)
    got = L.bump(make(spark, *rs), keys(spark, *names), new_version, AS_OF, "id")
    assert rows(got) == sorted(expected, key=lambda r: tuple(str(v) for v in r))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(records, records, st.lists(st.sampled_from("abxy"), min_size=1, max_size=3))
def test_transfer_equals_one_key_at_a_time(spark, source, target, names):
    expected = target
    for name in set(names):
        given_version = max((r[1] for r in source if r[0] == name), default=None)
        expected = one_key(expected, name, given_version or 1.0, NOW)
    got = L.transfer_versions(make(spark, *source), make(spark, *target), keys(spark, *names), AS_OF, "id")
    assert rows(got) == sorted(expected, key=lambda r: tuple(str(v) for v in r))


# -- hot keys ----------------------------------------------------------------


def hot_ledger(spark, n=600_000):
    """A third of all rows belongs to one key."""
    i = F.col("id")
    return spark.range(0, n, 1, 8).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), i % 50_000)).alias("db"),
        (i % 77 / 10).alias("test_version"),
        F.timestamp_seconds(i * 7919 % 1_000_003).cast("timestamp_ntz").alias("created_at"),
        F.timestamp_seconds(i * 104729 % 1_000_003).cast("timestamp_ntz").alias("updated_at"),
        i.alias("rid"),
    )


@pytest.fixture
def large(conf, monkeypatch):
    """Act as if keys were too many to broadcast."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(L, "FILTER_KEYS", 0)
    monkeypatch.setattr(matching, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(matching, "HOT_ROWS", 10_000)


def largest_share(df):
    """The largest part of the rows in one partition."""
    counts = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_hot_keys_are_found(spark, large):
    df = hot_ledger(spark, 60_000)
    assert matching.hot_keys(df, "db") == ["hot"]
    assert matching.hot_keys(df.filter("db <> 'hot'"), "db") == []


def test_hot_key_is_spread_in_the_join(spark, large, conf):
    """A key with a third of the rows does not meet in one task."""
    conf(spark__sql__adaptive__enabled="false")
    df = hot_ledger(spark)
    some = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("db"))
    plain = matching.match(df, some, "db", "left_anti")
    spread = matching.match(df, some, "db", "left_anti", ["hot"])
    assert largest_share(plain) > 0.45
    assert largest_share(spread) < 0.32  # four partitions
    assert plain.count() == spread.count()
    same = df.select(F.lit("hot").alias("db"), F.lit(1).alias("v"))  # equal rows only
    assert largest_share(matching.match(same, some, "db", "left_anti", ["hot"])) < 0.6
    both = some.unionByName(keys(spark, "hot"))
    for how in ("left_semi", "left_anti"):
        a, b = (matching.match(df, both, "db", how, hot) for hot in ((), ["hot"]))
        assert a.count() == b.count()
        assert a.agg(F.sum(F.hash(*df.columns))).first() == b.agg(F.sum(F.hash(*df.columns))).first()


def test_null_keys_are_spread_too(spark, large, conf):
    conf(spark__sql__adaptive__enabled="false")
    df = hot_ledger(spark).withColumn("db", F.when(F.col("db") != "hot", F.col("db")))
    some = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("db"))
    assert matching.hot_keys(df, "db") == [None]
    kept = L.replace_by_key(df, df.limit(0).unionByName(df.filter("false")), "db")
    assert kept.count() == df.count()
    spread = matching.match(df, some, "db", "left_anti", [None])
    assert largest_share(spread) < 0.32
    assert spread.filter("db IS NULL").count() == 200_000
    assert matching.match(df, some, "db", "left_semi", [None]).filter("db IS NULL").count() == 0


def test_large_bump_counts_in_the_same_pass(spark, large, monkeypatch):
    def never(*a):
        raise AssertionError("the ledger was counted once more")

    monkeypatch.setattr(L, "hot_keys", never)
    df = hot_ledger(spark)
    some = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("db"))
    moved = L.bump(df, some, as_of=AS_OF, tie_break="rid")
    assert "_place" in plan(moved)
    # 200,000 hot rows stay, and each touched key keeps one row of its eight.
    touched = df.filter("db <> 'hot' AND substr(db, 2) < 20000")
    assert moved.count() == df.count() - touched.count() + 20_000


def test_small_updates_are_broadcast_and_the_ledger_is_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "ledger")
    hot_ledger(spark, 50_000).write.parquet(path)
    text = final_plan(L.bump(spark.read.parquet(path), keys(spark, "hot", "k1"), as_of=AS_OF))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text
    text = final_plan(L.of_keys(spark.read.parquet(path), keys(spark, *[f"k{i}" for i in range(2000)])))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_few_keys_become_a_filter(spark, tmp_path):
    path = str(tmp_path / "ledger")
    hot_ledger(spark, 5000).write.parquet(path)
    df = spark.read.parquet(path)
    few = plan(L.of_keys(df, keys(spark, "hot", "k1")))
    assert "PushedFilters: [In(db, [hot,k1])]" in few or "PushedFilters: [In(db, [k1,hot])]" in few
    assert L.of_keys(df, keys(spark)).count() == 0


@pytest.mark.parametrize("filter_keys, broadcast_bytes, hot_rows", [
    (1000, 0, 1), (0, 1 << 20, 1), (0, 0, 10), (0, 0, 1 << 40),
])
def test_every_way_gives_the_same_rows(
    spark, sf, monkeypatch, filter_keys, broadcast_bytes, hot_rows
):
    df = ledger(spark, sf)
    some = df.filter("db LIKE 'c%'").select("db").unionByName(keys(spark, "absent"))
    source = df.withColumn("test_version", F.col("test_version") + 1)

    def outcomes():
        return [
            rows(L.of_keys(df, some)),
            rows(L.latest_version_or_zero(df, some)),
            rows(L.bump(df, some, as_of=AS_OF, tie_break="rid")),
            rows(L.transfer_versions(source, df, some, AS_OF, "rid")),
            rows(L.transfer_versions(source, df, None, AS_OF, "rid")),
        ]

    expected = outcomes()
    monkeypatch.setattr(L, "FILTER_KEYS", filter_keys)
    monkeypatch.setattr(matching, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(matching, "HOT_ROWS", hot_rows)
    assert outcomes() == expected


def test_per_key_choices_reduce_before_the_shuffle(spark):
    df = hot_ledger(spark, 1000)
    assert "partial_max" in final_plan(L.compact(df, "rid"))
    versions = final_plan(L.highest_versions(df))
    assert "HashAggregate" in versions and "SortAggregate" not in versions
