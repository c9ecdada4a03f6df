"""Stores changed by key: folders, tables, appended users; and content that is verified."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ferry.fixed_values import LEDGER_CONTAINER
from ferry.operators import verification as check
from ferry.plans.transfer import Stores, TransferError
from ferry.sources import keyed, objects, tables
from ferry.sources.endpoint import Endpoint
from ferry.sources.scratch import materialize
from suite.queries import _with_changed_files, all_queries
from tests.helpers import derby, rows

LEDGER = "db string, test_version double, created_at timestamp_ntz, updated_at timestamp_ntz, rid bigint"
T = [f"2024-01-0{i} 00:00:00" for i in range(1, 9)]


def ledger(spark, given):
    df = spark.createDataFrame(given, LEDGER.replace("timestamp_ntz", "string"))
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")})


def some(spark, n=40):
    given = [(f"k{i % 20}", i / 10, T[i % 5], T[i % 7], i) for i in range(n)] + [("null times", 1.0, None, None, 99)]
    return ledger(spark, given)


@pytest.fixture(params=["parquet", "json"])
def folder(spark, tmp_path, request):
    df = some(spark)
    store = Endpoint("mongodb", request.param, str(tmp_path / "s"), schemas={"l": df.schema})
    stores = Stores(spark, [store])
    stores.write(df, "mongodb", "l", "overwrite")
    assert stores.key_ledger("mongodb", "l", buckets=8) == df.count()
    return stores, store.path("l")


def keys_df(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "db string")


def files(spark, path):
    return {r["name"]: (r["size"], r["last_modified"]) for r in objects.inventory(spark, path).collect() if "part-" in r["name"]}


def test_bump_touches_only_folders_of_the_keys(spark, folder):
    stores, path = folder
    before, was = files(spark, path), rows(stores.read_ledger("mongodb", "l"))
    layout = keyed.keyed_layout(spark, path)
    keys = keys_df(spark, "k3", "new", "k3")
    moved = keyed.touched(keys, layout)
    assert 1 <= len(moved) <= 2
    written = stores.bump_versions("mongodb", keys, None, "l", as_of=T[7], tie_break="rid")
    after = files(spark, path)
    elsewhere = {f: v for f, v in before.items() if not any(f"_bucket={b}/" in f for b in moved)}
    assert elsewhere and elsewhere.items() <= after.items()
    now = rows(stores.read_ledger("mongodb", "l"))
    assert [r for r in now if r[0] not in ("k3", "new")] == [r for r in was if r[0] != "k3"]
    mine = {r[0]: r for r in now if r[0] in ("k3", "new")}
    assert mine["k3"][1] == 2.4 and mine["k3"][4] == 23 and mine["new"][1] == 1.0
    assert written == sum(1 for r in now if r[0] in mine) + sum(
        1 for r in was if r[0] not in mine and keyed.touched(keys_df(spark, r[0]), layout)[0] in moved
    )


def test_files_of_folders_by_key_are_listed_once(spark, folder, tmp_path):
    names = [r["name"] for r in objects.inventory(spark, folder[1]).collect()]
    there = [p for p in (tmp_path / "s" / "l").rglob("*") if p.is_file() and not p.name.endswith(".crc")]
    assert sorted(n.rsplit("/", 1)[1] for n in names) == sorted(p.name for p in there)
    assert "_layout.json" in {n.rsplit("/", 1)[1] for n in names}


def test_changed_files_are_counted_without_markers(spark, tmp_path):
    stores = Stores(spark, [Endpoint("postgresql", "parquet", str(tmp_path / "s"))])
    stores.write(some(spark), "postgresql", LEDGER_CONTAINER)
    stores.key_ledger("postgresql", buckets=8)
    path = stores.endpoint("postgresql").path(LEDGER_CONTAINER)
    before = materialize(objects.inventory(spark, path), "listed")
    keys = keys_df(spark, "k3")

    def seen():
        got = _with_changed_files(spark, stores, keys, path, before)
        return {tuple(r) for r in got.select("changed_elsewhere", "some_elsewhere").collect()}

    stores.bump_versions("postgresql", keys, as_of=T[7], tie_break="rid")
    assert seen() == {(0, True)}
    moved = keyed.touched(keys, keyed.keyed_layout(spark, path))
    other = next(p for p in sorted(tmp_path.rglob("part-*")) if f"_bucket={moved[0]}" not in p.parts)
    os.utime(other, (1_600_000_000, 1_600_000_000))
    assert seen() == {(1, True)}


def test_many_moved_keys_leave_folders_alone(spark, tmp_path):
    n = F.col("id")
    spark.range(0, 80_000, 10).select(
        n.alias("event_id"), F.lit(T[0]).cast("timestamp_ntz").alias("ts"), n.alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(12.0).alias("value"),
    ).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(5).select(n.alias("r_regionkey")).write.parquet(str(tmp_path / "region.parquet"))
    got = all_queries()["ledger_bump_store"](spark, str(tmp_path))
    found = {tuple(r) for r in got.select("changed_elsewhere", "some_elsewhere").distinct().collect()}
    assert found == {(0, True)}
    assert got.count() == 8005 and got.where("test_version = 1.3").count() > 400


def test_other_calls_keep_the_ledger_keyed(spark, folder):
    stores, path = folder
    before = files(spark, path)
    assert stores.create_versions("mongodb", keys_df(spark, "k1", "z"), 7.0, "l", as_of=T[7]) == 2
    assert before.items() <= files(spark, path).items()
    assert stores.latest_version("mongodb", "k1", "l") == 7.0
    stores.bump_versions("mongodb", None, 3.0, "l", as_of=T[7])
    assert keyed.keyed_layout(spark, path).buckets == 8
    got = stores.read_ledger("mongodb", "l")
    assert got.columns == ["db", "test_version", "created_at", "updated_at", "rid"]
    assert {r[1] for r in rows(got)} == {3.0} and got.count() == 22
    stores.create_versions("mongodb", keys_df(spark, "k1"), 9.0, "l", as_of="2025-01-01")
    before = files(spark, path)
    assert stores.compact_ledger("mongodb", "l") >= 1
    assert len(set(before.items()) & set(files(spark, path).items())) >= len(before) - 2
    assert stores.latest_version("mongodb", "k1", "l") == 9.0 and stores.read_ledger("mongodb", "l").count() == 22


def test_replace_keys_by_nothing_empties_folders(spark, tmp_path):
    path = str(tmp_path / "k")
    df = some(spark)
    keyed.write_keyed(df, path, "parquet", "db", 64)
    gone = keys_df(spark, *[f"k{i}" for i in range(19)], "never")
    keyed.replace_keys(spark, path, "parquet", df.where("db = 'k1' AND rid = 1"), gone)
    assert {r[0] for r in rows(keyed.read_keyed(spark, path, "parquet"))} == {"k1", "k19", "null times"}
    with pytest.raises(ValueError, match="not to be replaced"):
        keyed.replace_buckets(df, path, "parquet", [0])


def test_reading_some_folders_prunes(spark, tmp_path):
    path = str(tmp_path / "k")
    keyed.write_keyed(some(spark), path, "parquet", "db", 8)
    plan = keyed.read_keyed(spark, path, "parquet", [3])._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_hot_keys_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "k")
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("key"), "id")
    keyed.write_keyed(df, path, "parquet", "key", 4)
    keys = spark.createDataFrame([(1,)], "key bigint")
    keyed.replace_keys(spark, path, "parquet", spark.createDataFrame([(1, -1)], "key bigint, id bigint"), keys)
    got = keyed.read_keyed(spark, path, "parquet")
    assert got.where("key IS NULL").count() == 1000 and rows(got.where("key = 1")) == [(1, -1)]


# -- tables ------------------------------------------------------------------

DDL = """CREATE TABLE "l" ("id" BIGINT GENERATED ALWAYS AS IDENTITY, "db" VARCHAR(255), "test_version" DOUBLE,
"created_at" TIMESTAMP, "updated_at" TIMESTAMP)"""


def table_store(spark, given):
    db = derby()
    tables.execute(spark, db, DDL)
    tables.write_table(ledger(spark, given).drop("rid"), db, "l")
    return Stores(spark, [db]), db


def test_table_rows_of_other_keys_keep_their_ids(spark):
    given = [("a", 1.0, T[0], T[1], 0), ("a", 1.5, T[0], T[2], 0), ("b", 2.0, T[0], T[1], 0), ("c", 3.0, T[0], None, 0)]
    stores, db = table_store(spark, given)
    ids = {r["db"]: r["id"] for r in stores.read("postgresql", "l").collect()}
    assert stores.bump_versions("postgresql", keys_df(spark, "a", "c", "new"), None, "l", as_of=T[7], tie_break="id") == 4
    now = {r["db"]: r for r in stores.read("postgresql", "l").collect()}
    assert len(now) == stores.read("postgresql", "l").count() == 4
    assert {k: r["test_version"] for k, r in now.items()} == {"a": 1.6, "b": 2.0, "c": 3.1, "new": 1.0}
    assert now["b"]["id"] == ids["b"] and now["a"]["id"] > max(ids.values())
    assert str(now["a"]["created_at"]) == T[0]
    # Once more at the same time: the same rows are told from the old ones by their version.
    stores.bump_versions("postgresql", keys_df(spark, "a"), None, "l", as_of=T[7])
    assert stores.latest_version("postgresql", "a", "l") == 1.7 and stores.read("postgresql", "l").count() == 4
    found = spark.read.format("jdbc").options(**db.options).option("dbtable", "SYS.SYSTABLES").load()
    assert [r["TABLENAME"] for r in found.where("TABLETYPE = 'T'").collect()] == ["l"]


def test_table_that_is_absent_or_out_of_reach(spark):
    stores, db = table_store(spark, [("a", 1.0, T[0], T[1], 0)])
    assert tables.table_exists(spark, db, "L") and not tables.table_exists(spark, db, "other")
    lost = Endpoint("postgresql", "jdbc", options={**db.options, "url": "jdbc:derby:memory:never_made"})
    with pytest.raises(Exception, match="never_made"):
        tables.write_table(ledger(spark, [("a", 1.0, T[0], T[1], 0)]), lost, "l")
    ends = Stores(spark, [lost, Endpoint("s3", "parquet", "/tmp")])
    with pytest.raises(TransferError, match="postgresql:"):
        ends.transfer("s3", "nothing", "postgresql", "l")
    with pytest.raises(Exception, match="not 0"):
        tables.execute(spark, db, 'DELETE FROM "l"', none_left='SELECT 1 FROM SYSIBM.SYSDUMMY1')
    assert tables.count_rows(spark, db, "l") == 1


def test_depth_cuts():
    assert tables.depth_cuts([("a", 10), ("b", 10), ("c", 10), ("d", 10)], 2) == ["c"]
    assert tables.depth_cuts([("a", 1), ("b", 97), ("c", 1), ("d", 1)], 4) == ["c"]
    assert tables.depth_cuts([(i, 1) for i in range(100)], 4) == [25, 50, 75]
    assert tables.depth_cuts([], 4) == tables.depth_cuts([("a", 5)], 4) == []


@pytest.mark.parametrize("column", ["db", "test_version", "n"])
def test_reads_split_by_depth(spark, column):
    db = derby()
    draw = random.Random(1)
    given = [(f"{draw.choice('aaaab')}'{int(draw.random() ** 6 * 5000):04d}", draw.random() ** 8 * 1e6, int(draw.random() ** 9 * 10**9)) for _ in range(4000)]
    df = spark.createDataFrame([*given, ("a0", None, None)], "db string, test_version double, n bigint")
    tables.write_table(df, db, "l", column_types={"db": "VARCHAR(20)"})
    store = Endpoint("postgresql", "jdbc", options=db.options, splits={"l": (column, 8)})
    got = Stores(spark, [store]).read("postgresql", "l")
    sizes = [len(p) for p in got.rdd.glom().collect()]
    assert rows(got) == rows(df) and 4 <= len(sizes) <= 8
    assert max(sizes) < 4001 * (0.5 if column == "db" else 0.9)
    conditions = tables.depth_predicates(spark, db, "l", column, 4)
    assert conditions[0].endswith("IS NULL") and len(conditions) <= 4
    if column == "db":
        with pytest.raises(ValueError, match="neither"):
            stamped = ledger(spark, [("a", 1.0, T[0], T[1], 0)]).drop("db")
            tables.write_table(stamped, db, "t")
            tables.depth_predicates(spark, db, "t", "created_at", 4)


# -- users -------------------------------------------------------------------


def user(n, email):
    return (f"F{n}", f"L{n}", email, f"0612345{n:03d}", "M")


@pytest.mark.parametrize("kind", ["mongodb", "postgresql"])
def test_appended_users_are_new(spark, tmp_path, kind, monkeypatch):
    columns = "first_name string, last_name string, email string, phone string, gender string"
    database = derby() if kind == "postgresql" else Endpoint("mongodb", "json", str(tmp_path / "d"))
    stores = Stores(spark, [database, Endpoint("s3", "csv", str(tmp_path / "o"))])
    for batch, (ids, known) in enumerate([(range(5), 0), (range(3, 9), 2), (range(9), 9)]):
        df = spark.createDataFrame([user(i, f"u{i}@ais.com") for i in ids], columns)
        stores.write(df, "s3", f"b{batch}")
        if batch == 2:
            with monkeypatch.context() as m:
                m.setattr("ferry.plans.transfer.broadcastable", lambda *_: False)
                done = stores.transfer_users(kind, f"b{batch}", "user", "append")
        else:
            done = stores.transfer_users(kind, f"b{batch}", "user", "append")
        assert (done.known, done.written) == (known, len(ids) - known)
    assert sorted(r["email"] for r in stores.read(kind, "user").collect()) == [f"u{i}@ais.com" for i in range(9)]


def test_text_sources_are_read_once(spark, tmp_path):
    stores = Stores(spark, [Endpoint("mongodb", "parquet", str(tmp_path / "d")), Endpoint("s3", "json", str(tmp_path / "o"))])
    df = spark.createDataFrame([user(i, f"u{i}@ais.com") for i in range(5)], "first_name string, last_name string, email string, phone string, gender string")
    stores.write(df.withColumn("other", F.lit(1)), "s3", "raw")
    done = stores.transfer_users("mongodb", "raw", "user")
    assert (done.total, done.valid, done.written) == (5, 5, 5)


# -- content -----------------------------------------------------------------


def test_differences_equal_brute_force(spark):
    draw = random.Random(3)
    kinds = "a int, b string, c double, d array<string>"
    for _ in range(3):
        left = [(draw.choice((1, None)), draw.choice(("x", "", None)), draw.choice((0.5, None)), draw.choice((["y"], None))) for _ in range(60)]
        right = [r for r in left if draw.random() > 0.1] + [draw.choice(left) for _ in range(3)]
        got = check.differences(spark.createDataFrame(left, kinds), spark.createDataFrame(right, kinds), buckets=8).collect()
        key = lambda r: (r[0], r[1], r[2], tuple(r[3]) if r[3] else None)
        want = Counter(map(key, left))
        want.subtract(map(key, right))
        assert Counter({key(r): r["missing"] for r in got}) == Counter({k: v for k, v in want.items() if v})


def test_fingerprints(spark):
    df = some(spark)
    assert rows(check.fingerprint(df, 8)) == rows(check.fingerprint(df.repartition(7), 8))
    assert check.differing_buckets(df, df).count() == 0
    swapped = df.select(F.col("db"), "test_version", F.col("updated_at").alias("created_at"), F.col("created_at").alias("updated_at"), "rid")
    assert check.differing_buckets(df, swapped).count() > 0
    nulls = spark.createDataFrame([(None, "a")], "x string, y string")
    assert check.differing_buckets(nulls, nulls.select(F.col("y").alias("x"), F.col("x").alias("y"))).count() == 2
    maps = df.withColumn("m", F.create_map(F.lit("k"), F.col("rid")))
    assert check.differences(maps, maps.where("rid <> 3")).select("rid", "missing").collect() == [(3, 1)]
    assert check.differences(df.where("false"), df.where("false")).collect() == []
    assert check.differences(df, df.where("false")).count() == df.count()
    with pytest.raises(check.ContentError, match="no column rid"):
        check.differences(df, df.drop("rid"))


def test_verified_transfer(spark, tmp_path, monkeypatch):
    stores = Stores(spark, [Endpoint("s3", "parquet", str(tmp_path / "o")), Endpoint("mongodb", "json", str(tmp_path / "d")), derby()])
    df = some(spark)
    stores.write(df, "s3", "a")
    for target, more in (("s3", {"format": "csv"}), ("mongodb", {}), ("postgresql", {"options": {"column_types": {"db": "VARCHAR(99)"}}})):
        assert stores.transfer("s3", "a", target, "copy", "overwrite", verify=True, **more).row_count == 41
    with pytest.raises(ValueError, match="overwritten"):
        stores.transfer("s3", "a", "mongodb", "copy", verify=True)
    write = objects.write_dataset
    monkeypatch.setattr(objects, "write_dataset", lambda rows, *given, **more: write(rows.where("rid <> 7"), *given, **more))
    with pytest.raises(check.ContentError, match="differs in 1 of 256 buckets"):
        stores.transfer("s3", "a", "s3", "lossy", verify=True)
