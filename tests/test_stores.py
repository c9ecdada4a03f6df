from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ferry.fixtures import ledger, raw_users
from ferry.schemas import RAW_USER
from ferry.sources import documents, objects, scratch, tables
from ferry.sources.endpoint import Endpoint
from tests.helpers import FakeSession, derby, plan, rows

VARCHAR = {c: "VARCHAR(255)" for c in ("k", "v", "db", "email", "name")}


# -- addresses ---------------------------------------------------------------


def test_object_path():
    assert objects.object_path("b", "silver", "x", directory=True) == "s3a://b/silver/x/"
    assert objects.object_path("b", "silver", "x") == "s3a://b/silver/x"
    assert objects.object_path("b") == "s3a://b"
    assert objects.object_path("b", name="x/", directory=True) == "s3a://b/x/"


@pytest.mark.parametrize("given, expected", [
    (dict(path="s3a://other/silver/x"), ("s3a://other/silver/x", "other", "silver/x")),
    (dict(path="silver/x"), ("s3a://b/silver/x", "b", "silver/x")),
    (dict(filename="f.csv"), ("s3a://b/data/csv/f.csv", "b", "data/csv/f.csv")),
    (dict(filename="f.csv", default_path="in"), ("s3a://b/in/f.csv", "b", "in/f.csv")),
    (dict(default_path="in"), ("s3a://b/in", "b", "in")),
    (dict(), ("s3a://b/data", "b", "data")),
])
def test_resolve_path(given, expected):
    assert objects.resolve_path(bucket="b", **given) == expected


def test_unknown_kind():
    with pytest.raises(ValueError, match="unsupported"):
        Endpoint("cassandra", "parquet")


# -- objects -----------------------------------------------------------------


@pytest.mark.parametrize("format", ["parquet", "json", "csv", "orc"])
def test_round_trip_counts_and_keeps_values(spark, tmp_path, format):
    records = [
        (None, "", "   ", " a ", "F"),
        ('"q"', "a,b", "c|d", "\\x", None),
        ("ü", "it's", "\t", "x", "M"),
    ]
    df = spark.createDataFrame(records, RAW_USER)
    path = str(tmp_path / "d")
    assert objects.write_dataset(df, path, format) == 3
    assert rows(objects.read_dataset(spark, path, format, RAW_USER)) == rows(df)
    assert objects.write_dataset(df, path, format, mode="append") == 3
    assert objects.read_dataset(spark, path, format, RAW_USER).count() == 6


def test_csv_defaults_can_be_overridden(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    objects.write_dataset(df, path, "csv", options={"sep": ";", "header": "false"})
    got = objects.read_dataset(spark, path, "csv", options={"sep": ";", "header": "false"})
    assert got.columns == ["_c0", "_c1"] and got.count() == 1


@pytest.mark.parametrize("format", ["json", "csv"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_microseconds_survive_text(spark, tmp_path, sf, format, kind):
    df = ledger(spark, sf).withColumns({c: F.col(c).cast(kind) for c in ("created_at", "updated_at")})
    path = str(tmp_path / "d")
    objects.write_dataset(df, path, format)
    assert rows(objects.read_dataset(spark, path, format, df.schema)) == rows(df)


@pytest.mark.parametrize("text", [
    "2024-01-02T03:04:05", "2024-01-02T03:04:05.000", "2024-01-02T03:04:05Z",
    "2024-01-02 03:04:05", "2024-01-02T03:04:05.000Z",
])
def test_other_time_formats_are_read(spark, tmp_path, text):
    (tmp_path / "x.json").write_text('{"t": "%s"}\n' % text)
    got = objects.read_dataset(spark, str(tmp_path), "json", "t timestamp").first()[0]
    assert got == datetime(2024, 1, 2, 3, 4, 5)


def test_json_keeps_columns_of_nulls(spark, tmp_path):
    path = str(tmp_path / "d")
    objects.write_dataset(spark.createDataFrame([("a", None)], "x string, y string"), path, "json")
    assert objects.read_dataset(spark, path, "json").columns == ["x", "y"]


def test_output_filename(spark, tmp_path):
    objects.write_dataset(spark.range(2), str(tmp_path / "d"), "parquet", output_filename="part")
    assert spark.read.parquet(str(tmp_path / "d" / "part")).count() == 2


def test_missing_connectors_are_errors(spark, tmp_path):
    for format in ("delta", "mongodb"):
        with pytest.raises(Exception, match=f"(?i){format}"):
            objects.write_dataset(spark.range(1), str(tmp_path / "d"), format)
    with pytest.raises(Exception, match="(?i)mongodb"):
        documents.read_collection(spark, Endpoint("mongodb", "mongodb"))


def test_partitioned_write_prunes_and_writes_few_files(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.range(0, 9000, 1, 8).withColumn("p", F.col("id") % 3)
    assert objects.write_dataset(df, path, "parquet", partition_by="p") == 9000
    back = spark.read.parquet(path)
    assert len(back.inputFiles()) <= 6  # eight tasks and three values would be 24
    assert "PartitionFilters: [isnotnull(p" in plan(back.filter("p = 1"))
    assert back.filter("p = 1").count() == 3000


def test_partitioned_write_splits_a_hot_value(spark, tmp_path, conf):
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="50KB",
    )
    path = str(tmp_path / "d")
    df = spark.range(0, 300_000, 1, 16).select(
        F.xxhash64("id").alias("v"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 20).cast("string")).alias("p"),
    )
    objects.write_dataset(df, path, "parquet", partition_by="p")
    assert len(spark.read.parquet(path + "/p=hot").inputFiles()) > 2
    assert spark.read.parquet(path).count() == 300_000


def test_file_formats_by_extension():
    assert objects.format_of("a/b.parquet") == "parquet"
    assert objects.format_of("b.json") == "json"
    assert objects.format_of("b.csv") == objects.format_of("b.txt") == "csv"


def test_read_file_with_and_without_a_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\n2,y\n")
    assert objects.read_file(spark, str(tmp_path / "x.csv")).dtypes == [("a", "int"), ("b", "string")]
    got = objects.read_file(spark, str(tmp_path / "x.csv"), "a string, b string")
    assert rows(got) == [("1", "x"), ("2", "y")]


def test_parts_are_all_read(spark, tmp_path, sf):
    df = raw_users(spark, sf)
    path = str(tmp_path / "d")
    objects.write_dataset(df.repartition(5), path, "csv")
    (tmp_path / "d" / "notes.csv").write_text("not,a,part\n")
    got = objects.read_parts(spark, path, schema=df.schema)
    assert got.count() == 1500 and rows(got) == rows(df)


def test_pipe_dat(spark, tmp_path):
    (tmp_path / "x.dat").write_text('"a"|1|2.5\nb||x y\n')
    (tmp_path / "x.csv").write_text("other|file|here\n")
    got = objects.read_pipe_dat(spark, str(tmp_path))
    assert got.columns == ["_c0", "_c1", "_c2"]
    assert dict(got.dtypes)["_c1"] == "int"
    assert rows(got) == [('"a"', 1, "2.5"), ("b", None, "x y")]


def test_inventory_reads_no_content(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.txt").write_text("four")
    (tmp_path / "y.txt").write_text("sixsix")
    got = objects.inventory(spark, str(tmp_path))
    assert sorted(r["size"] for r in got.collect()) == [4, 6]
    assert {r["name"].rsplit("/", 1)[1] for r in got.collect()} == {"x.txt", "y.txt"}
    assert all(isinstance(r["last_modified"], datetime) for r in got.collect())
    assert "content" not in plan(got)


# -- tables ------------------------------------------------------------------


def test_reserved_and_mixed_case_names(spark):
    assert tables.quoted("User") == tables.quoted('"user"') == '"user"'
    db = derby()
    df = spark.createDataFrame([("a", 1)], "k string, id int")
    assert tables.write_table(df, db, "User", column_types=VARCHAR) == 1
    assert tables.read_table(spark, db, "USER").columns == ["k"]  # the key is the database's


def test_append_and_overwrite(spark):
    db = derby()
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    tables.write_table(df, db, "t", column_types=VARCHAR)
    tables.write_table(df, db, "t", column_types=VARCHAR)
    assert tables.count_rows(spark, db, "t") == 4
    tables.write_table(df, db, "t", "overwrite", column_types=VARCHAR)
    assert rows(tables.read_table(spark, db, "t")) == [("a",), ("b",)]


def test_overwriting_keeps_the_table_definition(spark):
    db = derby()
    df = spark.createDataFrame([("a",)], "k string")
    tables.write_table(df, db, "t", column_types={"k": "VARCHAR(3)"})
    long = spark.createDataFrame([("too long",)], "k string")
    with pytest.raises(Exception):
        tables.write_table(long, db, "t", "overwrite")
    tables.write_table(long, db, "t", "overwrite", recreate=True)
    assert tables.count_rows(spark, db, "t") == 1


def test_a_table_can_be_overwritten_with_itself(spark):
    db = derby()
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    tables.write_table(df, db, "t", column_types=VARCHAR)
    same = tables.read_table(spark, db, "t")
    tables.write_table(same, db, "t", "overwrite")
    assert tables.count_rows(spark, db, "t") == 3


def test_wrong_counts_are_noticed(spark, monkeypatch):
    db = derby()
    df = spark.createDataFrame([("a",)], "k string")
    real = tables.count_rows
    monkeypatch.setattr(tables, "count_rows", lambda *a: real(*a) + 1)
    with pytest.raises(tables.VerificationError, match="expected 1"):
        tables.write_table(df, db, "t", "overwrite", column_types=VARCHAR)


def test_an_overwrite_that_counts_wrong_runs_again(spark, monkeypatch):
    db = derby()
    df = spark.createDataFrame([("a",)], "k string")
    real, calls = tables.count_rows, []

    def once_wrong(*a):
        calls.append(1)
        return real(*a) + (1 if len(calls) == 1 else 0)

    monkeypatch.setattr(tables, "count_rows", once_wrong)
    assert tables.write_table(df, db, "t", "overwrite", column_types=VARCHAR) == 1
    assert len(calls) == 2 and real(spark, db, "t") == 1


def test_partitioned_reads(spark, sf):
    db = derby()
    df = ledger(spark, sf)
    tables.write_table(df, db, "l", "overwrite", column_types=VARCHAR)
    split = tables.read_table(spark, db, "l", partition_column="rid", num_partitions=4)
    assert split.rdd.getNumPartitions() == 4
    assert rows(split) == rows(df)
    given = tables.read_table(
        spark, db, "l", predicates=['"rid" < 300', '"rid" >= 300'],
    )
    assert given.rdd.getNumPartitions() == 2
    assert given.count() == 1000


def test_partitioned_read_of_an_empty_table(spark):
    db = derby()
    tables.write_table(spark.createDataFrame([], "rid int"), db, "l", "overwrite")
    assert tables.read_table(spark, db, "l", partition_column="rid").count() == 0


def test_key_filter_reaches_the_database(spark):
    db = derby()
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "db string, test_version double")
    tables.write_table(df, db, "l", column_types=VARCHAR)
    one = tables.read_table(spark, db, "l").filter("db = 'a'").select("test_version")
    assert rows(one) == [(1.0,)]
    text = plan(one)
    assert "EqualTo(db,a)" in text and "ReadSchema: struct<test_version:double>" in text


# -- documents and scratch ---------------------------------------------------


def test_collections(spark, tmp_path):
    store = Endpoint("mongodb", "json", str(tmp_path))
    df = spark.createDataFrame([("a", 1)], "_id string, n bigint")
    assert documents.write_collection(df, store, "c") == 1
    assert documents.write_collection(df, store, "c") == 1
    assert documents.read_collection(spark, store, "c").count() == 2
    assert documents.write_collection(df, store, "c", "overwrite") == 1
    assert rows(documents.read_collection(spark, store, "c")) == [("a", 1)]


def test_known_schemas_need_no_inference(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "_id string, n int")
    store = Endpoint("mongodb", "json", str(tmp_path), schemas={"c": df.schema})
    documents.write_collection(df, store, "c")
    assert documents.read_collection(spark, store, "c").dtypes == df.dtypes


def test_scratch_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch.scratch_root(spark) == named
    assert scratch.scratch_path(spark) != scratch.scratch_path(spark)


def test_no_machine_local_scratch_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(FakeSession(spark__master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(FakeSession(spark__master="local-cluster[2,1,1024]"))
    shared = FakeSession(spark__master="yarn", spark__checkpoint__dir="hdfs:///x/")
    assert scratch.scratch_root(shared) == "hdfs:///x"
    assert scratch.scratch_root(FakeSession(spark__master="local[2]", spark__app__id="t")).startswith("/")


def test_staged_copies_are_removed(spark):
    copy = scratch.stage(spark.range(5))
    assert copy.rows.count() == 5 and scratch.path_exists(spark, copy.path)
    scratch.discard(copy)
    assert not scratch.path_exists(spark, copy.path)
