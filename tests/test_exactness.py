from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ferry.fixed_values import LEDGER_CONTAINER
from ferry.operators import ledger as L
from ferry.operators import matching
from ferry.plans import jobs
from ferry.plans.transfer import Stores, TransferError
from ferry.sources import objects, sniffing
from ferry.sources.endpoint import Endpoint
from tests.helpers import rows

EDGES = [
    "", " ", " a ", "a,b", 'say "hi"', '"', '""', "'", "\\", "a\\", '\\"', '\\\\"', "\n", "a\nb", "\r", "a\rb", "a\r\nb",
    "\t", "#x", "NULL", "null", "\\n", "é☃", "a|b", '","', "x" * 5000, None,
]


def _texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


@pytest.mark.parametrize("format", ["csv", "json", "parquet"])
def test_text_comes_back_as_it_was(spark, tmp_path, format):
    df = _texts(spark, EDGES)
    path = str(tmp_path / format)
    assert objects.write_dataset(df, path, format) == len(EDGES)
    back = objects.read_dataset(spark, path, format, df.schema)
    assert {r.i: r.t for r in back.collect()} == dict(enumerate(EDGES))


def test_the_mark_for_null_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="stands for NULL"):
        objects.write_dataset(_texts(spark, ["\\N"]), str(tmp_path / "a"), "csv")


@pytest.mark.parametrize("bad", ["a|b", "a\nb", "a\rb"])
def test_files_without_quotes_refuse_what_they_cannot_hold(spark, tmp_path, bad):
    pipe = {"sep": "|", "quote": "", "header": "false"}
    with pytest.raises(Exception, match="nothing quotes it"):
        objects.write_dataset(_texts(spark, [bad]), str(tmp_path / "a"), "csv", options=pipe)
    assert objects.write_dataset(_texts(spark, ["a b"]), str(tmp_path / "b"), "csv", options=pipe) == 1


PARTITIONS = ["007", None, "7", "1.0", "1e3", "", "\\E", "\\", "\\x", "__HIVE_DEFAULT_PARTITION__", " a/b=c%20 ", "ünï"]


@pytest.mark.parametrize("format", ["parquet", "json", "csv"])
def test_partition_values(spark, tmp_path, format):
    """With a schema and without one they come back, and so from a copy of a copy."""
    df = _texts(spark, PARTITIONS).withColumn("n", F.lit(3.0)).select("t", "n", "i")
    want = dict(enumerate(PARTITIONS))
    for path, given in (("a", None), ("b", df.schema), ("c", None)):
        path = str(tmp_path / path)
        assert objects.write_dataset(df, path, format, partition_by="t") == len(PARTITIONS)
        df = objects.read_dataset(spark, path, format, given)
        assert df.dtypes == [("t", "string"), ("n", "double"), ("i", "int")]
        assert {r.i: r.t for r in df.collect()} == want
        for value in PARTITIONS:
            assert df.where(F.col("t").eqNullSafe(F.lit(value))).count() == 1
    pruned = df.where(F.col("t") == "")._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" in pruned.split("PartitionFilters: [")[1].split("]")[0]


def test_types_of_partitions(spark, tmp_path):
    row = {
        "day": date(2024, 2, 29), "at": datetime(2024, 1, 2, 3, 4, 5, 678901), "flag": True,
        "exact": Decimal("1.50"), "small": 7, "real": 0.1,
    }
    kinds = "id int, day date, at timestamp, flag boolean, exact decimal(5,2), small smallint, real double"
    df = spark.createDataFrame([(1, *row.values()), (2, *[None] * 6)], kinds)
    for column in row:
        path = str(tmp_path / column)
        objects.write_dataset(df, path, "parquet", partition_by=column)
        back = objects.read_dataset(spark, path, "parquet")
        assert back.dtypes == df.dtypes
        assert rows(back) == rows(df)


def test_appended_rows_must_fit_the_layout(spark, tmp_path):
    path = str(tmp_path / "a")
    df = _texts(spark, ["007", ""])
    objects.write_dataset(df, path, "parquet", partition_by="t")
    objects.write_dataset(df.withColumn("more", F.lit(1)), path, "parquet", "append", partition_by="t")
    back = objects.read_dataset(spark, path, "parquet")
    assert back.columns == [*df.columns, "more"] and back.count() == 4
    with pytest.raises(ValueError, match="partitioned by"):
        objects.write_dataset(df, path, "parquet", "append", partition_by="i")
    with pytest.raises(ValueError, match="column i of"):
        objects.write_dataset(df.withColumn("i", F.lit("x")), path, "parquet", "append", partition_by="t")
    objects.write_dataset(df, path, "parquet")
    assert objects.read_dataset(spark, path, "parquet").columns == df.columns


# -- files whose name tells their format -------------------------------------


def test_files_keep_records_and_values(spark, tmp_path):
    texts = ["a\nb", 'say "x",\r\n', "", None, " blank ", "\\", "007", "1e3", "x" * 5000]
    df = _texts(spark, texts)
    path = str(tmp_path / "x.csv")
    objects.write_dataset(df, path, "csv")
    back = objects.read_file(spark, path)
    assert back.dtypes == [("i", "int"), ("t", "string")]
    assert {r.i: r.t for r in back.collect()} == dict(enumerate(texts))


TYPES = [
    ("boolean", ["true", "false", None]),
    ("string", ["True", "false"]),
    ("int", ["1", "-2", None]),
    ("bigint", ["1", "3000000000"]),
    ("string", ["99999999999999999999"]),
    ("string", ["007", "8"]),
    ("string", ["1e3", "2"]),
    ("string", ["+1"]),
    ("string", [" 1"]),
    ("string", ["5", "5.5"]),
    ("double", ["0.5", "1.0E10", "-2.25"]),
    ("decimal(4,2)", ["0.50", "12.30", "-1.00"]),
    ("string", ["0.50", "12.3", "1.205"]),
    ("string", ["-0.00", "1.50"]),
    ("date", ["2024-02-29"]),
    ("string", ["2024-02-30"]),
    ("string", ["2024-2-3"]),
    ("timestamp_ntz", ["2024-01-02 03:04:05"]),
    ("timestamp_ntz", ["2024-01-02T03:04:05.123456", "1999-12-31T23:59:59.000000"]),
    ("timestamp", ["2024-01-02T03:04:05.000Z"]),
    ("string", ["2024-01-02 03:04:05", "2024-01-02T03:04:05"]),
    ("string", ["", "1"]),
    ("string", [None, None]),
    ("string", ["1" * 100]),
]


@pytest.mark.parametrize("kind,values", TYPES)
def test_narrowest_type_that_gives_every_value_back(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], "c string").withColumnRenamed("c", "a.b`c")
    assert sniffing.column_types(df) == {"a.b`c": kind}
    assert sniffing.typed(df).dtypes == [("a.b`c", kind)]


def test_sniffing_nothing(spark):
    assert sniffing.typed(spark.createDataFrame([], "a string, b int")).dtypes == [("a", "string"), ("b", "int")]


# -- times -------------------------------------------------------------------


def _ledger(spark, kind, *rows):
    df = spark.createDataFrame(list(rows), "db string, test_version double, created_at string, updated_at string")
    return df if kind == "string" else df.withColumns({c: F.col(c).cast(kind) for c in ("created_at", "updated_at")})


@pytest.mark.parametrize("zone", ["UTC", "Asia/Bangkok"])
def test_stamps_are_utc_in_any_session(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    df = _ledger(spark, "string", ("a", 1.0, "2020-01-01T00:00:00.000Z", "2020-01-01T00:00:00.000Z"))
    got = datetime.fromisoformat(L.bump(df).first().updated_at)
    assert abs(got - datetime.now(timezone.utc)) < timedelta(minutes=5)
    aware = datetime(2025, 1, 1, tzinfo=timezone(timedelta(hours=7)))
    for as_of in (aware, aware.isoformat(), "2024-12-31T17:00:00Z", "2024-12-31 17:00:00"):
        assert L.bump(df, as_of=as_of).first().updated_at == "2024-12-31T17:00:00.000Z"
    instants = _ledger(spark, "timestamp", ("a", 1.0, None, None))
    stamped = L.bump(instants, as_of=aware).select(F.unix_timestamp("updated_at").alias("s")).first().s
    assert stamped == aware.timestamp()
    wall = _ledger(spark, "timestamp_ntz", ("a", 1.0, None, None))
    assert L.bump(wall, as_of=aware).first().updated_at == datetime(2024, 12, 31, 17)


def test_text_times_are_ordered_as_times(spark):
    df = _ledger(
        spark, "string",
        ("a", 1.0, None, "2025-01-01T00:00:00.123Z"), ("a", 2.0, None, "2025-01-01T00:00:00.123999Z"),
    )
    assert L.compact(df).first().test_version == 2.0
    fine = "2025-01-01T00:00:00.123999"
    assert L.compact(df.unionByName(L.new_rows(df.select("db"), df, 3.0, fine))).first().test_version == 3.0


def test_columns_without_an_order_travel_with_their_row(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', 1.0D, TIMESTAMP '2020-01-01', TIMESTAMP '2020-01-01', map('k', 1), 'x'),"
        " ('a', 2.0D, TIMESTAMP '2020-01-01', TIMESTAMP '2020-01-02', map('k', 2), 'y')"
        " AS t(db, test_version, created_at, updated_at, m, `dotted.name`)"
    )
    row = L.compact(df).first()
    assert (row.m, row["dotted.name"]) == ({"k": 2}, "y")


# -- hot keys ----------------------------------------------------------------


def test_any_number_of_hot_keys_is_spread(spark, monkeypatch, conf):
    monkeypatch.setattr(matching, "HOT_ROWS", 100)
    monkeypatch.setattr(matching, "LISTED_KEYS", 10)
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="200", spark__sql__autoBroadcastJoinThreshold="-1")
    df = spark.range(0, 100_000, numPartitions=8).select(
        (F.pmod(F.col("id"), F.lit(50)) * 1000).alias("k"), F.struct(F.array(F.create_map(F.lit("a"), "id")).alias("m")).alias("deep")
    )
    hot = matching.hot_keys(df, "k")
    assert len(hot) == 50
    keys = df.select("k").distinct().where("k < 40000")
    got = matching.match(df, keys, "k", "left_semi", hot)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 80_000 and max(sizes) < 2.5 * 80_000 / 200
    assert matching.match(df, keys, "k", "left_anti", hot).count() == 20_000


def test_hot_null_is_one_key(spark, monkeypatch):
    monkeypatch.setattr(matching, "HOT_ROWS", 10)
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"))
    assert matching.hot_keys(df, "k") == [None]


# -- nothing is ignored ------------------------------------------------------


def _stores(spark, tmp_path, target="documents"):
    base = str(tmp_path)
    return Stores(
        spark,
        [
            Endpoint("mongodb", "json", f"{base}/{target}"),
            Endpoint("postgresql", "parquet", f"{base}/tables"),
            Endpoint("s3", "parquet", f"{base}/objects"),
        ],
    )


def test_options_a_store_does_not_use_are_refused(spark, tmp_path):
    stores = _stores(spark, tmp_path)
    df = _texts(spark, ["a"])
    with pytest.raises(ValueError, match="partition_by"):
        stores.write(df, "mongodb", "x", partition_by="t")
    with pytest.raises(ValueError, match="format"):
        stores.read("mongodb", "x", format="csv")
    with pytest.raises(ValueError, match="charset"):
        jobs._declared_csv_options({"charset": "utf-8", "delimiter": "|"})
    assert jobs._declared_csv_options({"encoding": "latin1", "nullValue": "-", "multiLine": "true"}) == {
        "encoding": "latin1", "nullValue": "-", "multiLine": "true",
    }


def test_document_options_reach_the_reader(spark, tmp_path):
    stores = _stores(spark, tmp_path)
    stores.write(_texts(spark, ["a"]), "mongodb", "x")
    one = stores.read("mongodb", "x", options={"pathGlobFilter": "nothing-*"}, schema=_texts(spark, []).schema)
    assert one.count() == 0


def test_both_ends_are_tried_before_anything_is_read(spark, tmp_path, monkeypatch):
    stores = _stores(spark, tmp_path)
    broken = Stores(spark, [stores.endpoint("postgresql"), Endpoint("mongodb", "json", "nosuchfs://host/folder")])
    monkeypatch.setattr(Stores, "read", lambda *a, **k: pytest.fail("the source was read"))
    with pytest.raises(TransferError) as told:
        broken.transfer("postgresql", LEDGER_CONTAINER, "mongodb", LEDGER_CONTAINER)
    assert "postgresql" in str(told.value) and "mongodb" in str(told.value)
