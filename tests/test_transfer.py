from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ferry.fixed_values import LEDGER_CONTAINER, USER_COLUMNS, USER_CONTAINER
from ferry.fixtures import AS_OF, ledger, raw_users
from ferry.plans import jobs
from ferry.plans.report import append_report, failed, report, succeeded
from ferry.plans.transfer import Stores, TransferError
from ferry.schemas import LEDGER_DOCUMENT, RAW_USER
from ferry.sources import synthetic, tables
from ferry.sources.endpoint import Endpoint
from tests.helpers import derby, rows

T = datetime(2024, 1, 1)
NTZ_LEDGER = "db string, test_version double, created_at timestamp_ntz, updated_at timestamp_ntz"
DB_TYPE = {"column_types": {"db": "VARCHAR(255)"}}


@pytest.fixture
def stores(spark, tmp_path):
    (tmp_path / "objects").mkdir()
    schema = spark.createDataFrame([], NTZ_LEDGER).schema
    return Stores(
        spark,
        [
            Endpoint("mongodb", "json", str(tmp_path / "documents"),
                     schemas={LEDGER_CONTAINER: schema, USER_CONTAINER: RAW_USER}),
            derby(),
            Endpoint("minio", "parquet", str(tmp_path / "objects")),
        ],
    )


@pytest.fixture
def filled(spark, stores):
    """All three stores with a ledger or users in them."""
    one = spark.createDataFrame([("mongodb", 1.4, T, T)], NTZ_LEDGER)
    other = spark.createDataFrame([("postgresql", 2.0, T, T)], NTZ_LEDGER)
    stores.write(one, "mongodb", LEDGER_CONTAINER)
    stores.write(other, "postgresql", LEDGER_CONTAINER, options=DB_TYPE)
    stores.write(raw_users(spark, "/root/testdata/sf0.001"), "s3", jobs.USERS_PATH)
    return stores


def test_minio_and_s3_are_one_store(stores):
    assert stores.endpoint("s3") is stores.endpoint("minio")


def test_wrong_kinds_and_missing_names(spark, stores):
    with pytest.raises(ValueError):
        stores.endpoint("cassandra")
    with pytest.raises(ValueError):
        stores.read_database("s3", "x")
    with pytest.raises(ValueError):
        stores.write_database(spark.range(1), "minio", "x")
    with pytest.raises(ValueError, match="name"):
        stores.read("s3", "")
    with pytest.raises(ValueError, match="name"):
        stores.write(spark.range(1), "mongodb", "")
    with pytest.raises(ValueError, match="no endpoint"):
        Stores(spark, []).endpoint("s3")
    with pytest.raises(ValueError, match="no ledger"):
        stores.transfer_versions("s3", "mongodb")
    with pytest.raises(ValueError, match="not a database"):
        stores.transfer_users("s3", "a", "b")


@pytest.mark.parametrize("source", ["mongodb", "postgresql", "s3"])
@pytest.mark.parametrize("target", ["mongodb", "postgresql", "s3"])
def test_any_store_to_any_store(spark, stores, source, target):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "db string, n bigint")
    types = {"options": DB_TYPE}
    stores.write(df, source, "from", **(types if source == "postgresql" else {}))
    done = stores.transfer(source, "from", target, "to", **(types if target == "postgresql" else {}))
    assert (done.success, done.row_count, done.source, done.target) == (True, 2, source, target)
    assert rows(stores.read(target, "to").select("db", "n")) == rows(df)


def test_default_modes(spark, stores):
    df = spark.range(3)
    for _ in range(2):
        stores.write(df, "mongodb", "x")
        stores.write(df, "s3", "x")
    assert stores.count("mongodb", "x") == 6
    assert stores.count("s3", "x") == 3


def test_empty_source_leaves_the_target_alone(spark, stores):
    stores.write(spark.range(3), "s3", "target")
    stores.write(spark.range(0), "s3", "empty")
    with pytest.raises(TransferError, match="no rows to move"):
        stores.transfer("s3", "empty", "s3", "target")
    assert stores.count("s3", "target") == 3


def test_transfer_between_formats(spark, stores):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    stores.write(df, "s3", "in", format="json")
    stores.transfer("s3", "in", "s3", "out", source_format="json", format="csv", partition_by="y")
    assert stores.read("s3", "out", format="csv").select("x", "y").first() == ("a", "b")


def test_store_file(stores, tmp_path):
    (tmp_path / "u.csv").write_text("a,b\n1,2\n")
    assert stores.store_file(str(tmp_path / "u.csv"), "bronze/u") == 1
    assert rows(stores.read("s3", "bronze/u")) == [(1, 2)]


@pytest.mark.parametrize("target", ["mongodb", "postgresql"])
def test_validated_users(filled, target):
    done = jobs.users_to_database(filled, target, order_by="rid")
    assert (done.total, done.valid, done.invalid, done.written) == (1500, 984, 516, 984)
    assert filled.count(target, USER_CONTAINER) == 984
    again = jobs.users_to_database(filled, target, order_by="rid")
    assert again.written == 984 and filled.count(target, USER_CONTAINER) == 984
    back = filled.read(target, USER_CONTAINER)
    assert sorted(back.columns) == sorted(USER_COLUMNS)


def test_validated_transfer_without_valid_rows(spark, filled):
    jobs.users_to_database(filled, "mongodb", order_by="rid")
    bad = spark.createDataFrame([("A", "B", "x", "1", "M")], RAW_USER)
    filled.write(bad, "s3", "bad")
    with pytest.raises(TransferError, match="leaves no rows"):
        filled.transfer_users("mongodb", "bad", USER_CONTAINER)
    filled.write(bad.limit(0), "s3", "none")
    with pytest.raises(TransferError, match="no rows to move"):
        filled.transfer_users("mongodb", "none", USER_CONTAINER)
    assert filled.count("mongodb", USER_CONTAINER) == 984


def test_rows_a_table_refuses_are_counted(spark, filled):
    good = ("A", "B", "a@ais.com", "0612345678", "M")
    odd = ("A", "B", "b@ais.com", "0612345678", "X")
    filled.write(spark.createDataFrame([good, odd], RAW_USER), "s3", "odd")
    done = filled.transfer_users("postgresql", "odd", USER_CONTAINER)
    assert (done.valid, done.written) == (2, 1)
    done = filled.transfer_users("mongodb", "odd", USER_CONTAINER)
    assert (done.valid, done.written) == (2, 2)


def test_readiness_reports_every_source(filled):
    got = filled.readiness(
        [("mongodb", LEDGER_CONTAINER), ("postgresql", "nothing"), ("s3", jobs.USERS_PATH), ("s3", "none")]
    )
    by_source = {r["source"]: r for r in got.collect()}
    assert by_source["mongodb:db_connect"]["row_count"] == 1
    assert by_source[f"s3:{jobs.USERS_PATH}"]["row_count"] == 1500
    for name in ("postgresql:nothing", "s3:none"):
        assert not by_source[name]["ok"] and by_source[name]["error"]


def test_require_names_all_failures(spark, tmp_path):
    broken = Stores(
        spark,
        [Endpoint("mongodb", "json", str(tmp_path / "no")), derby(), Endpoint("s3", "parquet", str(tmp_path / "nope"))],
    )
    with pytest.raises(TransferError) as e:
        broken.require()
    assert all(kind in str(e.value) for kind in ("mongodb", "postgresql", "s3"))


def test_version_transfer_both_ways(spark, filled):
    jobs.versions_flow(filled, "mongodb", "postgresql", as_of=AS_OF)
    got = rows(filled.read("postgresql", LEDGER_CONTAINER).select("db", "test_version"))
    assert got == [("mongodb", 1.4), ("postgresql", 2.0)]
    jobs.versions_flow(filled, "postgresql", "mongodb", as_of=AS_OF)
    got = rows(filled.read("mongodb", LEDGER_CONTAINER).select("db", "test_version"))
    assert got == [("mongodb", 1.4), ("postgresql", 2.0)]


def test_all_flows(filled):
    outcomes = jobs.run_all_flows(filled)
    assert [o.get("rows") or o["outcome"] for o in outcomes][0] == 2
    assert len(outcomes) == 6
    assert outcomes[2]["outcome"].row_count == filled.count("mongodb")
    assert outcomes[3]["outcome"].total == 1500
    assert filled.count("s3", "postgresql/db_connect") == 2
    assert filled.count("postgresql", USER_CONTAINER) == outcomes[5]["outcome"].written


def test_ledger_job_on_each_database(filled):
    assert rows(jobs.ledger_job(filled, "mongodb", as_of=AS_OF)) == [("mongodb", 1.5)]
    assert rows(jobs.ledger_job(filled, "postgresql", as_of=AS_OF)) == [("postgresql", 2.1)]
    assert rows(jobs.ledger_job(filled, "postgresql", as_of=AS_OF)) == [("postgresql", 2.2)]
    assert filled.count("postgresql") == 1


@pytest.mark.parametrize("kind", ["mongodb", "postgresql"])
def test_ledger_of_a_store(spark, filled, kind):
    one = spark.createDataFrame([("x",)], "db string")
    assert filled.latest_version(kind, "x") is None
    assert filled.create_versions(kind, one, as_of="2024-01-01") == 1
    assert filled.create_versions(kind, one, 3.0, as_of="2024-01-02") == 1
    assert filled.latest_version(kind, "x") == 3.0
    assert filled.count(kind) == 3
    filled.compact_ledger(kind)
    assert filled.count(kind) == 2
    filled.bump_versions(kind, one)
    assert filled.latest_version(kind, "x") == 3.1
    filled.bump_versions(kind, one, 0.0)
    assert filled.latest_version(kind, "x") == 0.0
    filled.bump_versions(kind)
    assert filled.latest_version(kind, "x") == 0.1
    assert filled.count(kind) == 2


def test_first_version_in_a_store_without_a_ledger(spark, stores):
    one = spark.createDataFrame([("x",)], "db string")
    stores.create_versions("mongodb", one)
    assert stores.latest_version("mongodb", "x") == 1.0


def test_failed_replacement_keeps_the_rows(spark, filled, monkeypatch):
    def broken(*a, **k):
        raise OSError("disk")

    monkeypatch.setattr(Stores, "write", broken)
    with pytest.raises(TransferError, match="the rows are in") as e:
        filled.write_ledger(spark.range(3), "mongodb")
    path = str(e.value).rsplit(" ", 1)[1]
    assert spark.read.parquet(path).count() == 3


def test_object_store_job(spark, stores):
    users, versions = jobs.object_store_job(stores, synthetic.users(spark, 100))
    assert users.count() == 100
    assert versions.schema == LEDGER_DOCUMENT
    assert rows(versions.select("db")) == [("mongodb",), ("mysql",), ("postgresql",)]


def test_routes(spark, stores, tmp_path):
    folder = tmp_path / "objects" / "data"
    folder.mkdir()
    (folder / "x.dat").write_text("a|1.5|2024-01-01T00:00:00|2024-01-02T00:00:00\n")
    side = {
        "type": "file",
        "properties": {
            "storage": "MinIO", "type": "csv", "path": "data", "schema": LEDGER_CONTAINER,
            "options": {"delimiter": "|", "header": "false", "inferSchema": "true",
                        "stripQuote": "false", "extension": "dat"},
        },
    }
    table = {"type": "database", "properties": {"storage": "postgresql", "table": LEDGER_CONTAINER}}
    done = jobs.run_route(stores, {"src": side, "dest": table})
    assert done.row_count == 1
    out = {
        "type": "file",
        "properties": {
            "storage": "MinIO", "path": "out/pg", "filename": "ledger_json", "format": "json",
        },
    }
    done = jobs.run_route(stores, {"src": table, "dest": out})
    assert (done.row_count, done.source, done.target) == (1, "postgresql", "s3")
    assert stores.read("s3", "out/pg/ledger_json", format="json").first()["db"] == "a"


def test_route_options_are_used_or_refused(spark, stores):
    users = spark.createDataFrame([(i, f"p{i % 2}") for i in range(5)], "i int, p string")
    stores.write(users, "s3", "in")
    src = {"type": "file", "properties": {"storage": "MinIO", "path": "in", "format": "parquet"}}

    def run(src=src, type="file", **more):
        named = {"path": "out"} if type == "file" else {}
        dest = {"type": type, "properties": {"storage": "MinIO" if type == "file" else "postgresql", **named, **more}}
        return jobs.run_route(stores, {"src": src, "dest": dest})

    run(format="json", options={"compression": "gzip"})
    run(format="json", mode="append", options={"compression": "gzip"})
    listed = [r["path"] for r in spark.read.format("binaryFile").load(stores.endpoint("s3").path("out")).collect()]
    assert stores.read("s3", "out", format="json").count() == 10 and all(p.endswith(".json.gz") for p in listed)
    run(format="parquet", partition_by="p")
    assert stores.read("s3", "out").filter("p = 'p1'").inputFiles()[0].split("/")[-2] == "p=p1"
    run(type="database", table="t", options={"column_types": {"p": "VARCHAR(9)"}})
    run(type="database", table="t", mode="overwrite")
    assert stores.read("postgresql", "t").count() == 5
    for wrong in ({"nonsense": 1}, {"partitionBy": "p"}):
        with pytest.raises(ValueError, match="does not use"):
            run(**wrong)
    with pytest.raises(ValueError, match="does not use filename"):
        run(type="database", table="t", filename="x")
    with pytest.raises(ValueError, match="does not use nonsense"):
        run(src={"type": "file", "properties": {**src["properties"], "nonsense": 1}})
    with pytest.raises(ValueError, match="unknown type"):
        run(type="queue")
    with pytest.raises(TypeError, match="nonsense"):
        run(type="database", table="t", options={"nonsense": 1})


def test_report(spark, filled, tmp_path):
    done = jobs.users_to_database(filled, "mongodb", order_by="rid")
    plain = jobs.ledger_to_storage(filled, "mongodb")
    lost = failed("s3 to mongodb", TransferError("no data"), "s3", "mongodb")
    audit = Endpoint("s3", "parquet", str(tmp_path))
    for records in ([succeeded(done), lost], [succeeded(plain, "ledger copied", run="7")]):
        append_report(report(spark, records), audit)
    got = spark.read.parquet(str(tmp_path / "audit"))
    assert got.count() == 3
    bad = got.filter("NOT success").first()
    assert (bad["error"], bad["row_count"]) == ("no data", None)
    users = got.filter("total IS NOT NULL").first()
    assert (users["total"], users["valid"], users["invalid"]) == (1500, 984, 516)
    copied = got.filter("message = 'ledger copied'").first()
    assert (copied["row_count"], copied["details"]) == (1, {"run": "7"})


def test_jdbc_ledger_is_read_in_parts(spark, stores):
    df = ledger(spark, "/root/testdata/sf0.001")
    stores.write(df, "postgresql", "l", options=DB_TYPE)
    got = stores.read("postgresql", "l", options={"partition_column": "rid", "num_partitions": 3})
    assert got.rdd.getNumPartitions() == 3 and got.count() == 1000
    assert tables.count_rows(spark, stores.endpoint("postgresql"), "l") == 1000
    assert got.agg(F.max("rid")).first()[0] == df.agg(F.max("rid")).first()[0]
