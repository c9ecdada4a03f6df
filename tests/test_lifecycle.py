import threading
from datetime import datetime

from ferry.fixed_values import LEDGER_CONTAINER
from ferry.fixtures import raw_users
from ferry.operators import ledger as ledgers
from ferry.plans import jobs
from ferry.plans.transfer import Stores
from ferry.sources import scratch, sizing
from ferry.sources.endpoint import Endpoint

T = datetime(2024, 1, 1)
NTZ_LEDGER = "db string, test_version double, created_at timestamp_ntz, updated_at timestamp_ntz"


def test_store_calls_leave_no_scratch(spark, sf, tmp_path, conf, monkeypatch):
    root = tmp_path / "scratch"
    monkeypatch.setattr(scratch, "scratch_root", lambda _: str(root))
    monkeypatch.setattr(ledgers, "FILTER_KEYS", 0)
    df = spark.createDataFrame([("a", 1.0, T, T), ("b", 2.0, T, T)], NTZ_LEDGER)
    stores = Stores(
        spark,
        [
            Endpoint("mongodb", "json", str(tmp_path / "documents"), schemas={LEDGER_CONTAINER: df.schema}),
            Endpoint("postgresql", "parquet", str(tmp_path / "tables")),
            Endpoint("s3", "parquet", str(tmp_path / "objects")),
        ],
    )
    stores.write(df, "mongodb", LEDGER_CONTAINER)
    stores.write(df, "postgresql", LEDGER_CONTAINER)
    stores.write(raw_users(spark, sf), "s3", jobs.USERS_PATH)
    stores.bump_versions("mongodb", df.select("db"))
    stores.transfer_versions("mongodb", "postgresql", df.select("db"))
    stores.compact_ledger("postgresql")
    jobs.users_to_database(stores, "postgresql", order_by="rid")
    assert list((root / "ferry").iterdir()) == []
    assert stores.latest_version("postgresql", "b") == 2.1


def test_overlapping_jobs_keep_their_settings(spark, monkeypatch):
    before = spark.conf.get(sizing.SHUFFLE_SETTING)
    sizes = {10: 64, 20: 128}
    monkeypatch.setattr(sizing, "settings_for", lambda n: {sizing.SHUFFLE_SETTING: sizes[n]})
    monkeypatch.setattr(sizing, "input_bytes", lambda df: df)

    class Job(int):
        sparkSession = spark

    seen, first_in, second_in, first_out = {}, threading.Event(), threading.Event(), threading.Event()

    def first():
        with sizing.sized_for(Job(10)):
            first_in.set()
            second_in.wait(10)
        first_out.set()

    def second():
        first_in.wait(10)
        with sizing.sized_for(Job(20)):
            second_in.set()
            first_out.wait(10)
            seen["second"] = spark.conf.get(sizing.SHUFFLE_SETTING)

    both = [threading.Thread(target=f) for f in (first, second)]
    [t.start() for t in both]
    [t.join() for t in both]
    assert seen == {"second": "128"} and spark.conf.get(sizing.SHUFFLE_SETTING) == before
