"""One query per operator, each over whole driver tables.

Queries that write do so below the session's shared scratch folder and return
what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ferry.fixed_values import LEDGER_CONTAINER, USER_CONTAINER
from ferry.fixtures import (
    AS_OF,
    ledger,
    ledger_documents,
    order_ledger,
    raw_users,
    table,
)
from ferry.functions.rules import next_version, nonblank, valid_email, valid_phone
from ferry.operators import ledger as ledgers, quality
from ferry.operators.verification import differences
from ferry.plans import jobs
from ferry.plans.report import append_report, failed, report, succeeded
from ferry.plans.transfer import Stores, TransferError
from ferry.schemas import fits_user_table, schema_by_name
from ferry.sources import documents, evolution, keyed, objects, synthetic, tables
from ferry.sources.endpoint import Endpoint
from ferry.sources.scratch import is_local, make_folder, materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

USERS = ["first_name", "last_name", "email", "phone", "gender"]


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- stores the queries write to ---------------------------------------------


def _relational(spark: SparkSession) -> Endpoint:
    """The database named in the session, else one inside this process.

    The latter is visible to local mode only: on a cluster name a database
    that all executors reach.
    """
    url = spark.conf.get("spark.ferry.jdbc.url", None)
    options = {"preferTimestampNTZ": "true"}
    if url:
        driver = spark.conf.get("spark.ferry.jdbc.driver", None)
        return Endpoint(
            "postgresql", "jdbc", options=options | {"url": url} | ({"driver": driver} if driver else {})
        )
    if not is_local(spark):
        raise RuntimeError("set spark.ferry.jdbc.url to a database all executors reach")
    return Endpoint(
        "postgresql",
        "jdbc",
        options=options
        | {
            "url": f"jdbc:derby:memory:ferry_{uuid.uuid4().hex};create=true",
            "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
        },
    )


def _stores(spark: SparkSession, relational: Endpoint | None = None, **schemas) -> Stores:
    """Documents as JSON lines, objects as Parquet, and a relational store.

    Unless a database is asked for, the relational store is a Parquet folder,
    which runs on any cluster.
    """
    base = scratch_path(spark, "query")
    return Stores(
        spark,
        [
            Endpoint("mongodb", "json", f"{base}/documents", schemas=schemas),
            relational or Endpoint("postgresql", "parquet", f"{base}/tables", schemas=schemas),
            Endpoint("s3", "parquet", make_folder(spark, f"{base}/objects")),
        ],
    )


def _order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger keys of all customers with orders; some are in the event ledger."""
    return order_ledger(spark, sf_dir).select("db").distinct()


# -- headers, rules, de-duplication ------------------------------------------


@query
def header_check(spark, sf_dir):
    users = raw_users(spark, sf_dir)
    variants = {
        "exact": users.select(*USERS),
        "reordered": users.select(*reversed(USERS)),
        "extra": users.select("rid", *USERS),
        "missing": users.select(*USERS[:-1]),
        "other_case": users.select(*USERS[:2], F.col("email").alias("Email"), *USERS[3:]),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("variant"),
            F.lit(quality.headers_match(df)).alias("header_ok"),
            "row_count",
        )
        for name, df in variants.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def conform_headers(spark, sf_dir):
    messy = raw_users(spark, sf_dir).select(
        "phone", "rid", F.col("email"), "last_name", F.col("gender").alias("Gender"), "first_name"
    )
    return quality.conform_headers(messy, keep=["rid"])


@query
def valid_email_rule(spark, sf_dir):
    return raw_users(spark, sf_dir).select(
        "rid", "email", F.coalesce(valid_email("email"), F.lit(False)).alias("is_valid")
    )


@query
def valid_phone_rule(spark, sf_dir):
    return raw_users(spark, sf_dir).select(
        "rid", "phone", F.coalesce(valid_phone("phone"), F.lit(False)).alias("is_valid")
    )


@query
def nonblank_names(spark, sf_dir):
    return raw_users(spark, sf_dir).select(
        "rid",
        "first_name",
        "last_name",
        nonblank("first_name").alias("first_ok"),
        nonblank("last_name").alias("last_ok"),
    )


@query
def validate_rows(spark, sf_dir):
    return quality.validate_rows(raw_users(spark, sf_dir))


@query
def dedup_email(spark, sf_dir):
    return quality.dedup_email(raw_users(spark, sf_dir), order_by="rid")


@query
def validate_all(spark, sf_dir):
    return quality.validate_all(raw_users(spark, sf_dir), order_by="rid")


@query
def validation_summary(spark, sf_dir):
    return quality.validation_summary(raw_users(spark, sf_dir), order_by="rid")


@query
def drop_surrogate_key(spark, sf_dir):
    return quality.drop_surrogate_key(raw_users(spark, sf_dir).withColumnRenamed("rid", "id"))


@query
def target_contract(spark, sf_dir):
    n = F.col("rid")
    stretched = raw_users(spark, sf_dir).select(
        "rid",
        F.expr("repeat(first_name, cast(rid % 60 as int))").alias("first_name"),
        "last_name",
        "email",
        F.expr("repeat(phone, cast(rid % 8 as int))").alias("phone"),
        F.when(n % 7 == 0, "X").when(n % 11 == 0, F.lit(None)).otherwise(F.col("gender")).alias("gender"),
    )
    return stretched.filter(fits_user_table())


# -- the version ledger ------------------------------------------------------


@query
def ledger_key_filter(spark, sf_dir):
    return ledgers.of_keys(ledger(spark, sf_dir), _order_keys(spark, sf_dir))


@query
def latest_version(spark, sf_dir):
    return ledgers.latest_version(ledger(spark, sf_dir), tie_break="rid")


@query
def latest_version_or_zero(spark, sf_dir):
    return ledgers.latest_version_or_zero(ledger(spark, sf_dir), _order_keys(spark, sf_dir))


@query
def ledger_compact(spark, sf_dir):
    return ledgers.compact(ledger(spark, sf_dir), tie_break="rid")


@query
def ledger_create(spark, sf_dir):
    return ledgers.create(
        ledger(spark, sf_dir).drop("rid"), _order_keys(spark, sf_dir), as_of=AS_OF
    )


@query
def ledger_bump(spark, sf_dir):
    return ledgers.bump(ledger(spark, sf_dir), as_of=AS_OF, tie_break="rid")


@query
def ledger_bump_keys(spark, sf_dir):
    return ledgers.bump(
        ledger(spark, sf_dir), _order_keys(spark, sf_dir), as_of=AS_OF, tie_break="rid"
    )


@query
def ledger_set(spark, sf_dir):
    return ledgers.bump(
        ledger(spark, sf_dir), _order_keys(spark, sf_dir), 2.5, as_of=AS_OF, tie_break="rid"
    )


def _keyed_store(spark, sf_dir):
    """The event ledger spread over folders, keys to move in it, and its files before that.

    There are half as many folders as keys that move, or 64, so that some hold none of these.
    """
    rows = ledger(spark, sf_dir)
    some = rows.where(F.col("db").endswith("0")).select("db").distinct()
    absent = table(spark, sf_dir, "region").select(F.concat_ws("_", F.lit("missing"), "r_regionkey").alias("db"))
    keys = some.where(F.pmod(F.crc32(F.col("db").cast("binary")), F.lit(16)) == 0).unionByName(absent)
    keys = materialize(keys, "keys")
    stores = _stores(spark, **{LEDGER_CONTAINER: rows.schema})
    stores.write(rows, "postgresql", LEDGER_CONTAINER)
    stores.key_ledger("postgresql", buckets=min(max(64, keys.count() // 2), keyed.MOST_FOLDERS))
    path = stores.endpoint("postgresql").path(LEDGER_CONTAINER)
    return stores, keys, path, materialize(objects.inventory(spark, path), "listed")


def _with_changed_files(spark, stores, keys, path, before):
    """The ledger as it is now, and how many files of folders without a moved key changed."""
    layout = keyed.keyed_layout(spark, path)
    moved = keyed.touched(keys, layout)
    # Markers beside the folders lie in none: no number, so no row of ``elsewhere``.
    folder = F.nullif(F.regexp_extract("name", f"/{keyed.BUCKET}=([0-9]+)/[^/]+$", 1), F.lit("")).cast("int")
    elsewhere = before.where(~folder.isin(moved))
    changed = elsewhere.join(objects.inventory(spark, path), ["name", "size", "last_modified"], "left_anti").count()
    return stores.read_ledger("postgresql").withColumns(
        {"changed_elsewhere": F.lit(changed).cast("bigint"), "some_elsewhere": F.lit(elsewhere.count() > 0)}
    )


@query
def ledger_bump_store(spark, sf_dir):
    """Some keys of a stored ledger moved on: files of other folders stay as they are."""
    stores, keys, path, before = _keyed_store(spark, sf_dir)
    stores.bump_versions("postgresql", keys, as_of=AS_OF, tie_break="rid")
    return _with_changed_files(spark, stores, keys, path, before)


@query
def ledger_transfer_store(spark, sf_dir):
    """Versions of the order ledger handed to some keys of a stored ledger."""
    stores, keys, path, before = _keyed_store(spark, sf_dir)
    orders = order_ledger(spark, sf_dir).drop("rid").withColumns(
        {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") for c in ("created_at", "updated_at")}
    )
    stores.write(orders, "mongodb", "orders")
    stores.transfer_versions(
        "mongodb", "postgresql", keys, source_name="orders", as_of=AS_OF, tie_break="rid"
    )
    return _with_changed_files(spark, stores, keys, path, before)


def _transfer_keys(spark, sf_dir):
    """All keys of the event ledger, and one per nation that no ledger has."""
    absent = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("missing_"), F.col("n_nationkey").cast("string")).alias("db")
    )
    return ledger(spark, sf_dir).select("db").unionByName(absent)


@query
def ledger_transfer(spark, sf_dir):
    return ledgers.transfer_versions(
        ledger(spark, sf_dir),
        order_ledger(spark, sf_dir),
        _transfer_keys(spark, sf_dir),
        as_of=AS_OF,
        tie_break="rid",
    )


@query
def ledger_transfer_reverse(spark, sf_dir):
    """Relational to document store, through the stores and back out."""
    source = order_ledger(spark, sf_dir).drop("rid")
    target = ledger(spark, sf_dir).drop("rid")
    stores = _stores(spark, **{LEDGER_CONTAINER: target.schema})
    stores.write(source, "postgresql", LEDGER_CONTAINER)
    stores.write(target, "mongodb", LEDGER_CONTAINER)
    stores.transfer_versions(
        "postgresql", "mongodb", keys=_order_keys(spark, sf_dir), as_of=AS_OF
    )
    return stores.read_ledger("mongodb")


@query
def upsert_by_id(spark, sf_dir):
    """Per key the highest version's row moves on in place, under its own id."""
    rows = ledger(spark, sf_dir)
    best = ledgers.latest_version(rows, tie_break="rid")
    moved = materialize(best.withColumn("test_version", next_version("test_version")))
    return ledgers.replace_by_key(rows, moved, "rid", hot=())


@query
def ledger_job(spark, sf_dir):
    rows = ledger(spark, sf_dir).drop("rid")
    stores = _stores(spark, **{LEDGER_CONTAINER: rows.schema})
    stores.write(rows, "mongodb", LEDGER_CONTAINER)
    return jobs.ledger_job(stores, "mongodb", _order_keys(spark, sf_dir), as_of=AS_OF)


@query
def ledger_documents_bump(spark, sf_dir):
    """Times kept as text."""
    return ledgers.bump(ledger_documents(spark, sf_dir), as_of=AS_OF, tie_break="_id")


@query
def ledger_documents_compact(spark, sf_dir):
    return ledgers.compact(ledger_documents(spark, sf_dir), tie_break="_id")


@query
def ledger_job_relational(spark, sf_dir):
    rows = ledger(spark, sf_dir).drop("rid")
    stores = _stores(spark)
    stores.write(rows, "postgresql", LEDGER_CONTAINER)
    return jobs.ledger_job(stores, "postgresql", _order_keys(spark, sf_dir), as_of=AS_OF)


@query
def versions_to_relational(spark, sf_dir):
    """Document to relational store, through the stores and back out."""
    source, target = ledger(spark, sf_dir).drop("rid"), order_ledger(spark, sf_dir).drop("rid")
    stores = _stores(spark, **{LEDGER_CONTAINER: source.schema})
    stores.write(source, "mongodb", LEDGER_CONTAINER)
    stores.write(target, "postgresql", LEDGER_CONTAINER)
    jobs.versions_flow(
        stores, "mongodb", "postgresql", keys=_transfer_keys(spark, sf_dir), as_of=AS_OF
    )
    return stores.read_ledger("postgresql")


# -- scans and sinks ---------------------------------------------------------


def _csv_roundtrip(spark, sf_dir, name):
    """Ordinary text, with its line breaks, quotes and backslashes, by way of CSV."""
    rows = table(spark, sf_dir, name)
    path = scratch_path(spark, "query")
    objects.write_dataset(rows, path, "csv")
    return objects.read_dataset(spark, path, "csv", rows.schema)


@query
def csv_roundtrip_documents(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, "documents")


@query
def csv_roundtrip_conversations(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, "conversations")


@query
def csv_roundtrip_pages(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, "pages")


@query
def partitioned_text_values(spark, sf_dir):
    """Partition values that look like numbers, and NULL, come back as they were."""
    nation = F.lpad((F.col("c_nationkey")).cast("string"), 3, "0")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 7 != 3, nation).alias("part")
    )
    path = scratch_path(spark, "query")
    objects.write_dataset(rows, path, "parquet", partition_by="part")
    return objects.read_dataset(spark, path, "parquet", rows.schema)


@query
def transfer_refused_rows(spark, sf_dir):
    """Valid users too long for the table are kept in a dataset of their own."""
    long_name = F.when(F.col("rid") % 7 == 0, F.repeat("first_name", 60)).otherwise(F.col("first_name"))
    stores = _stores(spark)
    stores.write(raw_users(spark, sf_dir).withColumn("first_name", long_name), "s3", jobs.USERS_PATH)
    told = jobs.users_to_database(stores, "postgresql", order_by="rid")
    kept = stores.read("postgresql", USER_CONTAINER).withColumn("place", F.lit("table"))
    refused = stores.read("s3", told.refused_to).withColumn("place", F.lit("refused"))
    return kept.unionByName(refused).select(*USERS, "place")


@query
def declared_route_table(spark, sf_dir):
    """Relational ledger to JSON files."""
    rows = ledger(spark, sf_dir).drop("rid")
    stores = _stores(spark)
    stores.write(rows, "postgresql", LEDGER_CONTAINER)
    jobs.run_route(
        stores,
        {
            "src": {"type": "database", "properties": {"storage": "postgresql", "table": LEDGER_CONTAINER}},
            "dest": {
                "type": "file",
                "properties": {
                    "storage": "MinIO", "path": "routes/postgresql", "filename": "ledger_json", "format": "json",
                },
            },
        },
    )
    return stores.read("s3", "routes/postgresql/ledger_json", rows.schema, format="json")




def _object_roundtrip(spark, sf_dir, format):
    users = raw_users(spark, sf_dir)
    path = scratch_path(spark, "query")
    objects.write_dataset(users, path, format)
    return objects.read_dataset(spark, path, format, None if format == "parquet" else users.schema)


@query
def object_roundtrip_parquet(spark, sf_dir):
    return _object_roundtrip(spark, sf_dir, "parquet")


@query
def object_roundtrip_json(spark, sf_dir):
    return _object_roundtrip(spark, sf_dir, "json")


@query
def object_roundtrip_csv(spark, sf_dir):
    return _object_roundtrip(spark, sf_dir, "csv")


@query
def schema_applied_scan(spark, sf_dir):
    path = scratch_path(spark, "query")
    objects.write_dataset(raw_users(spark, sf_dir), path, "json")
    return objects.read_dataset(spark, path, "json", schema_by_name("raw_valid_data_user"))


@query
def file_scan_sniffed(spark, sf_dir):
    rows = ledger(spark, sf_dir).select("rid", "db", "test_version")
    base = scratch_path(spark, "query")
    result = None
    for name in ("rows.parquet", "rows.json", "rows.csv"):
        path = f"{base}/{name}"
        rows.write.format(objects.format_of(path)).option("header", "true").save(path)
        part = objects.read_file(spark, path).select(
            F.lit(name).alias("file"), F.col("rid").cast("bigint").alias("rid"), "db", "test_version"
        )
        result = part if result is None else result.unionByName(part)
    return result


def _awkward_text(spark, sf_dir):
    """Whole documents, a column of numbers that are names, and one of equal scale."""
    key = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        F.lpad((key % 500).cast("string"), 4, "0").alias("code"),
        F.when(key % 5 > 0, F.concat((key % 7).cast("string"), F.lit(".50"))).alias("price"),
        (key / 4).alias("quarter"),
    )


def _read_text(df):
    """The columns, with the types found for them."""
    kinds = F.lit(",".join(kind for _, kind in df.dtypes))
    return df.withColumns({"doc_id": F.col("doc_id").cast("bigint"), "price": F.col("price").cast("string"), "kinds": kinds})


@query
def file_scan_text(spark, sf_dir):
    """A CSV file of whole documents, with line breaks and quotes, whose types are found."""
    path = f"{scratch_path(spark, 'query')}/documents.csv"
    objects.write_dataset(_awkward_text(spark, sf_dir), path, "csv")
    return _read_text(objects.read_file(spark, path))


@query
def store_file_text(spark, sf_dir):
    """The same file put into storage."""
    stores = _stores(spark)
    path = f"{scratch_path(spark, 'query')}/documents.csv"
    objects.write_dataset(_awkward_text(spark, sf_dir), path, "csv")
    stored = stores.store_file(path, "bronze/documents")
    return _read_text(stores.read("s3", "bronze/documents")).withColumn("stored", F.lit(stored).cast("bigint"))


@query
def transfer_partitioned(spark, sf_dir):
    """A dataset partitioned by awkward text and by a date, copied twice without a schema."""
    nation = F.col("c_nationkey")
    part = (
        F.when(nation == 1, "").when(nation == 2, "1e3").when(nation == 3, F.lit(None))
        .when(nation == 4, "\\").otherwise(F.lpad(nation.cast("string"), 3, "0"))
    )
    day = F.date_add(F.lit("2024-02-28").cast("date"), (F.col("c_custkey") % 3).cast("int"))
    rows = table(spark, sf_dir, "customer").select(part.alias("part"), "c_custkey", day.alias("day"), "c_name")
    stores = _stores(spark)
    stores.write(rows, "s3", "bronze/customers", partition_by=["day", "part"])
    stores.transfer("s3", "bronze/customers", "s3", "silver/customers", partition_by=["part", "day"], format="json")
    stores.transfer("s3", "silver/customers", "s3", "gold/customers", source_format="json", partition_by="part")
    return stores.read("s3", "gold/customers")


@query
def glob_scan(spark, sf_dir):
    """All CSV parts of a folder that also holds other files."""
    users = raw_users(spark, sf_dir)
    path = scratch_path(spark, "query")
    objects.write_dataset(users, path, "csv")
    objects.write_dataset(users, path, "json", mode="append")
    return objects.read_parts(spark, path, "part-*.csv", users.schema)


@query
def pipe_dat_scan(spark, sf_dir):
    path = scratch_path(spark, "query")
    rows = ledger(spark, sf_dir).select(
        F.concat(F.lit('"'), "db", F.lit('"')).alias("db"), "test_version", "rid"
    )
    rows.write.options(sep="|", quote="", extension="dat").csv(path)
    return objects.read_pipe_dat(spark, path).withColumn("_c2", F.col("_c2").cast("bigint"))


@query
def object_inventory(spark, sf_dir):
    """Partition folders of a stored ledger, found by listing its objects."""
    path = scratch_path(spark, "query")
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    objects.write_dataset(rows, f"{path}/events", "parquet", partition_by="event_type")
    objects.write_dataset(raw_users(spark, sf_dir), f"{path}/users", "parquet")
    listed = objects.inventory(spark, path).filter(F.col("name").endswith(".parquet"))
    folder = F.regexp_extract("name", r"/((?:events/event_type=[^/]+|users))/[^/]+$", 1)
    return listed.groupBy(folder.alias("folder")).agg(
        (F.min("size") > 0).alias("has_bytes"),
        F.min("last_modified").isNotNull().alias("has_time"),
    )


@query
def object_inventory_full(spark, sf_dir):
    """Every object of a dataset, its marker included, with exact sizes."""
    path = scratch_path(spark, "query")
    texts = table(spark, sf_dir, "documents").select(F.coalesce("text", F.lit("")).alias("value"))
    texts.write.text(f"{path}/texts")
    objects.write_dataset(table(spark, sf_dir, "nation"), f"{path}/nations", "json", partition_by="n_regionkey")
    listed = objects.inventory(spark, path)
    folder, file = F.regexp_extract("name", r"/(texts|nations)/", 1), F.regexp_extract("name", r"([^/]+)$", 1)
    marker = F.when(file.startswith("_"), file).otherwise("")
    exact = F.when(F.col("folder") == "texts", F.sum("size"))
    return (
        listed.select(folder.alias("folder"), marker.alias("marker"), "size", "last_modified")
        .groupBy("folder", "marker")
        .agg(
            exact.alias("bytes"),
            F.when(F.col("marker") != "", F.count("*")).alias("markers"),
            (F.min("last_modified") > F.lit("2020-01-01").cast("timestamp")).alias("has_time"),
        )
    )


@query
def schema_merge_scan(spark, sf_dir):
    """Two batches in one dataset, the first without a gender column."""
    users = raw_users(spark, sf_dir)
    path = scratch_path(spark, "query")
    objects.write_dataset(users.drop("gender").withColumn("batch", F.lit(1)), path, "parquet")
    objects.write_dataset(users.withColumn("batch", F.lit(2)), path, "parquet", mode="append")
    return objects.read_dataset(spark, path, "parquet", options={"mergeSchema": "true"}).select(
        "batch", "rid", *USERS
    )


@query
def schema_widen_scan(spark, sf_dir):
    """Five batches with other columns and types each time, as Parquet and as JSON."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    key, balance = F.col("c_custkey").cast("int"), F.col("c_acctbal").cast("double")
    batches = [
        [key.alias("v"), key.alias("w")],
        [(key.cast("bigint") * 3_000_000_000).alias("v"), balance.alias("w")],
        [balance.alias("v"), key.alias("w"), F.lit("new").alias("x")],
        [F.concat(F.lit("n"), key.cast("string")).alias("v"), key.alias("w")],
        [key.alias("v"), key.alias("w")],
    ]
    result = None
    for format in ("parquet", "json"):
        path = scratch_path(spark, "query")
        for i, columns in enumerate(batches):
            part = rows.select(key.alias("id"), F.lit(i).alias("batch"), *columns)
            objects.write_dataset(part, path, format, "append")
        found = evolution.read_widened(spark, path, format)
        kinds = F.lit(",".join(f"{f.name}:{f.dataType.simpleString()}" for f in found.schema if f.name in "vwx"))
        found = found.select(F.lit(format).alias("format"), *[F.col(c).cast("bigint").alias(c) for c in ("id", "batch")], "v", "w", "x", kinds.alias("kinds"))
        result = found if result is None else result.unionByName(found)
    return result


@query
def partitioned_write(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "event_type")
    path = scratch_path(spark, "query")
    objects.write_dataset(rows, path, "parquet", partition_by="event_type")
    return objects.read_dataset(spark, path, "parquet").select(*rows.columns)


@query
def write_verification(spark, sf_dir):
    stores = _stores(spark)
    written = stores.write(raw_users(spark, sf_dir), "s3", "silver/users")
    found = stores.read("s3", "silver/users").agg(F.count(F.lit(1)).alias("found"))
    return found.select(
        F.lit(written).cast("bigint").alias("expected"),
        "found",
        (F.col("found") == written).alias("verified"),
    )


@query
def content_verification(spark, sf_dir):
    """One row lost, one doubled, one changed in a stored copy: each is found, and nothing else."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    stores = _stores(spark)
    stores.write(rows, "s3", "whole")
    ends = rows.agg(F.min("c_custkey").alias("first"), F.max("c_custkey").alias("last")).first().asDict()
    key = F.col("c_custkey")
    marked = rows.withColumns({c: F.lit(v) for c, v in ends.items()})
    copies = F.when(key == F.col("first"), 0).when(key == F.col("last"), 2).otherwise(1)
    changed = F.when(key == F.col("first") + 1, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    faulty = marked.withColumn("_", F.explode(F.array_repeat(F.lit(1), copies))).select(
        "c_custkey", "c_name", changed.cast(rows.schema["c_acctbal"].dataType).alias("c_acctbal")
    )
    stores.write(faulty, "s3", "faulty")
    found = [
        differences(rows, stores.read("s3", name)).withColumn("copy", F.lit(name)) for name in ("whole", "faulty")
    ]
    return found[0].unionByName(found[1])


@query
def document_roundtrip(spark, sf_dir):
    rows = ledger_documents(spark, sf_dir)
    store = Endpoint("mongodb", "json", scratch_path(spark, "query"))
    documents.write_collection(rows, store)
    return documents.read_collection(spark, store)


@query
def jdbc_roundtrip(spark, sf_dir):
    store = _relational(spark)
    users = quality.validate_all(raw_users(spark, sf_dir), order_by="rid")
    types = {"first_name": "VARCHAR(255)", "last_name": "VARCHAR(255)", "email": "VARCHAR(255)",
             "phone": "VARCHAR(50)", "gender": "VARCHAR(1)"}
    tables.write_table(users, store, USER_CONTAINER, "overwrite", column_types=types)
    return tables.read_table(spark, store, USER_CONTAINER)


@query
def jdbc_partitioned_scan(spark, sf_dir):
    store = _relational(spark)
    rows = ledger(spark, sf_dir)
    tables.write_table(rows, store, LEDGER_CONTAINER, "overwrite", column_types={"db": "VARCHAR(255)"})
    return tables.read_table(
        spark, store, LEDGER_CONTAINER, partition_column="rid", num_partitions=4
    )


@query
def synthetic_users(spark, sf_dir):
    """A synthetic user for every order."""
    return synthetic.users_for(table(spark, sf_dir, "orders"), "o_orderkey")


@query
def literal_versions(spark, sf_dir):
    """The literal documents put into the event ledger's documents by id."""
    return ledgers.replace_by_key(
        ledger_documents(spark, sf_dir), synthetic.literal_documents(spark), "_id", hot=()
    )


# -- transfers ---------------------------------------------------------------


@query
def transfer_row_count(spark, sf_dir):
    rows = ledger_documents(spark, sf_dir)
    stores = _stores(spark, **{LEDGER_CONTAINER: rows.schema})
    stores.write(rows, "mongodb", LEDGER_CONTAINER)
    done = stores.transfer("mongodb", LEDGER_CONTAINER, "s3", "silver/ledger")
    return spark.createDataFrame([done], "success boolean, row_count bigint, source string, target string")


@query
def transfer_document_to_object(spark, sf_dir):
    rows = ledger_documents(spark, sf_dir)
    stores = _stores(spark, **{LEDGER_CONTAINER: rows.schema})
    stores.write(rows, "mongodb", LEDGER_CONTAINER)
    jobs.ledger_to_storage(stores, "mongodb")
    return stores.read("s3", f"mongodb/{LEDGER_CONTAINER}")


@query
def transfer_jdbc_to_object(spark, sf_dir):
    stores = _stores(spark, _relational(spark))
    stores.write(
        ledger(spark, sf_dir), "postgresql", LEDGER_CONTAINER, "overwrite",
        options={"column_types": {"db": "VARCHAR(255)"}},
    )
    jobs.ledger_to_storage(
        stores, "postgresql",
        source_options={"partition_column": "rid", "num_partitions": 4},
    )
    return stores.read("s3", f"postgresql/{LEDGER_CONTAINER}")


@query
def transfer_validated_document(spark, sf_dir):
    stores = _stores(spark, **{USER_CONTAINER: schema_by_name("raw_valid_data_user")})
    stores.write(raw_users(spark, sf_dir), "s3", jobs.USERS_PATH)
    jobs.users_to_database(stores, "mongodb", order_by="rid")
    return stores.read("mongodb", USER_CONTAINER)


@query
def transfer_users_append(spark, sf_dir):
    """Raw users of two overlapping batches, the second appended: no e-mail comes twice."""
    raw = raw_users(spark, sf_dir)
    stores = _stores(spark, **{USER_CONTAINER: schema_by_name("raw_valid_data_user")})
    stores.write(raw.where("rid % 3 > 0"), "s3", "silver/first", format="json")
    stores.write(raw.where("rid % 3 <> 1"), "s3", "silver/second", format="csv")
    stores.transfer_users("mongodb", "silver/first", USER_CONTAINER, order_by="rid", source_format="json")
    done = stores.transfer_users(
        "mongodb", "silver/second", USER_CONTAINER, "append", order_by="rid", source_format="csv"
    )
    found = stores.read("mongodb", USER_CONTAINER)
    return found.withColumns({c: F.lit(getattr(done, c)).cast("bigint") for c in ("total", "valid", "known", "written")})


@query
def transfer_validated_jdbc(spark, sf_dir):
    stores = _stores(spark, _relational(spark))
    stores.write(raw_users(spark, sf_dir), "s3", jobs.USERS_PATH)
    jobs.users_to_database(stores, "postgresql", order_by="rid")
    return stores.read("postgresql", USER_CONTAINER)


@query
def source_readiness(spark, sf_dir):
    rows = ledger_documents(spark, sf_dir)
    stores = _stores(spark, **{LEDGER_CONTAINER: rows.schema})
    stores.write(rows, "mongodb", LEDGER_CONTAINER)
    stores.write(raw_users(spark, sf_dir), "s3", "silver/users")
    found = stores.readiness(
        [("mongodb", LEDGER_CONTAINER), ("s3", "silver/users"), ("postgresql", LEDGER_CONTAINER)]
    )
    return found.select(
        "source",
        "ok",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.col("error").isNotNull().alias("has_error"),
    )


@query
def object_store_job(spark, sf_dir):
    users, versions = jobs.object_store_job(
        _stores(spark), synthetic_users(spark, sf_dir), literal_versions(spark, sf_dir)
    )
    parts = ["dataset", "a", "b", "c", "d", "e"]
    ours = users.select(F.lit("users"), *USERS)
    return ours.unionAll(
        versions.select(
            F.lit("versions"), "_id", "db", F.col("test_version").cast("string"), "created_at", "updated_at"
        )
    ).toDF(*parts)


@query
def declared_route(spark, sf_dir):
    """Document store to JSON files."""
    rows = ledger_documents(spark, sf_dir)
    stores = _stores(spark, **{LEDGER_CONTAINER: rows.schema})
    stores.write(rows, "mongodb", LEDGER_CONTAINER)
    jobs.run_route(
        stores,
        {
            "src": {
                "type": "database",
                "properties": {"storage": "mongodb", "collection": LEDGER_CONTAINER},
            },
            "dest": {
                "type": "file",
                "properties": {
                    "storage": "MinIO",
                    "path": "routes/mongodb",
                    "filename": "ledger_json",
                    "format": "json",
                },
            },
        },
    )
    return stores.read("s3", "routes/mongodb/ledger_json", rows.schema, format="json")


@query
def declared_route_dat(spark, sf_dir):
    """Headerless pipe-separated files to the relational ledger."""
    rows = ledger(spark, sf_dir).drop("rid")
    stores = _stores(spark)
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    rows.select(
        "db", "test_version", F.date_format("created_at", stamp), F.date_format("updated_at", stamp)
    ).write.options(sep="|", quote="", extension="dat").csv(stores.endpoint("s3").path("data"))
    jobs.run_route(
        stores,
        {
            "src": {
                "type": "file",
                "properties": {
                    "storage": "MinIO",
                    "type": "csv",
                    "path": "data",
                    "schema": LEDGER_CONTAINER,
                    "options": {
                        "delimiter": "|",
                        "header": "false",
                        "inferSchema": "true",
                        "stripQuote": "false",
                        "extension": "dat",
                    },
                },
            },
            "dest": {
                "type": "database",
                "properties": {"storage": "postgresql", "table": LEDGER_CONTAINER},
            },
        },
    )
    return stores.read("postgresql", LEDGER_CONTAINER).select(
        "db",
        "test_version",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


@query
def transfer_report(spark, sf_dir):
    """A plain, a validated and a failing transfer, appended to an audit dataset."""
    rows = ledger_documents(spark, sf_dir)
    stores = _stores(spark, **{LEDGER_CONTAINER: rows.schema})
    stores.write(rows, "mongodb", LEDGER_CONTAINER)
    stores.write(raw_users(spark, sf_dir), "s3", jobs.USERS_PATH)
    stores.write(raw_users(spark, sf_dir).filter("false"), "s3", "silver/empty")
    records = [
        succeeded(jobs.ledger_to_storage(stores, "mongodb")),
        succeeded(jobs.users_to_database(stores, "mongodb", order_by="rid")),
    ]
    try:
        jobs.users_to_database(stores, "mongodb", "silver/empty")
    except TransferError as e:
        records.append(failed("s3 to mongodb", e, "s3", "mongodb"))
    audit = stores.endpoint("s3")
    for record in records:
        append_report(report(spark, [record]), audit)
    counts = ["row_count", "total", "valid", "invalid"]
    return stores.read("s3", "audit").select(
        "success",
        "status",
        "message",
        F.coalesce("error", F.lit("")).alias("error"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        "source",
        "target",
    )


_RENAMED = {"valid_email_rule": "valid_email", "valid_phone_rule": "valid_phone"}
for _old, _new in _RENAMED.items():
    _QUERIES[_new] = _QUERIES.pop(_old)
