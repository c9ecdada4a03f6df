import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ferry.fixed_values import USER_COLUMNS
from ferry.fixtures import raw_users
from ferry.operators import quality
from ferry.schemas import RAW_USER, fits_user_table, schema_by_name
from tests.helpers import plan, rows

GOOD = ("Ann", "Lee", "ann@ais.com", "0612345678", "F")


def users(spark, *records):
    return spark.createDataFrame(list(records), RAW_USER)


def test_headers_must_match_exactly(spark):
    df = users(spark, GOOD)
    assert quality.headers_match(df)
    assert not quality.headers_match(df.select(*reversed(USER_COLUMNS)))
    assert not quality.headers_match(df.withColumn("age", F.lit(1)))
    assert not quality.headers_match(df.drop("gender"))
    assert not quality.headers_match(df.withColumnRenamed("email", "Email"))
    assert quality.headers_match(users(spark))


def test_conform_drops_adds_and_orders(spark):
    df = users(spark, GOOD).select("gender", "email", F.lit(3).alias("age"), "first_name", "last_name")
    fixed = quality.conform_headers(df)
    assert fixed.columns == USER_COLUMNS
    assert rows(fixed) == [("Ann", "Lee", "ann@ais.com", None, "F")]
    assert quality.conform_headers(users(spark)).columns == USER_COLUMNS


def test_wrong_case_column_is_not_the_column(spark):
    df = users(spark, GOOD).withColumnRenamed("email", "Email")
    fixed = quality.conform_headers(df)
    assert fixed.first()["email"] is None
    assert quality.validate_all(df).count() == 0


def test_repeated_columns_are_refused(spark):
    df = users(spark, GOOD)
    twice = df.select("*", "email")
    for check in (quality.headers_match, quality.conform_headers, quality.validate_all):
        with pytest.raises(ValueError, match="email"):
            check(twice)


def test_strict_headers(spark):
    df = users(spark, GOOD)
    assert quality.validate_all(df, fix_headers=False).count() == 1
    with pytest.raises(ValueError, match="headers"):
        quality.validate_all(df.drop("gender"), fix_headers=False)
    with_id = df.withColumn("rid", F.lit(1))
    assert quality.validate_all(with_id, fix_headers=False, order_by="rid").columns == USER_COLUMNS


@pytest.mark.parametrize(
    "change, valid",
    [
        ({}, True),
        ({"email": "A@AIS.com"}, False),
        ({"email": "a@ais.com\n"}, True),
        ({"email": "@ais.com"}, False),
        ({"email": "a b@ais.com"}, False),
        ({"email": "a.b_c%d+e-f@ais.com"}, True),
        ({"email": "a@aisxcom"}, False),
        ({"email": None}, False),
        ({"first_name": "\t"}, True),
        ({"first_name": "   "}, False),
        ({"first_name": None}, False),
        ({"last_name": ""}, False),
        ({"phone": "0712345678"}, False),
        ({"phone": "061234567"}, False),
        ({"phone": "06123456789"}, False),
        ({"phone": "08abcdefgh"}, False),
        ({"phone": None}, False),
        ({"gender": "?"}, True),
        ({"gender": None}, True),
    ],
)
def test_row_rule(spark, change, valid):
    record = dict(zip(USER_COLUMNS, GOOD)) | change
    df = users(spark, tuple(record.values()))
    assert quality.validate_rows(df).count() == int(valid)


def test_missing_required_column(spark):
    with pytest.raises(ValueError, match="phone"):
        quality.validate_rows(users(spark, GOOD).drop("phone"))


def test_null_emails_are_one_group(spark):
    df = users(spark, GOOD, ("A", "B", None, "1", "M"), ("C", "D", None, "2", "F"))
    assert quality.dedup_email(df).count() == 2
    assert quality.validate_all(df).count() == 1


def test_dedup_without_email_changes_nothing(spark):
    df = users(spark, GOOD, GOOD).drop("email")
    assert quality.dedup_email(df) is df


def test_survivor_follows_the_order_column(spark):
    df = spark.createDataFrame(
        [("x@ais.com", 3, "c"), ("x@ais.com", 1, "b"), ("x@ais.com", 2, "a")], "email string, n int, v string"
    )
    assert rows(quality.dedup_email(df, order_by="n")) == [("x@ais.com", 1, "b")]
    assert quality.dedup_email(df, order_by="v").columns == df.columns


def test_null_order_values_do_not_lose_rows(spark):
    df = spark.createDataFrame([("x@ais.com", None, "b"), ("y@ais.com", None, "a")], "email string, n int, v string")
    assert quality.dedup_email(df, order_by="n").count() == 2


def test_dedup_comes_before_the_filter(spark):
    bad = ("Ann", "Lee", "ann@ais.com", "1", "F", 1)
    good = GOOD + (2,)
    df = spark.createDataFrame([good, bad], [*USER_COLUMNS, "rid"])
    assert quality.validate_all(df, order_by="rid").count() == 0


@pytest.mark.parametrize("sf, raw, firsts, filtered, valid", [
    ("0.001", 1500, 1411, 1059, 984),
    ("0.01", 15000, 14101, 10600, 9850),
])
def test_fixture_counts(spark, sf, raw, firsts, filtered, valid):
    df = raw_users(spark, f"/root/testdata/sf{sf}")
    assert df.count() == raw
    assert quality.dedup_email(df, "rid").count() == firsts
    assert quality.validate_rows(df).count() == filtered
    assert quality.validate_all(df, order_by="rid").count() == valid
    summary = quality.validation_summary(df, "rid").first()
    assert tuple(summary) == (raw, valid, raw - valid)


def test_empty_frame(spark):
    df = users(spark)
    assert quality.validate_all(df).columns == USER_COLUMNS
    assert tuple(quality.validation_summary(df).first()) == (0, 0, 0)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["Ann", " ", None]),
            st.sampled_from(["Lee", ""]),
            st.sampled_from(["a@ais.com", "b@ais.com", "c@x.com", None]),
            st.sampled_from(["0612345678", "07", None]),
            st.sampled_from(["M", "F", None]),
        ),
        max_size=12,
    ),
    st.integers(1, 5),
)
def test_outcome_does_not_depend_on_partitions(spark, records, parts):
    df = users(spark, *records)
    once = rows(quality.validate_all(df))
    assert rows(quality.validate_all(df.repartition(parts))) == once
    assert set(once) <= set(records)
    emails = [r[2] for r in once]
    assert len(emails) == len(set(emails))


def test_email_rule_runs_before_the_shuffle(spark, tmp_path, sf):
    path = str(tmp_path / "users")
    raw_users(spark, sf).write.parquet(path)
    text = plan(quality.validate_all(spark.read.parquet(path), order_by="rid"))
    before = text[text.index("Exchange"):]
    assert text.count("Exchange hashpartitioning") == 1
    assert "RLIKE(email" in before and "IsNotNull(email)" in before
    assert "partial_min" in before


def test_total_reads_no_columns(spark, tmp_path, sf):
    path = str(tmp_path / "users")
    raw_users(spark, sf).write.parquet(path)
    text = plan(quality.validation_summary(spark.read.parquet(path), "rid"))
    assert "ReadSchema: struct<>" in text


def test_target_contract(spark):
    df = users(
        spark,
        GOOD,
        ("A" * 255, "Lee", "1@ais.com", "0" * 50, "M"),
        ("A" * 256, "Lee", "2@ais.com", "0", "M"),
        ("A", "Lee", "3@ais.com", "0" * 51, "M"),
        ("A", "Lee", "4@ais.com", "0", "X"),
        ("A", None, None, None, None),
    )
    assert df.filter(fits_user_table()).count() == 3


def test_schemas_by_name():
    assert schema_by_name("raw_valid_data_user").names == USER_COLUMNS
    assert schema_by_name("user").names == ["id", *USER_COLUMNS]
    ledger = schema_by_name("db_connect")
    assert ledger.simpleString() == "struct<db:string,test_version:double,created_at:timestamp,updated_at:timestamp>"
    assert not any(f.nullable for f in ledger)
    with pytest.raises(ValueError, match="nope"):
        schema_by_name("nope")
