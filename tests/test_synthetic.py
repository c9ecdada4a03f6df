from pyspark.sql import functions as F

from ferry.fixed_values import FIRST_NAMES, LAST_NAMES, USER_COLUMNS
from ferry.functions.rules import valid_email, valid_phone
from ferry.operators.quality import validate_rows
from ferry.sources import synthetic
from tests.helpers import rows


def test_rows_do_not_depend_on_partitions(spark):
    ids = spark.range(2000)
    once = rows(synthetic.users_for(ids.repartition(2), "id"))
    assert rows(synthetic.users_for(ids.repartition(7), "id")) == once
    assert rows(synthetic.users_for(ids, "id", seed=1)) != once


def test_default_size(spark):
    df = synthetic.users(spark)
    assert df.count() == 10_000 and df.columns == USER_COLUMNS


def test_mix(spark):
    n = 20_000
    df = synthetic.users(spark, n).cache()

    def share(condition):
        return df.filter(condition).count() / n

    assert abs(share(~valid_email("email")) - 0.10) < 0.01
    assert abs(share(~valid_phone("phone")) - 0.10) < 0.01
    assert abs(share("first_name IS NULL") - 0.025) < 0.005
    assert abs(share("last_name = ''") - 0.025) < 0.005
    repeated = n - df.select("email").distinct().count()
    # A repeat needs an earlier id with a good address, which 85 % have.
    assert abs(repeated / n - 0.05 * 0.85) < 0.008
    assert abs(validate_rows(df).count() / n - 0.75) < 0.015
    assert abs(share("gender = 'M'") - 0.5) < 0.02
    df.unpersist()


def test_values(spark):
    df = synthetic.users(spark, 3000)
    assert df.filter(F.col("first_name").isNotNull() & ~F.col("first_name").isin(FIRST_NAMES)).count() == 0
    assert df.filter((F.col("last_name") != "") & ~F.col("last_name").isin(LAST_NAMES)).count() == 0
    bad = df.filter(~valid_phone("phone")).select("phone")
    shapes = {len(r[0]) for r in bad.collect()}
    assert shapes == {8, 9, 10, 11}
    assert df.filter(F.col("email").contains("user.") | F.col("email").contains(".test")).count() > 0


def test_first_id_cannot_repeat(spark):
    for seed in range(40):
        row = synthetic.users_for(spark.range(1), "id", seed).first()
        assert "0@" in row["email"]
        if seed > 15:
            break


def test_literal_documents(spark):
    df = synthetic.literal_documents(spark)
    assert df.columns == ["_id", "created_at", "db", "test_version", "updated_at"]
    assert rows(df.select("db", "test_version")) == [("mongodb", 1.2), ("mysql", 1.3), ("postgresql", 1.2)]
