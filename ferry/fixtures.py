"""Test inputs derived from the driver tables (recipes in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = "2025-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User records with deliberate faults, one per order."""
    n = F.col("rid")
    d8 = F.lpad(((n * 7919) % 100_000_000).cast("string"), 8, "0")
    s = n.cast("string")

    def tagged(prefix, value, suffix=""):
        return F.concat(F.lit(prefix), value.cast("string"), F.lit(suffix))

    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("rid"))
        .select(
            "rid",
            F.when(n % 40 == 7, F.lit(None))
            .when(n % 40 == 9, "   ")
            .otherwise(tagged("First", n % 97))
            .alias("first_name"),
            F.when(n % 40 == 17, "")
            .when(n % 40 == 27, F.lit(None))
            .otherwise(tagged("Last", n % 89))
            .alias("last_name"),
            F.when(n % 10 == 1, tagged("user", s, "@example.com"))
            .when(n % 40 == 15, tagged("user", n - 8, "@ais.com"))
            .when(n % 40 == 35, tagged("user", n - 5, "@ais.com"))
            .when(n % 100 == 33, F.lit(None))
            .otherwise(tagged("user", s, "@ais.com"))
            .alias("email"),
            F.when(n % 60 == 2, F.concat(F.lit("07"), d8))
            .when(n % 60 == 12, "12345678")
            .when(n % 60 == 22, "06123456789")
            .when(n % 60 == 32, "abc1234567")
            .when(n % 60 == 42, F.lit(None))
            .otherwise(
                F.concat(
                    F.when(n % 3 == 0, "06").when(n % 3 == 1, "08").otherwise("09"),
                    d8,
                )
            )
            .alias("phone"),
            F.when(n % 2 == 0, "M").otherwise("F").alias("gender"),
        )
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version ledger rows, one per event."""
    return table(spark, sf_dir, "events").select(
        F.concat_ws("_", "event_type", F.col("user_id").cast("string")).alias("db"),
        (F.floor("value").cast("double") / 10).alias("test_version"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("rid"),
    )


def order_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second ledger, one row per order, whose keys partly meet the first's."""
    return table(spark, sf_dir, "orders").select(
        F.concat_ws("_", F.lit("purchase"), F.col("o_custkey").cast("string")).alias("db"),
        (F.floor(F.col("o_totalprice") / 1000).cast("double") / 10).alias("test_version"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").alias("rid"),
    )


def ledger_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as documents: string ids and ISO string timestamps."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    return ledger(spark, sf_dir).select(
        F.lpad(F.hex("rid"), 24, "0").alias("_id"),
        F.date_format("created_at", iso).alias("created_at"),
        "db",
        "test_version",
        F.date_format("updated_at", iso).alias("updated_at"),
    )
