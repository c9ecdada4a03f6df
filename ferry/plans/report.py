"""Transfers reported as data: one row each, appended to an audit dataset."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ferry.plans.transfer import Transferred, UsersTransferred
from ferry.sources.endpoint import Endpoint
from ferry.sources.objects import write_dataset

REPORT = (
    "success boolean, status boolean, message string, error string, "
    "row_count bigint, total bigint, valid bigint, invalid bigint, "
    "source string, target string, details map<string,string>"
)


def succeeded(
    outcome: Transferred | UsersTransferred, message: str = "", **details: str
) -> dict[str, Any]:
    """A report record for a finished transfer, with any further details."""
    record = {
        "success": True,
        "status": True,
        "message": message or f"{outcome.source} to {outcome.target}",
        "source": outcome.source,
        "target": outcome.target,
        "details": details,
    }
    if isinstance(outcome, UsersTransferred):
        return record | {
            "row_count": outcome.written,
            "total": outcome.total,
            "valid": outcome.valid,
            "invalid": outcome.invalid,
        }
    return record | {"row_count": outcome.row_count}


def failed(
    message: str, error: Exception, source: str = "", target: str = "", **details: str
) -> dict[str, Any]:
    """A report record for a transfer that raised ``error``."""
    return {
        "success": False,
        "status": False,
        "message": message,
        "error": str(error),
        "source": source or None,
        "target": target or None,
        "details": details,
    }


def report(spark: SparkSession, records: Sequence[dict[str, Any]]) -> DataFrame:
    """The records as a DataFrame; a record is a transfer, so there are few."""
    return spark.createDataFrame(list(records), REPORT)


def append_report(rows: DataFrame, audit: Endpoint, name: str = "audit") -> int:
    return write_dataset(rows, audit.path(name), audit.format, mode="append")
