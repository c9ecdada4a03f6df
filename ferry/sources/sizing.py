"""Shuffle and scan sizes that fit the input of a job."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

MB = 1024 * 1024
# Input per shuffle partition, and bounds on the number of partitions. Many more
# of them would cost more in block bookkeeping than they save in spilling.
SHUFFLE_BYTES = 256 * MB
MOST_SHUFFLE_PARTITIONS = 50_000
# Scan tasks grow with the input beyond this many of them.
MOST_SCAN_TASKS = 100_000
SCAN_BYTES, MOST_SCAN_BYTES = 128 * MB, 1024 * MB
SHUFFLE_SETTING = "spark.sql.shuffle.partitions"
# Spark's stand-in where a source cannot tell its size.
UNKNOWN = 2**62


def input_bytes(df: DataFrame) -> int:
    """Bytes of the sources of ``df`` as the optimizer knows them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN)


def shuffle_partitions(df: DataFrame) -> int:
    """As many as the session sets, or more where the input of ``df`` needs them."""
    set_ = int(df.sparkSession.conf.get(SHUFFLE_SETTING))
    return max(set_, settings_for(input_bytes(df))[SHUFFLE_SETTING])


def settings_for(size: int) -> dict[str, int]:
    """Settings for an input of ``size`` bytes."""
    return {
        SHUFFLE_SETTING: min(MOST_SHUFFLE_PARTITIONS, size // SHUFFLE_BYTES + 1),
        "spark.sql.files.maxPartitionBytes": min(
            MOST_SCAN_BYTES, max(SCAN_BYTES, size // MOST_SCAN_TASKS)
        ),
    }


def _bytes(value: str) -> int:
    units = {"k": 1024, "m": MB, "g": 1024 * MB}
    text = value.strip().lower().removesuffix("b")
    return int(text[:-1]) * units[text[-1]] if text[-1:] in units else int(text)


# Settings that jobs have raised: how many jobs hold each, and what it was before.
_raised: dict[tuple[int, str], tuple[int, str]] = {}
_lock = threading.Lock()


@contextmanager
def sized_for(df: DataFrame) -> Iterator[None]:
    """Raise the session's settings for the jobs inside, never lower them.

    Adaptive execution joins small shuffle partitions but cannot make more of
    them, so a shuffle has to start with enough. Jobs that overlap share a raised
    setting; the last one to end puts the session's own value back.
    """
    conf, session = df.sparkSession.conf, id(df.sparkSession._jsparkSession)
    wanted = settings_for(input_bytes(df))
    with _lock:
        for setting, size in wanted.items():
            now = conf.get(setting)
            jobs, before = _raised.get((session, setting), (0, now))
            _raised[session, setting] = jobs + 1, before
            if _bytes(now) < size:
                conf.set(setting, str(size))
    try:
        yield
    finally:
        with _lock:
            for setting in wanted:
                jobs, before = _raised.pop((session, setting))
                if jobs > 1:
                    _raised[session, setting] = jobs - 1, before
                elif conf.get(setting) != before:
                    conf.set(setting, before)
