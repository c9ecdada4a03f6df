import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check import connect, session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = session(4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
