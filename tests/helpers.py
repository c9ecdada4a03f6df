"""Small helpers shared by the tests."""

import uuid

from ferry.sources.endpoint import Endpoint


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(v) for v in r))


def final_plan(df):
    """Run ``df`` over all its columns and return the plan it ended with."""
    from pyspark.sql import functions as F

    used = df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")))
    used.collect()
    return used._jdf.queryExecution().executedPlan().toString()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def derby():
    """A database inside this process, gone with it."""
    return Endpoint(
        "postgresql",
        "jdbc",
        options={
            "url": f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true",
            "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
            "preferTimestampNTZ": "true",
        },
    )


class FakeSession:
    """Stands for a session with given settings."""

    def __init__(self, **settings):
        self._settings = {k.replace("__", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self._settings.get(key, default)
