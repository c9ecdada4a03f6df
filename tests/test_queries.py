import pytest

import __spark_entry__ as contract
from check import difference
from suite.oracles import all_oracles
from suite.queries import _relational, all_queries
from tests.helpers import FakeSession


def test_entry(spark):
    assert contract.entry(spark).count() == 984


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_sql(spark, sf, duck, name):
    df = contract.queries()[name](spark, sf)
    assert difference(df, duck, contract.oracle_sql()[name]) is None


def test_a_cluster_needs_a_database_it_can_reach():
    with pytest.raises(RuntimeError, match="spark.ferry.jdbc.url"):
        _relational(FakeSession(spark__master="yarn"))
    named = FakeSession(spark__master="yarn", spark__ferry__jdbc__url="jdbc:x:y")
    assert _relational(named).options["url"] == "jdbc:x:y"
