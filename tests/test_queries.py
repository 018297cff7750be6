"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from answerloom.plans.oracles import ORACLES
from answerloom.plans.queries import REGISTRY
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert compare(spark, con, SF, name, df).startswith("ok")


def test_every_sql_has_a_query_and_every_query_of_the_library_its_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY) == set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["conv_id", "question", "search_query", "context", "answer"]
    assert df.count() > 0
