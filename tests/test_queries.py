import pytest

import __spark_entry__ as entry_points
from oracle import compare
from relaybook.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


# Nothing of the data path may run in Python, and no join may pair all rows with all.
UNWANTED = ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", REGISTRY)
def test_query_equals_sql(spark, name):
    found = REGISTRY[name].run(spark, SF_DIR)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [part for part in UNWANTED if part in plan]
    assert compare(found, REGISTRY[name].sql, SF_DIR) > 0


def test_every_query_has_sql():
    assert REGISTRY.keys() <= entry_points.queries().keys()
    assert REGISTRY.keys() <= entry_points.oracle_sql().keys() <= entry_points.queries().keys()


def test_entry(spark):
    found = entry_points.entry(spark)
    assert found.columns == ["row_key", "qualifier", "value"]
    assert found.count() > 0
