"""Every registered query against its SQL, and the shape of its plan."""

import re

import pytest

import __spark_entry__ as driver
from tests.compare import connect, differences
from workload import modelling

# The training-data operators have tests of their own and may be absent.
QUERIES = {name: q for name, q in driver.queries().items() if name.startswith("q_")}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name.startswith("q_")}
# Samples, examples and previews; and picks of one winner, which Spark plans as a top-1.
LIMITED = {
    "q_preview", "q_random_sample", "q_hash_sample", "q_duplicate_examples", "q_chart_points", "q_axis_limits",
    "q_choose_k", "q_select_config", "q_same_winner", "q_invariants",
}


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_splits_read_their_own_periods(spark, sf):
    for split in modelling._panel(spark, sf):
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*period", plan), plan
    plan = modelling._year(spark, sf, 1998)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(o_orderdate", plan), plan


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    frame = QUERIES[name](spark, sf)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|NestedLoopJoin", plan), plan
    assert name in LIMITED or not re.search(r"(Local|Global|Collect)Limit|TakeOrdered", plan), plan
    assert not re.search(r"EvalPython|InPandas|InArrow", plan), plan
    assert differences(frame, duck, ORACLES[name]) == ""
