"""Every registered query on the small tables, against its SQL where it has one."""

import re

import pytest
from compare import differences, oracle_connection

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
# Fits of minutes; the same code is checked by queries that SQL can solve and in test_models.
FITTED = {
    "boosted_forecast", "specialist_forecast", "trained_variants", "component_forecast", "recursive_trees",
    "recursive_forecast", "recursive_scores", "search_trials", "perm_importance", "forest_importance",
}
# Plans with a forest or a recursion in Python workers.
PYTHON = {"recursive_given", "tree_squared", "tree_median", "tree_quantile", "tree_holdout", "tree_specialists",
          "tree_components", "tree_attribution", "tree_dependence", "op11_fill_middle", "op13_lemp_search"}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_flagship_query_returns_regions(spark):
    assert entry.entry(spark).columns == ["region", "revenue"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert differences(df, con, ORACLES[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # A window over rows that an exchange first brings into one task.
    assert not re.search(r"- Window \[[^\n]*\n(?:[^\n]*- (?:Sort|Project|Filter) [^\n]*\n)*[^\n]*Exchange SinglePartition", plan)
    if name not in PYTHON:
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLES) - FITTED))
def test_other_queries_give_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0
