"""Every registered query against its SQL, and the shape of its plan."""

import oracle
import pytest

import __spark_entry__ as entry_module
from quillrun.plans.catalogue import QUERIES, SQL

ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def base(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, sf_dir, base, name):
    result = entry_module.queries()[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        assert oracle.compare(result, base, SQL[name]) == []
    else:
        assert result.count() > 0


def test_only_the_sampling_and_iterative_queries_lack_sql():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
