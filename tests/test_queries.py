"""Every registered query against DuckDB on the smallest tables, and its plan.

The fixture views are stored once for all tests; `python -m checks.compare` runs
the queries over the views themselves, as the driver does.
"""

from pathlib import Path

import pytest

from checks.compare import difference, duckdb_connection
from checks.fixtures import StoredFixtures
from checks.queries import BUILDERS, ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

# One-row totals and the input limit end in one task by nature; their input is
# already reduced per task.
ONE_TASK = {"agg_count_filtered", "agg_dup_summary", "limit_input"}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_DIR)


@pytest.fixture(scope="module")
def fixtures(spark, tmp_path_factory):
    return StoredFixtures(spark, SF_DIR, str(tmp_path_factory.mktemp("copies"))).store()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(BUILDERS))
def test_agrees_with_duckdb_and_has_a_sound_plan(fixtures, con, name):
    result = BUILDERS[name](fixtures)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in ONE_TASK:
        assert "SinglePartition" not in plan
    assert difference(result, con, name) is None


def test_entry_runs(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["level", "window_start", "window_end_exclusive", "source", "key"]
    assert contract.FLAGSHIP in contract.queries()
