"""Every registered query against its SQL, and properties of the whole set."""

import pytest

import __spark_entry__ as entry
from registry.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
GROUPED = {name for group in entry.GROUPS for name in group.QUERIES}
QUERIES = {name: query for name, query in entry.queries().items() if name in GROUPED}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in GROUPED}


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    assert compare(QUERIES[name](spark, FOLDER), database.sql(ORACLES[name])) is None


def test_every_query_has_sql_and_rows(database):
    assert set(QUERIES) == set(ORACLES)
    empty = [name for name, sql in ORACLES.items() if not database.sql(sql).limit(1).fetchall()]
    assert empty == []


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 11


@pytest.mark.parametrize("name", ["element_gate_report", "rule_counts", "gp_violations", "catalog_metrics", "log_rolling_bytes_all"])
def test_plans_have_no_python_and_no_cross_join(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["rule_gates", "element_gate_report", "gp_first_violation", "catalog_merge", "gp_gate_count_drop"])
def test_plans_aggregate_without_sorting(spark, name):
    assert "SortAggregate" not in QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["log_rolling_bytes", "log_rolling_bytes_all", "state_attempt_order", "star_list", "catalog_index_order"])
def test_ranks_and_running_sums_use_no_single_partition(spark, name):
    assert "SinglePartition" not in QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["catalog_shard_changes", "catalog_manifest"])
def test_a_merge_that_is_read_twice_is_run_once(spark, name):
    found = entry.queries()[name](spark, FOLDER)
    assert not [path for path in found.inputFiles() if "orders.parquet" in path]
