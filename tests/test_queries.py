"""Every named query against its SQL twin, and what its plan must not contain."""

import re

import pytest

import __spark_entry__ as contract_module
from stallwise.checks import compare, duckdb_sql
from stallwise import catalog
from conftest import SMALL

NAMES = list(catalog.queries())


@pytest.fixture(scope="module")
def tables():
    return compare.duckdb_tables(SMALL)


def test_every_query_has_a_twin():
    assert set(NAMES) == set(duckdb_sql.statements())


def test_entry(spark):
    rows = contract_module.entry(spark)
    assert rows.columns[0] == "price_tier" and rows.count() == 4


@pytest.mark.parametrize("name", NAMES)
def test_matches_twin(spark, tables, name):
    assert compare.differences(spark, tables, SMALL, name) is None


def test_comparison_sees_a_wrong_value_and_a_wrong_type(spark, tables, monkeypatch):
    for sql, problem in [("11", "first differences"), ("CAST(10 AS INTEGER)", "types"), ("CAST(10 AS BIGINT)", None)]:
        statement = {"e01_unique_locations": f"SELECT {sql} AS unique_locations"}
        monkeypatch.setattr(duckdb_sql, "statements", lambda: statement)
        found = compare.differences(spark, tables, SMALL, "e01_unique_locations")
        assert found is None if problem is None else problem in found


def _plan(spark, name):
    frame = catalog.queries()[name](spark, SMALL)
    return frame._jdf.queryExecution().executedPlan().toString()


# Cutting a CSV file's lines into records is the one step that runs in Arrow batches.
@pytest.mark.parametrize("name", [n for n in NAMES if n != "raw_csv_clean"])
def test_plan_stays_in_the_engine_and_joins_without_cross_products(spark, name):
    plan = _plan(spark, name)
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


@pytest.mark.parametrize("name", [n for n in NAMES if n[0] in "qe" and n[1:3].isdigit()])
def test_single_tasks_see_aggregates_only(spark, name):
    """Below every exchange into one partition stands a partial aggregate or a limit."""
    lines = _plan(spark, name).split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert re.search("partial_|TakeOrdered|keys=\\[\\]|HashAggregate", lines[i + 1]), lines[i + 1]


def test_ranked_groups_are_cut_before_the_shuffle(spark):
    plan = _plan(spark, "q10_metro_top")
    assert plan.count("WindowGroupLimit") == 2 and "PushedFilters: [IsNotNull(rating_count), In(location" in plan


def test_counted_pairs_are_shared_between_branches(spark):
    for name in ("e05a_price_rating_corr", "e10_city_score"):
        frame = catalog.queries()[name](spark, SMALL)
        frame.collect()
        final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("FileScan") == 1 and "ReusedExchange" in final
