"""Every registered query against its statement, and the shape of the plans."""

import pytest

import __spark_entry__ as contract
from checks.compare import differences, duck
from checks.oracles import all_oracles
from checks.registry import all_queries

QUERIES, ORACLES = all_queries(), all_oracles()
PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_statement(spark, con, small, name):
    assert [d for d in differences(QUERIES[name](spark, small), con, ORACLES[name]) if d != "no rows"] == []


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"fund_table_extract"}))
def test_plans_stay_in_the_jvm_and_cross_nothing(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert not any(node in text for node in PYTHON_NODES)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_date_filter_and_columns_reach_the_scan(spark, small):
    text = plan(QUERIES["coverage"](spark, small))
    assert "l_shipdate" in text and "GreaterThanOrEqual(l_shipdate" in text
    assert "l_returnflag" not in text and "l_discount" not in text


def test_account_lookups_do_not_shuffle_the_ledger(spark, small):
    text = plan(QUERIES["recode_account"](spark, small))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_invoice_shares_use_hash_aggregates(spark, small):
    assert "SortAggregate" not in plan(QUERIES["share_by_value"](spark, small))


def test_refresh_date_filter_reaches_the_instalments(spark, small):
    assert "GreaterThanOrEqual(l_shipdate" in plan(QUERIES["cash_timeline"](spark, small))
