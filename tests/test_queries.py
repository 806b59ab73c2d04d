"""Every registered query against its SQL twin at the smallest scale, and plan checks."""

import pytest
from check import compare

import __spark_entry__ as entry
from churnkit.operators import assemble as A
from churnkit.plans import QUERIES as PLANS
from churnkit.plans import data as D
from churnkit.plans.registry import table

DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(set(SQL) & set(PLANS)))
def test_query_equals_sql(spark, name):
    ok, msg, _ = compare(spark, DIR, name, entry.queries()[name], SQL[name])
    assert ok, msg
    assert "types" not in msg, msg


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() == 150
    assert set(PLANS) <= set(SQL) and set(PLANS) <= set(entry.queries())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(entry.queries()["p7_filters"](spark, DIR))
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(l_ship" in plan
    assert "l_extendedprice" not in plan.split("ReadSchema")[1]


def test_customer_360_has_no_driver_round_trip(spark):
    """Building the plan starts no job: reference days are scalar subqueries."""
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    for t in ("orders", "customer", "events", "lineitem", "nation", "region"):
        table(spark, DIR, t).schema
    seen = set(tracker.getJobIdsForGroup(None))
    A.customer_360(D.customers(spark, DIR), D.holdings(spark, DIR), D.transactions(spark, DIR), D.risk(spark, DIR),
                   D.TIERS, D.DEPOSITS)
    new = set(tracker.getJobIdsForGroup(None)) - seen
    # reading a parquet footer for its schema is a job of its own, one per table read
    assert len(new) <= 8, (before, new)
