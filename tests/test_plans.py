"""Every registered plan on the smallest tables, against its SQL where it has one."""

import pytest

import __spark_entry__ as entry
from lodestat.plans import load
from lodestat.plans.registry import PLANS
from parity import compare, connect

load()

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(PLANS))
def test_plan_agrees_with_sql(spark, duck, key):
    got = entry.queries()[key](spark, FOLDER).toPandas()
    if key in SQL:
        assert compare(got, duck.execute(SQL[key]).df()) is None


def test_account_features_plan(spark):
    """No join, one exchange, by account slice, and one pass over Arrow batches for all look-backs."""
    plan = entry.queries()["rolling_amount_features"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan and "Cartesian" not in plan
    assert plan.count("Exchange") <= 1


def test_scan_reads_only_needed_columns(spark):
    plan = entry.queries()["scan_pruned"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0
