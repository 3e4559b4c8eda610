"""Every registered query: agrees with its SQL twin, and has a plan fit for large tables."""

import os
import re

import pytest

import __spark_entry__ as contract
from gridlake import suite
from tools.check_oracle import compare, connect

SF_DIR = os.environ.get("SUITE_SF_DIR", "/root/testdata/sf0.001")
# The corpus operators have tests of their own.
NAMES = sorted(suite.QUERIES)

# Approximate by nature, so without a SQL twin.
APPROXIMATE = {"distinct_approx", "agg_summary"}
PYTHON_QUERIES = {"udf_scalar", "udf_map", "udf_sql", "udf_group"}
# A batch's paths of its schemas, and one exact division for each group.
ARROW_QUERIES = {"set_keypaths", "set_keypaths_flat", "set_keypaths_mixed", "schema_symmetry", "agg_exact_sum"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_but_the_approximate_has_a_twin():
    assert set(NAMES) - set(contract.oracle_sql()) == APPROXIMATE
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    assert compare(spark, db, SF_DIR, name) is None
    plan = _plan(contract.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    python = re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMap\w*InPandas", plan)
    assert bool(python) == (name in PYTHON_QUERIES)
    assert "BatchEvalPython" not in plan
    assert ("MapInArrow" in plan) == (name in ARROW_QUERIES)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["bidding_zone", "price_bin_eur", "hours_count"]
    assert df.count() > 0


def test_approximate_count_is_close(spark):
    exact = {r[0]: r[1] for r in contract.queries()["distinct_exact"](spark, SF_DIR).collect()}
    for key, estimate in contract.queries()["distinct_approx"](spark, SF_DIR).collect():
        assert abs(estimate - exact[key]) <= 0.05 * exact[key]


def test_quartiles_are_close(spark, db):
    rows = {r["summary"]: r for r in contract.queries()["agg_summary"](spark, SF_DIR).collect()}
    assert list(rows) == ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]
    want = db.execute("SELECT quantile_disc(l_extendedprice, [0.25, 0.5, 0.75]) FROM lineitem").fetchall()[0][0]
    for label, value in zip(("25%", "50%", "75%"), want):
        assert abs(float(rows[label]["l_extendedprice"]) - value) <= 0.01 * value


@pytest.mark.parametrize(
    ("name", "pushed", "unread"),
    [
        ("flt_eq", "EqualTo(event_type,purchase)", "props"),
        ("flt_cmp", "LessThan(c_acctbal,0.0)", "c_name"),
        ("a15_price_window", "EqualTo(event_type,view)", "props"),
        ("a11_capacity_share", "LessThanOrEqual(l_shipdate", "l_extendedprice"),
        ("latest_snapshot", "", "props"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed, unread):
    plan = _plan(contract.queries()[name](spark, SF_DIR))
    assert pushed in plan
    assert unread not in plan


@pytest.mark.parametrize("name", ["a02_top_groups", "a05_topk", "a06_distinct_negatives", "limit_n", "sorted_head"])
def test_reports_use_top_k(spark, name):
    assert "TakeOrderedAndProject" in _plan(contract.queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name", ["a03_price_stats", "a04_totals", "a07_extreme_dwell", "a12_currency_range", "a13_fx_avg"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    plan = _plan(contract.queries()[name](spark, SF_DIR))
    assert "partial_" in plan
    assert "Window" not in plan
