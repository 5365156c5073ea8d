"""Every registered query against its SQL, and the plans of the main ones."""

import pytest
from pyspark.sql import functions as F

from shiftroll.functions import joins
from shiftroll.plans import oracle, registry
from tests.check_sql import compare, connect
from tests.conftest import SMALL

QUERIES = registry.registered()
SQL = oracle.statements()
MEDIUM = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    assert compare(df, con, SQL[name]) == []
    # no plan crosses tables, leaves the JVM, or gathers rows in one task unless they are partial totals
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text
    lines = text.splitlines()
    gathered = [below for line, below in zip(lines, lines[1:], strict=False) if "SinglePartition" in line]
    assert all("HashAggregate(keys=[], functions=[partial_" in below for below in gathered)


# rows and amounts computed beforehand
EXPECTED = {
    "earnings": (8524, 2410532597),
    "deductions": (4124, 1155392051),
    "employer_cost": (4268, 1197083535),
    "balances": (8582, 2384392285),
    "ytd_takeon": (4205, 1132603134),
    "deprecated": (12637, 3521461505),
    "codetype_not_found": (9927, 2770998601),
    "employee_not_loaded": (4792, 1352291146),
}


def test_routing_summary_figures(spark):
    summary = QUERIES["routing_summary"](spark, MEDIUM)
    totals = summary.groupBy("destination").agg(F.sum("row_count"), F.sum("amount_minor")).collect()
    assert {r[0]: (r[1], r[2]) for r in totals} == EXPECTED


SKEWED = ["stage_amounts", "routing_summary", "import_alpha", "import_bank_details", "carry_run_history", "tenant_earnings"]


@pytest.mark.parametrize("name", SKEWED)
def test_results_are_the_same_without_broadcast(spark, con, name, monkeypatch):
    """As on data beyond every broadcast limit, with all frequent keys spread."""
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_KEY_MIN_ROWS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare(QUERIES[name](spark, SMALL), con, SQL[name]) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_reads_only_what_the_flagship_needs(spark):
    text = plan(QUERIES["routing_summary"](spark, SMALL))
    line = next(x for x in text.splitlines() if "lineitem.parquet" in x)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_discount:double>" in line
