"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import __spark_entry__ as registered
import pytest

from check import compare, oracle_connection
from reelhouse.plans import change_queries, report_queries

SMALL = "/root/testdata/sf0.001"
# Files are not visible to SQL; their footprint is compared with the disk.
WITHOUT_SQL = {"rewrite_footprint"}
# The queries of the rental and auction operators; the others have SQL and none has Python in its plan.
NAMES = sorted({**report_queries.registry.queries, **change_queries.registry.queries}.keys() - WITHOUT_SQL)


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SMALL)


def test_all_are_registered_with_their_sql():
    assert set(NAMES) <= set(registered.queries()) and set(NAMES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, oracle, name):
    df = registered.queries()[name](spark, SMALL)
    good, text = compare(df, oracle, name)
    assert good, text
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "BatchEvalPython", "MapInPandas"):
        assert unwanted not in plan


def test_entry_has_rows(spark):
    df = registered.entry(spark)
    assert df.columns == ["full_address", "revenue"] and df.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_footprint_of_a_rewrite(spark):
    rows = {r["table_name"]: r for r in registered.queries()["rewrite_footprint"](spark, SMALL).collect()}
    lines = registered.queries()["delete_in_touched_files"](spark, SMALL).count()
    assert rows["after"]["row_count"] == lines < rows["before"]["row_count"]
    assert 0 < rows["dead"]["table_bytes"] <= rows["before"]["table_bytes"]
    assert all(r["files"] and r["table_bytes"] for r in rows.values())
