"""Guard rails on physical plans: the scale properties the design relies on."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from regfold.sources.fixtures import build_main

# queries that only read tables (no files written when they are called)
LAZY = [k for k in E.queries() if k.startswith("tbl_")] + [
    "fan_out_counts", "route_schema", "snapshot_path", "landing_links", "landing_status", "file_names",
    "merge_by_date", "union_schemas", "retention", "audit_failures"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", LAZY)
def test_no_cartesian_or_row_python(spark, key):
    """No pair-producing joins, no row-at-a-time Python, and no row caps or sampling."""
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "GlobalLimit", "CollectLimit", "Sample"):
        assert bad not in plan, f"{key}: {bad}"


def test_page_rows_shuffled_once(spark):
    """Flat and nested arrays of the legal-entity main table read one shared page shuffle;
    the line-5 argmax reads only line-5 rows from the scan."""
    main = build_main(spark, SF_SMALL, "egrul")
    assert "EqualTo(l_linenumber,5)" in _plan(main)
    main.collect()  # run it: the reuse is decided by adaptive execution
    assert "ReusedExchange" in _plan(main)


def test_supplier_statistics_hash_aggregated(spark):
    """Only the argmax over line-5 rows needs a sort-based aggregate."""
    from pyspark.sql import functions as F

    main = build_main(spark, SF_SMALL, "egrul").select("entity_id", "ulustcap")
    plan = _plan(main.where(F.col("ulustcap").isNotNull()))
    assert "HashAggregate" in plan
