"""Every registered query against its flat SQL in DuckDB (small scale; the driver checks sf0.01)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL, digest
from regfold.plans import catalog

KEYS = sorted(catalog.queries())


def test_every_query_has_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


def test_fifty_detail_tables_registered():
    assert len([k for k in KEYS if k.startswith("tbl_")]) == 50


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    con = duck(SF_SMALL)
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    assert digest(got) == digest(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 50
    assert df.columns == ["registry", "table_name", "n_rows"]
