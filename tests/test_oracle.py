"""Every registered query against its DuckDB oracle (row count, column names,
order-insensitive values) at sf0.001; set ``VIALFLOW_ORACLE_SF=0.01`` for the
driver's scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck
from vialflow.queries import QUERIES

SF = os.environ.get("VIALFLOW_ORACLE_SF", "0.001")
SF_DIR = f"/root/testdata/sf{SF}"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_registry_complete():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)  # every query of the specimen tables has an oracle


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_DIR, con)
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 66
