"""Every registered query equals its DuckDB oracle on the smallest driver scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from oracle_harness import compare
from shelfguard.catalog import QUERIES

SF = os.environ.get("SHELFGUARD_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "priority_tier" in df.columns


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF, names=sorted(QUERIES), verbose=False)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(results, name):
    rec = results[name]
    assert "error" not in rec, rec.get("error")
    assert rec["columns_match"], rec
    assert rec["spark_rows"] == rec["oracle_rows"], rec
    assert rec["hash_match"], rec
