"""Every registered query equals its DuckDB oracle (rows, names, values)."""

import os
import sys

import pytest

import __spark_entry__ as E
from lamina.plans.oracle import ORACLE_SQL
from lamina.plans.queries import QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts"))
from oracle_check import compare, duck  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    r = compare(spark, con, name, sf_small, E.queries()[name], E.oracle_sql()[name])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ranking_ingresos" in df.columns
