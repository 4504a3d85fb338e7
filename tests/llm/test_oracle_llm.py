"""The operators that SQL can express equal their DuckDB statements."""

import os
import sys

import pytest
from lamina.llm.queries import ORACLE_SQL, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "scripts"))
from oracle_check import compare, duck  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, sf_small, name):
    r = compare(spark, con, name, sf_small, QUERIES[name], ORACLE_SQL[name])
    assert r["cols_match"] and r["spark_rows"] == r["oracle_rows"] and r["values_match"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_other_queries_cover_every_document(spark, sf_small, name):
    rows = QUERIES[name](spark, sf_small).collect()
    ids = {r["doc_id"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} <= ids if name.startswith("op1_") else {r["doc_id"] for r in rows} == ids
