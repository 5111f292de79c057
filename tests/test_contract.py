"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.comparing import compare, sql_engine

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql():
    return sql_engine(SF_DIR)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    problem = compare(contract.queries()[name](spark, SF_DIR), sql, contract.oracle_sql()[name])
    assert problem is None, problem


def test_bucket_search_gives_k_rows_per_query(spark):
    rows = contract.queries()["vector_top_k_lsh"](spark, SF_DIR).collect()
    per_query: dict = {}
    for r in rows:
        per_query.setdefault(r.query_id, []).append(r["rank"])
        assert 0 <= r.recall <= 1
    assert all(sorted(ranks) == list(range(1, 11)) for ranks in per_query.values())
