"""All registered queries."""

from __future__ import annotations

from ledgerloom.contract import batch_queries, landing_queries, oracle, oracle_search, search_queries

QUERIES = {**batch_queries.QUERIES, **landing_queries.QUERIES, **search_queries.QUERIES}
ORACLE = {**oracle.ORACLE, **oracle_search.ORACLE}
