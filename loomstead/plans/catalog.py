"""All queries outside the subpackage for training text."""

from __future__ import annotations

from loomstead.plans import collection_queries, corpus_queries, landed_queries, problem5

MODULES = (corpus_queries, collection_queries, landed_queries, problem5)


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
