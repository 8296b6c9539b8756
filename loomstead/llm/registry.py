"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from loomstead.llm import problem1, problem2, problem3, problem4, problem6, problem7, problem8

MODULES = (problem1, problem2, problem3, problem4, problem6, problem7, problem8)


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
