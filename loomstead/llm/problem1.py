"""Queries on splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomstead.llm.components import assign_splits, related_groups, split_report
from loomstead.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return related_groups(*(table(spark, d, t) for t in ("corpus", "issues", "pull_requests", "issue_comments", "pr_comments")))


def p1_splits(spark: SparkSession, d: str) -> DataFrame:
    return assign_splits(p1_found(spark, d))


def p1_split_report(spark: SparkSession, d: str) -> DataFrame:
    return split_report(p1_splits(spark, d))


QUERIES = {"p1_found": p1_found, "p1_splits": p1_splits, "p1_split_report": p1_split_report}
SQL: dict[str, str] = {}
