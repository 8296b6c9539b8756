"""Queries on personal information."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead.llm.personal import find_personal, redact
from loomstead.sources.tables import table


def rows(spark: SparkSession, d: str) -> DataFrame:
    issues = table(spark, d, "issues").select(F.lit("issues").alias("table_name"), F.col("id").alias("record_id"), F.col("body").alias("text"))
    corpus = table(spark, d, "corpus").select(F.lit("corpus").alias("table_name"), F.col("id").alias("record_id"), F.col("target_text").alias("text"))
    return issues.unionByName(corpus)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return find_personal(rows(spark, d)).select("table_name", "record_id", "kind", "mention_no")


def p4_redacted(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d)
    return redact(r, find_personal(r))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Mentions and records per table and kind."""
    return p4_found(spark, d).groupBy("table_name", "kind").agg(F.count(F.lit(1)).alias("n_mentions"), F.count_if(F.col("mention_no") == 1).alias("n_records"))


QUERIES = {"p4_found": p4_found, "p4_redacted": p4_redacted, "p4_report": p4_report}
SQL: dict[str, str] = {}
