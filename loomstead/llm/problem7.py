"""Queries on held-out passages in documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead.llm.leaks import find_leaks, without_leaks
from loomstead.sources.tables import table


def p7_matches(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_matches(spark, d).select("doc_id", "item_id")


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """How many documents each leaked item is in."""
    return p7_matches(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"), F.max("n_words").alias("longest_words"))


def p7_kept(spark: SparkSession, d: str) -> DataFrame:
    return without_leaks(table(spark, d, "documents"), p7_matches(spark, d)).select("doc_id")


QUERIES = {"p7_found": p7_found, "p7_matches": p7_matches, "p7_items": p7_items, "p7_kept": p7_kept}
SQL: dict[str, str] = {}
