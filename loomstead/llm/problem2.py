"""Queries on languages of the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead.llm import languages as L
from loomstead.sources.tables import table


def rows(spark: SparkSession, d: str) -> DataFrame:
    titled = F.coalesce(F.col("source_type").isin("issue", "pull_request"), F.lit(False))
    return table(spark, d, "corpus").where("id is not null and target_text is not null").select("id", F.col("target_text").alias("text"), L.label_code(F.col("language")).alias("label"), titled.alias("titled"))


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d)
    m = L.fit(r)
    out = L.found(L.row_languages(r, m)) if m else _empty(spark, "id long, language string")
    return out.select(F.col("id").alias("corpus_id"), "language")


def p2_languages(spark: SparkSession, d: str) -> DataFrame:
    """Each row's main language with its confidence and the label it had."""
    r = rows(spark, d)
    m = L.fit(r)
    out = L.row_languages(r, m) if m else _empty(spark, L.ROWS)
    best = out.groupBy("id").agg(F.first("label").alias("label"), F.max(F.struct("share", "confidence", "language")).alias("t"))
    return best.select(F.col("id").alias("corpus_id"), "label", F.col("t.language").alias("language"), F.col("t.confidence").alias("confidence"))


def p2_segments(spark: SparkSession, d: str) -> DataFrame:
    """Each passage with its language and confidence."""
    r = rows(spark, d)
    m = L.fit(r)
    return (L.segments(r, m) if m else _empty(spark, L.SEGMENTS)).withColumnRenamed("id", "corpus_id").distinct()


QUERIES = {"p2_found": p2_found, "p2_languages": p2_languages, "p2_segments": p2_segments}
SQL: dict[str, str] = {}
