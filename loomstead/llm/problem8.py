"""Queries on texts that were cut off."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead.llm.truncation import cut_report, find_cuts, length_spikes
from loomstead.sources.tables import table


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return find_cuts(table(spark, d, "documents")).select("doc_id")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return cut_report(docs, find_cuts(docs))


def p8_limits(spark: SparkSession, d: str) -> DataFrame:
    """The limits that the length histograms show."""
    return length_spikes(table(spark, d, "documents"))


def p8_reasons(spark: SparkSession, d: str) -> DataFrame:
    """How many texts were cut at a limit of their source, and how many show it by their end alone."""
    return find_cuts(table(spark, d, "documents")).groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n_cut"))


QUERIES = {"p8_found": p8_found, "p8_report": p8_report, "p8_limits": p8_limits, "p8_reasons": p8_reasons}
SQL: dict[str, str] = {}
