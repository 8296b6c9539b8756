"""Queries on the encoded documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead.llm.tokens import decode, encode
from loomstead.sources.tables import table


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode(table(spark, d, "documents"))


def p6_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The text of each document, decoded from its ids."""
    return decode(p6_ids(spark, d)).select("doc_id", F.col("decoded").alias("text"))


def p6_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Tokens per source."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    return p6_ids(spark, d).join(docs, "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.sum(F.size("ids")).alias("n_tokens"))


QUERIES = {"p6_ids": p6_ids, "p6_round_trip": p6_round_trip, "p6_lengths": p6_lengths}
SQL: dict[str, str] = {"p6_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
