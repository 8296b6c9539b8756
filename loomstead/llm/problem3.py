"""Queries on near-duplicates of the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead.llm.near_duplicates import NearDuplicates
from loomstead.sources.tables import table


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus").select("id", F.col("target_text").alias("text"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of rows with different content_hash that share at least 0.6 of their runs of three words, 40 words or more each."""
    near = NearDuplicates(_rows(spark, d), similarity=0.6, shingle=3, least_words=40)
    hashes = table(spark, d, "corpus").select("id", "content_hash").dropDuplicates(["id"])
    linked = near.links.select("a", "b").unionByName(near.members.groupBy("rep").count().where("count > 1").select(F.col("rep").alias("a"), F.col("rep").alias("b")))
    used = near.members.join(linked.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "rep", "left_semi")
    rows = near.cuts.cut(used.join(hashes, "id"), "rows")
    # rows of one class and hash are one: pairs of those are found before any pair of rows
    kinds = rows.where("content_hash is not null").select("rep", "content_hash").distinct()
    x, y = (kinds.select(F.col("rep").alias(r), F.col("content_hash").alias(h)) for r, h in (("a", "h"), ("b", "g")))
    pairs = linked.join(x, "a").join(y, "b").where(F.col("h") != F.col("g")).where((F.col("a") != F.col("b")) | (F.col("h") < F.col("g")))
    i, j = (rows.select(F.col("rep").alias(r), F.col("content_hash").alias(h), F.col("id").alias(n)) for r, h, n in (("a", "h", "i"), ("b", "g", "j")))
    pairs = pairs.join(i, ["a", "h"]).join(j, ["b", "g"])
    return pairs.select(F.least("i", "j").alias("corpus_id_a"), F.greatest("i", "j").alias("corpus_id_b")).distinct()


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row per corpus row: class of equal texts, links to other classes, group; five words and 0.8.

    Rows whose text is null or has no word are a class and a group of their own, without links.
    """
    rows = _rows(spark, d)
    groups = NearDuplicates(rows).groups()
    out = rows.where("id is not null").select("id").distinct().join(groups, "id", "left")
    return out.select("id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("group_id", "id").alias("group_id"))


QUERIES = {"p3_found": p3_found, "p3_groups": p3_groups}
SQL: dict[str, str] = {}
