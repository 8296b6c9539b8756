"""References to records that are missing, deleted or came later."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstead.operators.joins import join_unique

ISSUE_TYPES = ("issue", "issue_comment")
FOUND = ["table_name", "record_id", "period", "outcome"]


def key(space: str, repo: Column | None, number: Column) -> Column:
    """A key of one space: ids of issues (i) or pull requests (p), numbers of any parent (n) or of pull requests (np)."""
    return F.struct(F.lit(space).alias("space"), (repo if repo is not None else F.lit(0)).cast("long").alias("repo"), number.cast("long").alias("number"))


def parent_rows(issues: DataFrame, pulls: DataFrame) -> DataFrame:
    """One row per parent: kind, id, repository, number, whether it is deleted, and when it was first collected."""
    wanted = ["id", "repository_id", "number", "state", "collected_at"]
    rows = issues.select(F.lit("i").alias("kind"), *wanted).unionByName(pulls.select(F.lit("p").alias("kind"), *wanted))
    return rows.where(F.col("id").isNotNull()).groupBy("kind", "id").agg(
        F.first("repository_id", True).alias("p_repo"),
        F.first("number", True).alias("p_number"),
        F.max(F.coalesce(F.col("state") == "deleted", F.lit(False))).alias("p_deleted"),
        F.min("collected_at").alias("p_first"),
    )


def parent_keys(parents: DataFrame) -> DataFrame:
    """Parents by every key that may name them. Where two share a number, the live and the earlier one count."""
    by_id = F.when(F.col("kind") == "i", key("i", None, F.col("id"))).otherwise(key("p", None, F.col("id")))
    numbered = F.col("p_repo").isNotNull() & F.col("p_number").isNotNull()
    any_, pull = F.when(numbered, key("n", F.col("p_repo"), F.col("p_number"))), F.when(numbered & (F.col("kind") == "p"), key("np", F.col("p_repo"), F.col("p_number")))
    rows = parents.select(F.explode(F.array(by_id, any_, pull)).alias("fk"), "p_deleted", "p_first").where("fk is not null")
    return rows.groupBy("fk").agg(F.min("p_deleted").alias("p_deleted"), F.min("p_first").alias("p_first"))


def orphan_references(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """Cases among ``refs`` (table_name, record_id, fk, seen, at) whose ``fk`` names no live, earlier row of ``parents`` (fk, p_deleted, p_first).

    The distinct keys are taken first and matched against the parents (an anti-join keeps the missing ones); only the keys
    that can make a case are joined back to the rows. A key without a number names nothing and is no case, rows without an
    id are ignored, an empty parent table makes every reference ``missing``, a null ``seen`` is never ``late``. Rows
    delivered several times count once, at their first time.
    """
    refs = refs.where("record_id is not null and fk.number is not null and fk.repo is not null")
    refs = refs.groupBy("table_name", "record_id", "fk").agg(F.min("seen").alias("seen"), F.min("at").alias("at"))
    keys = refs.groupBy("fk").agg(F.min("seen").alias("earliest"))
    missing = keys.join(parents, "fk", "left_anti").select("fk", F.lit(None).cast("boolean").alias("p_deleted"), F.lit(None).cast("timestamp_ntz").alias("p_first"))
    doubtful = keys.join(parents, "fk").where(F.col("p_deleted") | (F.col("p_first") > F.col("earliest"))).select("fk", "p_deleted", "p_first")
    cases = join_unique(refs, missing.unionByName(doubtful), ["fk"], "inner")
    outcome = F.when(F.col("p_deleted").isNull(), "missing").when(F.col("p_deleted"), "deleted").when(F.col("p_first") > F.col("seen"), "late")
    return cases.select("table_name", "record_id", F.date_format("at", "yyyy-MM").alias("period"), outcome.alias("outcome")).where("outcome is not null")


def reference(rows: DataFrame, table_name: str, fk: Column, seen: Column, at: Column) -> DataFrame:
    return rows.select(F.lit(table_name).alias("table_name"), F.col("id").alias("record_id"), fk.alias("fk"), seen.alias("seen"), at.alias("at"))


def item_number() -> Column:
    """The number an item names: parent_number or, where null, the number that ends the payload's URL."""
    url = F.coalesce(F.get_json_object("payload", "$.issue_url"), F.get_json_object("payload", "$.pull_request_url"))
    return F.coalesce(F.col("parent_number").cast("long"), F.regexp_extract(url, r"/([0-9]{1,18})/*\s*$", 1).try_cast("long"))


def normal_category(column: str = "category") -> Column:
    return F.regexp_replace(F.lower(F.trim(column)), r"[\s_-]+", "_")


def find_orphans(issues: DataFrame, pulls: DataFrame, issue_comments: DataFrame, pr_comments: DataFrame, corpus: DataFrame, items: DataFrame) -> DataFrame:
    """All orphan references (table_name, record_id, period, outcome), each once. Extra columns of the inputs are ignored.

    Corpus rows are never late. Items that are invalid records name nothing; a null category excludes nothing.
    """
    seen, at, changed = F.col("collected_at"), F.col("created_at"), F.col("source_updated_at")
    parent = F.when(F.col("source_type").isin(*ISSUE_TYPES), key("i", None, F.col("parent_id"))).otherwise(key("p", None, F.col("parent_id")))
    valid = F.coalesce(normal_category() != "invalid_record", F.lit(True))
    review = F.coalesce(F.col("stream") == "review_comments", F.lit(False))
    named = F.when(review, key("np", F.col("repository_id"), item_number())).otherwise(key("n", F.col("repository_id"), item_number()))
    refs = [
        reference(issue_comments, "issue_comments", key("i", None, F.col("issue_id")), seen, at),
        reference(pr_comments, "pr_comments", key("p", None, F.col("pull_request_id")), seen, at),
        reference(corpus, "corpus", parent, F.lit(None).cast("timestamp_ntz"), changed),
        reference(items.where(valid), "unresolved_collection_items", named, F.col("first_seen_at"), F.col("first_seen_at")),
    ]
    found = orphan_references(reduce(DataFrame.unionByName, refs), parent_keys(parent_rows(issues, pulls)))
    return found.select(*FOUND).distinct()


def orphan_report(found: DataFrame) -> DataFrame:
    """Counts per table, period and outcome."""
    return found.groupBy("table_name", "period", "outcome").agg(F.count(F.lit(1)).alias("n_references"))
