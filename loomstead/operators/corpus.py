"""The versioned corpus: candidates of five kinds, cleaned rows, content versions and duplicate pointers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstead.functions.text import CLEANING_VERSION, clean_text, content_hash, language_tag, model_input, paragraphs
from loomstead.operators.joins import hot_keys, join_unique
from loomstead.operators.upsert import keep_last, upsert, with_ids
from loomstead.schemas import KEYS, UPDATES
from loomstead.sources.shared import Cuts

#: The kinds in the order in which ids are given.
KINDS = ("issue", "pull_request", "issue_comment", "pr_issue_comment", "pr_review_comment")
COMMENT_KINDS = {"issue_comment": "pr_issue_comment", "review_comment": "pr_review_comment"}
CANDIDATE = ["source_type", "source_id", "parent_id", "title", "body", "path", "source_updated_at"]


def latest(rows: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Rows delivered several times, once: as collected last."""
    return keep_last(rows, keys, ["collected_at"])


def corpus_candidates(issues: DataFrame, pulls: DataFrame, issue_comments: DataFrame, pr_comments: DataFrame) -> DataFrame:
    """All records that may become corpus rows. Comments whose parent is absent are left out, and so are ids below 1.

    Both kinds of pull request comments share one join.
    """
    none = F.lit(None).cast("string")

    def own(rows: DataFrame, kind: str) -> DataFrame:
        return rows.select(F.lit(kind).alias("source_type"), F.col("id").alias("source_id"), F.col("id").alias("parent_id"), "title", "body", none.alias("path"), F.col("updated_at").alias("source_updated_at"))

    def of(comments: DataFrame, key: str, parents: DataFrame, kind: Column, path: Column) -> DataFrame:
        c = comments.select(kind.alias("source_type"), F.col("id").alias("source_id"), F.col(key).alias("parent_id"), "body", path.alias("path"), F.col("updated_at").alias("source_updated_at"))
        titles = parents.select(F.col("id").alias("parent_id"), "title")
        return join_unique(c.where("source_type is not null"), titles, ["parent_id"], "inner").select(*CANDIDATE)

    kind = reduce(lambda w, kv: w.when(F.col("comment_type") == kv[0], kv[1]), COMMENT_KINDS.items(), F.when(F.lit(False), ""))
    parts = [own(issues, "issue"), own(pulls, "pull_request"), of(issue_comments, "issue_id", issues, F.lit("issue_comment"), none), of(pr_comments, "pull_request_id", pulls, kind, F.col("path"))]
    return reduce(DataFrame.unionByName, parts).where("source_id > 0")


def corpus_rows(candidates: DataFrame, run_time: Column, clean=clean_text) -> DataFrame:
    """Corpus rows without ids from candidates. A comment's context is its parent's title; the path is in no text.

    Null titles and bodies count as ''. A kind that isn't one of the five is an error.
    """
    title, body = F.coalesce("title", F.lit("")), F.coalesce("body", F.lit(""))
    d = candidates.withColumns({"_t": clean(title), "_b": clean(body), "_rt": title, "_rb": body})
    own = F.col("source_type").isin("issue", "pull_request")
    known = F.when(F.col("source_type").isin(*KINDS), F.col("source_type")).otherwise(F.raise_error(F.concat(F.lit("unknown source type: "), F.coalesce("source_type", F.lit("null")))))
    prefix = F.when(F.col("source_type") == "issue_comment", "Issue title: ").otherwise("Pull request title: ")
    context, raw_context = (F.when(own, "").otherwise(F.concat(prefix, F.col(c))) for c in ("_t", "_rt"))
    target = F.when(own, paragraphs(F.col("_t"), F.col("_b"))).otherwise(F.col("_b"))
    raw = F.when(own, paragraphs(F.col("_rt"), F.col("_rb"))).otherwise(F.col("_rb"))
    d = d.withColumns({"context_text": context, "target_text": target, "raw_text": raw, "_rc": raw_context})
    return d.select(
        known.alias("source_type"), "source_id", "parent_id", "raw_text", "context_text", "target_text",
        model_input(F.col("context_text"), F.col("target_text")).alias("model_input"), F.col("target_text").alias("clean_text"),
        language_tag(F.col("target_text")).alias("language"), content_hash(F.col("_rc"), F.col("raw_text")).alias("content_hash"),
        F.lit(CLEANING_VERSION).alias("cleaning_version"), "source_updated_at", run_time.alias("created_at"), run_time.alias("updated_at"),
    )


def duplicate_pointers(corpus: DataFrame) -> DataFrame:
    """Set ``duplicate_of_id`` to the smallest earlier id with the same hash, else null. A minimum per hash is taken and
    joined back, so a hash that many rows share is no hot spot. A null hash is nobody's duplicate."""
    least = corpus.where("content_hash is not null").groupBy("content_hash").agg(F.min("id").alias("_least"), F.count(F.lit(1)).alias("_n"))
    rows = join_unique(corpus.drop("duplicate_of_id"), least.select("content_hash", "_least"), ["content_hash"], "left", hot_keys(least, ["content_hash"], "_n"))
    return rows.withColumn("duplicate_of_id", F.when(F.col("_least") < F.col("id"), F.col("_least"))).select(*corpus.columns)


def build_corpus(corpus: DataFrame, candidates: DataFrame, run_time: Column) -> tuple[DataFrame, dict[str, int]]:
    """The corpus after a build, and the counts read, written, duplicates and empty.

    A new (kind, record, hash) gets a new id, in the order of kinds and records; a known one only its pointer and times.
    Rows whose cleaned text is empty are counted and left out; ``written`` counts known versions too.
    """
    cuts = Cuts(corpus.sparkSession, "corpus")
    rows = cuts.cut(corpus_rows(candidates, run_time), "rows")
    kept = rows.where("target_text <> ''")
    order = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)]), F.col("source_type"))
    merged = upsert(corpus, kept, KEYS["corpus"], UPDATES["corpus"], ["source_updated_at"])
    merged = with_ids(corpus, merged.withColumn("_k", order), ["_k", "source_id", "content_hash"], cuts).select(*corpus.columns)
    out = cuts.cut(duplicate_pointers(merged), "corpus")
    seen = kept.select(*KEYS["corpus"]).join(out.select(*KEYS["corpus"], "duplicate_of_id"), list(KEYS["corpus"]))
    n = rows.agg(F.count(F.lit(1)).alias("read"), F.count_if(F.col("target_text") == "").alias("empty")).first()
    dup = seen.agg(F.count("duplicate_of_id")).first()[0]
    return out, {"read": n["read"], "written": n["read"] - n["empty"], "duplicates": dup, "empty": n["empty"]}


def current_versions(corpus: DataFrame) -> DataFrame:
    """The version of each record that its source had last: by source_updated_at, not by id."""
    return keep_last(corpus, ("source_type", "source_id"), ["source_updated_at", "id"])
