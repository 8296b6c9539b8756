"""From landed API items to table rows: parsing, validation, quarantine, parents, routing and cursors."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstead.functions.text import number_in_url

STREAMS = ("issues_and_pull_requests", "issue_comments", "review_comments")
INVALID, MISSING = "invalid_record", "missing_parent"
# fixed values: the longest values that the columns take
LIMITS = {"author_login": 255, "github_url": 1024, "title": 1024, "state": 20, "comment_type": 30, "path": 1024}
#: Shape of the items; fields that aren't listed are dropped by parsing but stay in quarantined payloads.
ITEM = (
    "id long, number int, title string, body string, state string, user struct<login:string,id:long>, html_url string, url string, created_at string, updated_at string,"
    " closed_at string, merged_at string, pull_request struct<url:string,merged_at:string>, issue_url string, pull_request_url string, path string, in_reply_to_id long"
)


@F.pandas_udf(T.StringType())
def canonical_json(values: pd.Series) -> pd.Series:
    """JSON with sorted keys, non-ASCII kept; what is no JSON object is wrapped as {"raw": value}. Null is wrapped too."""

    def one(v):
        try:
            item = json.loads(v)
        except (TypeError, ValueError):
            item = v
        return json.dumps(item if isinstance(item, dict) else {"raw": item}, ensure_ascii=False, sort_keys=True, default=str)

    return values.map(one)


def item_key(item: str) -> str:
    """Key of one canonical item without an id."""
    return hashlib.sha256(item.encode()).hexdigest()


def to_utc(column: Column) -> Column:
    """ISO-8601 text as UTC without zone; without an offset it is UTC. Empty or unreadable text is null."""
    return F.try_to_timestamp(F.nullif(column, F.lit(""))).cast("timestamp_ntz")


def has_key(item: Column, key: str) -> Column:
    """Whether a JSON object has a key, be its value null."""
    return F.coalesce(F.array_contains(F.json_object_keys(item), key), F.lit(False))


def parse(items: DataFrame, stream: str, collected_at: Column) -> DataFrame:
    """Items (item: JSON text) with the columns of their stream, ``is_pr`` where items are of two roles, and ``problem``.

    ``problem`` is null for a row that can be stored. Otherwise it says what is wrong: no object, a field that must be
    there is missing, a time that can't be read, no parent number, or a value that is too long. Nothing is thrown.
    """
    i = F.from_json("item", ITEM)
    d = items.withColumn("i", i)
    f = lambda name: F.col(f"i.{name}")
    empty = lambda c: F.nullif(c, F.lit(""))
    d = d.withColumns({
        "github_id": f("id"), "author_login": f("user.login"), "author_github_id": f("user.id"), "body": f("body"),
        "github_url": F.coalesce(empty(f("html_url")), empty(f("url")), F.lit("")),
        "created_at": to_utc(f("created_at")), "updated_at": to_utc(f("updated_at")), "collected_at": collected_at,
    })
    needed = ["id", "created_at", "updated_at"]
    if stream == STREAMS[0]:
        needed += ["number", "state"]
        d = d.withColumns({
            "is_pr": has_key(F.col("item"), "pull_request"), "number": f("number"), "title": F.coalesce(f("title"), F.lit("")), "state": f("state"),
            "closed_at": to_utc(f("closed_at")), "merged_at": to_utc(F.coalesce(empty(f("merged_at")), f("pull_request.merged_at"))),
        })
    else:
        review = stream == STREAMS[2]
        url = "pull_request_url" if review else "issue_url"
        needed.append(url)
        d = d.withColumn("parent_number", number_in_url(f(url)))
        kind = F.lit("review_comment" if review else "issue_comment")
        d = d.withColumns({"comment_type": kind, "path": f("path") if review else F.lit(None).cast("string"), "in_reply_to_github_id": f("in_reply_to_id") if review else F.lit(None).cast("long")})
    problem = F.when(F.json_object_keys("item").isNull(), "not an object")
    for name in needed:
        problem = problem.when(f(name).isNull(), f"missing field {name}")
    for name in ("created_at", "updated_at"):
        problem = problem.when(F.col(name).isNull(), f"bad timestamp {name}")
    for name in ("closed_at", "merged_at"):
        if name in d.columns:
            problem = problem.when(empty(f(name)).isNotNull() & F.col(name).isNull(), f"bad timestamp {name}")
    if "parent_number" in d.columns:
        problem = problem.when(F.col("parent_number").isNull(), "no parent number")
    for name, most in LIMITS.items():
        if name in d.columns:
            problem = problem.when(F.length(name) > most, f"{name} is longer than {most}")
    return d.withColumn("problem", problem).drop("i")


def quarantine(rows: DataFrame, stream: str, category: str, reason: Column, now: Column, repository_id: Column | None = None) -> DataFrame:
    """Rows for the quarantine table from ``rows`` with ``item`` (and parent_number, repository_id where they have them)."""
    d = rows.withColumn("payload", canonical_json("item"))
    gid = F.get_json_object("payload", "$.id").try_cast("long")
    parent = F.col("parent_number").cast("int") if "parent_number" in rows.columns and category == MISSING else F.lit(None).cast("int")
    repo = repository_id if repository_id is not None else F.col("repository_id")
    return d.select(
        repo.cast("long").alias("repository_id"), F.lit(stream).alias("stream"), F.coalesce(gid.cast("string"), F.sha2("payload", 256)).alias("item_key"),
        F.lit(category).alias("category"), gid.alias("github_id"), parent.alias("parent_number"), "payload", reason.alias("reason"),
        F.lit(1).alias("attempt_count"), now.alias("first_seen_at"), now.alias("last_attempt_at"), F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
    )


def high_water(items: DataFrame, floor: Column | None = None) -> DataFrame:
    """(latest): the highest readable updated_at over all items, invalid ones too, not below ``floor``; null if there is none."""
    top = F.max(to_utc(F.get_json_object("item", "$.updated_at")))
    return items.agg((F.greatest(top, floor) if floor is not None else top).alias("latest"))


def since(cursor: Column, overlap_seconds: int = 300) -> Column:
    """Text of the time from which items are read again: the cursor less the overlap; null (everything) without a cursor."""
    return F.date_format(cursor - F.make_dt_interval(secs=F.lit(overlap_seconds)), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def classify_parents(numbers: DataFrame, issues: DataFrame, pulls: DataFrame) -> DataFrame:
    """Distinct (repository_id, number) with ``is_issue`` and ``is_pr``."""
    keys = ["repository_id", "number"]
    i = issues.select(*keys).distinct().withColumn("is_issue", F.lit(True))
    p = pulls.select(*keys).distinct().withColumn("is_pr", F.lit(True))
    d = numbers.select(*keys).distinct().join(i, keys, "left").join(p, keys, "left")
    return d.select(*keys, F.coalesce("is_issue", F.lit(False)).alias("is_issue"), F.coalesce("is_pr", F.lit(False)).alias("is_pr"))


def unknown_parents(classified: DataFrame, pr_only: bool) -> DataFrame:
    return classified.where(~F.col("is_pr") if pr_only else ~F.col("is_pr") & ~F.col("is_issue"))


def route(comments: DataFrame, classified: DataFrame, stream: str, reconcile: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(to issues, to pull requests, unresolved). A number of both kinds goes to both tables when collected, and to the
    issues alone when reconciled. Review comments go to pull requests only."""
    d = comments.join(classified.withColumnRenamed("number", "parent_number"), ["repository_id", "parent_number"], "left")
    i, p = F.coalesce("is_issue", F.lit(False)), F.coalesce("is_pr", F.lit(False))
    if stream == STREAMS[2]:
        return d.where(F.lit(False)), d.where(p), d.where(~p)
    return d.where(i), d.where(p & ~i if reconcile else p), d.where(~i & ~p)


class MissingParents(RuntimeError):
    pass


def resolve_parents(comments: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Replace ``parent_number`` by the parent's id in column ``key``. All must be there: else MissingParents, with up to ten."""
    ids = parents.select("repository_id", F.col("number").alias("parent_number"), F.col("id").alias(key))
    d = comments.join(ids, ["repository_id", "parent_number"], "left")
    lost = [r[0] for r in d.where(F.col(key).isNull()).select("parent_number").distinct().orderBy("parent_number").limit(10).collect()]
    if lost:
        raise MissingParents(f"parents of comments are not collected yet: {lost}")
    return d.drop("parent_number")


def pending(items: DataFrame, repository_id: int, stream: str, limit: int = 1000) -> DataFrame:
    """The oldest unresolved items with a missing parent; the rest waits for a later run."""
    hit = (F.col("repository_id") == repository_id) & (F.col("stream") == stream) & (F.col("category") == MISSING) & F.col("resolved_at").isNull()
    return items.where(hit).orderBy("id").limit(limit)


def failure_reasons(failed: DataFrame, default: str) -> Column:
    """Aggregate: the distinct reasons in order, joined by '; ', or ``default`` without any."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.collect_set("reason")), "; "), F.lit("")), F.lit(default))
