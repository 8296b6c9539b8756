"""Queries on collection, quarantine, parents, cursors, annotations and runs, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead.functions.text import number_in_url
from loomstead.operators import annotations as A
from loomstead.operators import ingest as I
from loomstead.operators.joins import join_unique
from loomstead.operators.references import normal_category
from loomstead.operators.upsert import keep_last, upsert
from loomstead.sources.tables import table

def now():
    return F.to_timestamp(F.lit("2026-01-01 00:00:00")).cast("timestamp_ntz")

_ITEMS = "unresolved_collection_items"


def _items(spark: SparkSession, d: str) -> DataFrame:
    """The payloads of quarantine as landed items, each once."""
    return table(spark, d, _ITEMS).dropDuplicates(["id"])


def parsed(spark: SparkSession, d: str) -> DataFrame:
    """Landed comment items, parsed by their stream; the problems are those of rows that would be quarantined."""
    rows = _items(spark, d).select(F.col("id").alias("item_id"), "stream", F.col("payload").alias("item"))
    out = [I.parse(rows.where(F.col("stream") == s), s, now()).select("item_id", "stream", "github_id", "author_login", "author_github_id", "github_url", "created_at", "parent_number", "problem") for s in I.STREAMS[1:]]
    return out[0].unionByName(out[1])


def json_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, _ITEMS).select("id", F.get_json_object("payload", "$.user.login").alias("login"), F.get_json_object("payload", "$.user.id").cast("long").alias("user_id")).distinct()


def url_numbers(spark: SparkSession, d: str) -> DataFrame:
    url = F.coalesce(F.get_json_object("payload", "$.issue_url"), F.get_json_object("payload", "$.pull_request_url"))
    return table(spark, d, _ITEMS).select("id", number_in_url(url).alias("parent_number")).distinct()


def pending(spark: SparkSession, d: str) -> DataFrame:
    """Unresolved items with a missing parent, by repository and stream, whatever the spelling of the category."""
    hit = (normal_category() == I.MISSING) & F.col("resolved_at").isNull()
    return _items(spark, d).where(hit).groupBy("repository_id", "stream").agg(F.count(F.lit(1)).alias("n_pending"), F.min("id").alias("oldest_id"), F.max("attempt_count").alias("most_attempts"))


def reasons(spark: SparkSession, d: str) -> DataFrame:
    rows = _items(spark, d).withColumn("category", normal_category())
    return rows.groupBy("repository_id", "category").agg(I.failure_reasons(rows, "still no parent").alias("reasons"))


def classified(spark: SparkSession, d: str) -> DataFrame:
    numbers = table(spark, d, _ITEMS).where("parent_number is not null").select("repository_id", F.col("parent_number").alias("number"))
    return I.classify_parents(numbers, table(spark, d, "issues"), table(spark, d, "pull_requests"))


def missing_parents(spark: SparkSession, d: str) -> DataFrame:
    return I.unknown_parents(classified(spark, d), False).select("repository_id", "number")


def routed(spark: SparkSession, d: str) -> DataFrame:
    """Where each quarantined comment with a number goes when collected."""
    rows = _items(spark, d).where("parent_number is not null")
    c = classified(spark, d)
    out = None
    for stream in I.STREAMS[1:]:
        for name, part in zip(("issue_comments", "pr_comments", "unresolved"), I.route(rows.where(F.col("stream") == stream), c, stream)):
            part = part.select("id", F.lit(name).alias("goes_to"))
            out = part if out is None else out.unionByName(part)
    return out


def resolved(spark: SparkSession, d: str) -> DataFrame:
    """Issue comments with the number of their parent, resolved back to its id."""
    issues = keep_last(table(spark, d, "issues"), ("id",), ["collected_at"])
    numbers = issues.select(F.col("id").alias("issue_id"), F.col("repository_id").alias("repo"), F.col("number").alias("parent_number"))
    comments = keep_last(table(spark, d, "issue_comments"), ("id",), ["collected_at"]).select("id", "issue_id").join(numbers, "issue_id").select("id", F.col("repo").alias("repository_id"), "parent_number")
    return I.resolve_parents(comments, issues, "issue_id").select("id", "repository_id", "issue_id")


def too_long(spark: SparkSession, d: str) -> DataFrame:
    """Values by the length limits of their columns."""
    rows = table(spark, d, "issues").unionByName(table(spark, d, "pull_requests"), allowMissingColumns=True)
    return rows.agg(*[F.count_if(F.length(c) > n).alias(f"long_{c}") for c, n in I.LIMITS.items() if c in rows.columns], F.max(F.length("title")).alias("longest_title"))


def cursors(spark: SparkSession, d: str) -> DataFrame:
    """High-water mark per repository, and the time from which it is read again."""
    top = F.max("updated_at")
    return table(spark, d, "issues").groupBy("repository_id").agg(top.alias("latest"), I.since(top).alias("since"))


def slice_since(spark: SparkSession, d: str) -> DataFrame:
    """Rows that the next collection reads again: within the overlap of their repository's cursor."""
    marks = cursors(spark, d).select("repository_id", I.to_utc(F.col("since")).alias("since"))
    rows = join_unique(table(spark, d, "issues").select("id", "repository_id", "updated_at"), marks, ["repository_id"], "inner")
    return rows.where(F.col("updated_at") >= F.col("since")).select("id", "repository_id", "updated_at").distinct()


def stream_counters(spark: SparkSession, d: str) -> DataFrame:
    """Items and attempts per stream as a collection run counts them."""
    return _items(spark, d).groupBy("stream").agg(F.count(F.lit(1)).alias("n_items"), F.sum(F.col("attempt_count").cast("long")).alias("n_attempts"), F.count_if(F.col("resolved_at").isNull()).alias("n_open"))


def failed_streams(spark: SparkSession, d: str) -> DataFrame:
    """Streams of a repository with open items that were tried three times or more, as failed; others as succeeded."""
    per = _items(spark, d).groupBy("repository_id", "stream").agg(F.count_if(F.col("resolved_at").isNull() & (F.col("attempt_count") >= 3)).alias("n"))
    status = F.when(F.col("n") > 0, "failed").otherwise("succeeded")
    return per.withColumn("status", status).groupBy("repository_id").agg(F.count_if(F.col("status") == "failed").alias("n_failed"), F.count(F.lit(1)).alias("n_streams"))


def ordered_names(spark: SparkSession, d: str) -> DataFrame:
    """Distinct repository names in the order of their first document."""
    return table(spark, d, "documents").groupBy("repo_name").agg(F.min("doc_id").alias("first_doc_id")).orderBy("first_doc_id")


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """Model answers made from the corpus: their shape depends on kind and label."""
    one = lambda a, c: F.concat(F.lit('{"annotations":[{"aspect":"'), a, F.lit('","class":"'), c, F.lit('"}]}'))
    raw = F.when(F.col("source_type") == "issue", one(F.lit("performance"), F.lit("positive"))).when(F.col("source_type") == "pull_request", one(F.lit("speed"), F.lit("positive")))
    raw = raw.when(F.col("source_type") == "issue_comment", F.lit('{"annotations":[]}')).when(F.col("parent_id").isNull(), F.lit("[]")).otherwise(one(F.lit("safety"), F.coalesce("language", F.lit(""))))
    return table(spark, d, "corpus").dropDuplicates(["id"]).withColumn("raw_response", raw)


def annotations(spark: SparkSession, d: str) -> DataFrame:
    r = _answers(spark, d).withColumn("v", A.validate(F.col("raw_response")))
    return r.select(F.col("id").alias("corpus_id"), F.lit(A.TAXONOMY_VERSION).alias("taxonomy_version"), F.lit(A.PROMPT_VERSION).alias("prompt_version"), F.lit("m").alias("model_name"), "raw_response", F.col("v.parsed_result").alias("parsed_result"), F.when(F.col("v.error_message").isNull(), "succeeded").otherwise("failed").alias("status"), F.col("v.error_message").alias("error_message"))


def validated(spark: SparkSession, d: str) -> DataFrame:
    a = annotations(spark, d)
    return a.select("corpus_id", "status", F.size("parsed_result.annotations").alias("n"))


def label_stats(spark: SparkSession, d: str) -> DataFrame:
    return A.label_stats(annotations(spark, d))


def queue(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "corpus").dropDuplicates(["id"])
    return A.queue(corpus, annotations(spark, d), "m").select("id")


def annotation_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Failures overwritten by a later success; a success stays when a batch doesn't hold it."""
    base = annotations(spark, d).select("corpus_id", "model_name", "status", "error_message")
    batch = base.where("status = 'failed'").withColumns({"status": F.lit("succeeded"), "error_message": F.lit(None).cast("string")})
    return upsert(base, batch, ("corpus_id", "model_name"), ("status", "error_message")).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count("error_message").alias("n_errors"))


# SQL -------------------------------------------------------------------------------------------------------------------

_ONCE = f"SELECT * FROM {_ITEMS} QUALIFY row_number() OVER (PARTITION BY id ORDER BY last_attempt_at) = 1"
_CAT = r"regexp_replace(lower(trim(category)), '[\s_-]+', '_', 'g')"
_NUM = r"try_cast(nullif(regexp_extract(coalesce(payload->>'$.issue_url', payload->>'$.pull_request_url'), '/(?:issues|pulls)/([0-9]+)$', 1), '') AS INTEGER)"
_CLASS = f"""SELECT n.repository_id, n.number, EXISTS (SELECT 1 FROM issues i WHERE i.repository_id = n.repository_id AND i.number = n.number) AS is_issue,
    EXISTS (SELECT 1 FROM pull_requests p WHERE p.repository_id = n.repository_id AND p.number = n.number) AS is_pr
    FROM (SELECT DISTINCT repository_id, parent_number AS number FROM {_ITEMS} WHERE parent_number IS NOT NULL) n"""
_LAST = "SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY id ORDER BY collected_at DESC) = 1"
_C1 = "SELECT * FROM corpus QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at) = 1"
_OK = "source_type IN ('issue', 'issue_comment') OR (source_type <> 'pull_request' AND parent_id IS NOT NULL AND language IN ('positive', 'neutral', 'negative'))"

QUERIES = {
    "parse_items": parsed,
    "json_payload_fields": json_fields,
    "parent_number_from_url": url_numbers,
    "pending_quarantine": pending,
    "quarantine_reasons": reasons,
    "classify_parents": classified,
    "missing_parents": missing_parents,
    "route_comments": routed,
    "parent_resolution": resolved,
    "length_validation": too_long,
    "cursor_high_water": cursors,
    "incremental_slice": slice_since,
    "stream_counters": stream_counters,
    "failed_streams": failed_streams,
    "ordered_distinct_names": ordered_names,
    "validate_annotations": validated,
    "label_stats": label_stats,
    "unannotated_queue": queue,
    "annotation_upsert": annotation_upsert,
}
SQL = {
    "parse_items": f"""SELECT id AS item_id, stream, (payload->>'$.id')::BIGINT AS github_id, payload->>'$.user.login' AS author_login, (payload->>'$.user.id')::BIGINT AS author_github_id,
        coalesce(nullif(payload->>'$.html_url', ''), nullif(payload->>'$.url', ''), '') AS github_url, try_cast(replace(payload->>'$.created_at', 'Z', '') AS TIMESTAMP) AS created_at, {_NUM} AS parent_number,
        CASE WHEN (payload->>'$.created_at') IS NULL THEN 'missing field created_at' WHEN (payload->>'$.updated_at') IS NULL THEN 'missing field updated_at'
          WHEN (payload->>'$.issue_url') IS NULL AND stream = 'issue_comments' THEN 'missing field issue_url' WHEN (payload->>'$.pull_request_url') IS NULL AND stream = 'review_comments' THEN 'missing field pull_request_url'
          WHEN {_NUM} IS NULL THEN 'no parent number' END AS problem
        FROM ({_ONCE}) WHERE stream IN ('issue_comments', 'review_comments')""",
    "json_payload_fields": f"SELECT DISTINCT id, payload->>'$.user.login' AS login, (payload->>'$.user.id')::BIGINT AS user_id FROM {_ITEMS}",
    "parent_number_from_url": f"SELECT DISTINCT id, {_NUM} AS parent_number FROM {_ITEMS}",
    "pending_quarantine": f"SELECT repository_id, stream, count(*) AS n_pending, min(id) AS oldest_id, max(attempt_count) AS most_attempts FROM ({_ONCE}) WHERE {_CAT} = 'missing_parent' AND resolved_at IS NULL GROUP BY ALL",
    "quarantine_reasons": f"SELECT repository_id, {_CAT} AS category, coalesce(string_agg(DISTINCT reason, '; ' ORDER BY reason), 'still no parent') AS reasons FROM ({_ONCE}) GROUP BY ALL",
    "classify_parents": _CLASS,
    "missing_parents": f"SELECT repository_id, number FROM ({_CLASS}) WHERE NOT is_issue AND NOT is_pr",
    "route_comments": f"""WITH r AS (SELECT u.id, u.stream, is_issue, is_pr FROM ({_ONCE}) u JOIN ({_CLASS}) c ON u.repository_id = c.repository_id AND u.parent_number = c.number WHERE stream IN ('issue_comments', 'review_comments'))
        SELECT id, 'issue_comments' AS goes_to FROM r WHERE stream = 'issue_comments' AND is_issue UNION ALL SELECT id, 'pr_comments' FROM r WHERE is_pr
        UNION ALL SELECT id, 'unresolved' FROM r WHERE NOT is_pr AND (stream = 'review_comments' OR NOT is_issue)""",
    "parent_resolution": f"SELECT c.id, i.repository_id, i.id AS issue_id FROM ({_LAST.format(t='issue_comments')}) c JOIN ({_LAST.format(t='issues')}) i ON c.issue_id = i.id",
    "length_validation": "SELECT count(*) FILTER (length(author_login) > 255) AS long_author_login, count(*) FILTER (length(github_url) > 1024) AS long_github_url, count(*) FILTER (length(title) > 1024) AS long_title, count(*) FILTER (length(state) > 20) AS long_state, max(length(title)) AS longest_title FROM (SELECT author_login, github_url, title, state FROM issues UNION ALL SELECT author_login, github_url, title, state FROM pull_requests)",
    "cursor_high_water": "SELECT repository_id, max(updated_at) AS latest, strftime(max(updated_at) - INTERVAL 300 SECOND, '%Y-%m-%dT%H:%M:%SZ') AS since FROM issues GROUP BY ALL",
    "incremental_slice": "SELECT DISTINCT id, repository_id, updated_at FROM issues i WHERE updated_at >= (SELECT max(updated_at) FROM issues j WHERE j.repository_id = i.repository_id) - INTERVAL 300 SECOND",
    "stream_counters": f"SELECT stream, count(*) AS n_items, sum(attempt_count)::BIGINT AS n_attempts, count(*) FILTER (resolved_at IS NULL) AS n_open FROM ({_ONCE}) GROUP BY ALL",
    "failed_streams": f"SELECT repository_id, count(*) FILTER (n > 0) AS n_failed, count(*) AS n_streams FROM (SELECT repository_id, stream, count(*) FILTER (resolved_at IS NULL AND attempt_count >= 3) n FROM ({_ONCE}) GROUP BY ALL) GROUP BY ALL",
    "ordered_distinct_names": "SELECT repo_name, min(doc_id) AS first_doc_id FROM documents GROUP BY ALL",
    "validate_annotations": f"SELECT id AS corpus_id, CASE WHEN {_OK} THEN 'succeeded' ELSE 'failed' END AS status, CASE WHEN NOT ({_OK}) THEN NULL WHEN source_type = 'issue_comment' THEN 0 ELSE 1 END AS n FROM (SELECT * REPLACE (coalesce(language, '') AS language) FROM ({_C1}))",
    "label_stats": f"SELECT count(*) AS read, count(*) FILTER ({_OK}) AS succeeded, count(*) FILTER (NOT ({_OK})) AS failed FROM (SELECT * REPLACE (coalesce(language, '') AS language) FROM ({_C1}))",
    "unannotated_queue": f"SELECT id FROM (SELECT * REPLACE (coalesce(language, '') AS language) FROM ({_C1})) WHERE duplicate_of_id IS NULL AND NOT ({_OK})",
    "annotation_upsert": "SELECT 'succeeded' AS status, count(DISTINCT id) AS n, 0 AS n_errors FROM corpus",
}
