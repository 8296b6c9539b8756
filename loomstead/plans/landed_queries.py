"""Queries that land table rows as API items, parse and merge them, and label them; and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead import control
from loomstead.operators import annotations as A
from loomstead.operators import ingest as I
from loomstead.operators.corpus import latest
from loomstead.operators.references import normal_category
from loomstead.operators.upsert import update_where, upsert, with_ids
from loomstead.plans.collection_queries import annotations, now
from loomstead.schemas import KEYS, UPDATES
from loomstead.sources.shared import Cuts
from loomstead.sources.tables import table

_ITEMS = "unresolved_collection_items"
API = "https://api.example/repos/o/r/"


# parsing ---------------------------------------------------------------------------------------------------------------


def _iso(c: str) -> Column:
    """A time as the API writes it: in UTC for even ids, else with an offset."""
    form = "yyyy-MM-dd'T'HH:mm:ss"
    return F.when(F.col("github_id") % 2 == 0, F.concat(F.date_format(c, form), F.lit("Z"))).otherwise(F.concat(F.date_format(F.col(c) + F.expr("interval 150 minutes"), form), F.lit("+02:30")))


def _item(rows: DataFrame, *more: Column, explicit: Column | None = None) -> DataFrame:
    """(item): rows as JSON objects without null fields; ``explicit`` goes in front as it is."""
    user = F.when(F.col("author_login").isNotNull() | F.col("author_github_id").isNotNull(), F.struct(F.col("author_login").alias("login"), F.col("author_github_id").alias("id")))
    url = [F.when(F.col("github_id") % 3 == 0, "").otherwise(F.col("github_url")).alias("html_url"), F.when(F.col("github_id") % 3 == 0, F.col("github_url")).alias("url")]
    text = F.to_json(F.struct(F.col("github_id").alias("id"), user.alias("user"), "body", *url, _iso("created_at").alias("created_at"), _iso("updated_at").alias("updated_at"), *more))
    return rows.select((text if explicit is None else F.concat(explicit, F.substr(text, F.lit(2)))).alias("item"))


def landed_issues(spark: SparkSession, d: str) -> DataFrame:
    """Issues and pull requests as one stream of items. Of the latter some tell the role by a key whose value is null."""
    own = ["number", F.nullif("title", F.lit("")).alias("title"), "state", _iso("closed_at").alias("closed_at")]
    merged = F.when(F.col("number") % 2 == 0, _iso("merged_at")).alias("merged_at")
    nested = F.when((F.col("number") % 2 == 1) & F.col("merged_at").isNotNull(), F.struct(_iso("merged_at").alias("merged_at"))).alias("pull_request")
    pulls = latest(table(spark, d, "pull_requests"))
    null = F.when((F.col("number") % 2 == 0) | F.col("merged_at").isNull(), '{"pull_request":null,').otherwise("{")
    return _item(latest(table(spark, d, "issues")), *own).unionByName(_item(pulls, *own, merged, nested, explicit=null))


def parse_issue_stream(spark: SparkSession, d: str) -> DataFrame:
    rows = I.parse(landed_issues(spark, d), I.STREAMS[0], now())
    return rows.select("github_id", "is_pr", "number", "title", "state", "closed_at", "merged_at", "author_login", "author_github_id", "body", "github_url", "created_at", "updated_at", "problem")


def parse_issue_comments(spark: SparkSession, d: str) -> DataFrame:
    items = _item(latest(table(spark, d, "issue_comments")), F.concat(F.lit(API + "issues/"), "issue_id").alias("issue_url"))
    rows = I.parse(items, I.STREAMS[1], now())
    return rows.select("github_id", "parent_number", "comment_type", "path", "in_reply_to_github_id", "author_login", "author_github_id", "body", "github_url", "created_at", "updated_at", "collected_at", "problem")


def parse_review_comments(spark: SparkSession, d: str) -> DataFrame:
    items = _item(latest(table(spark, d, "pr_comments")), F.concat(F.lit(API + "pulls/"), "pull_request_id").alias("pull_request_url"), F.col("path"), F.col("in_reply_to_github_id").alias("in_reply_to_id"))
    rows = I.parse(items, I.STREAMS[2], now())
    return rows.select("github_id", "parent_number", "comment_type", "path", "in_reply_to_github_id", "author_login", "author_github_id", "body", "github_url", "created_at", "updated_at", "problem")


def high_water_marks(spark: SparkSession, d: str) -> DataFrame:
    """The cursor after each stream's items, with and without a floor above most of them."""
    rows = table(spark, d, _ITEMS).select("stream", F.col("payload").alias("item")).unionByName(landed_issues(spark, d).select(F.lit(I.STREAMS[0]).alias("stream"), "item"))
    floor, out = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz"), None
    for stream in I.STREAMS:
        for name, low in (("none", None), ("low", floor)):
            part = I.high_water(rows.where(F.col("stream") == stream), low).select(F.lit(stream).alias("stream"), F.lit(name).alias("floor"), "latest", I.since(F.col("latest")).alias("since"))
            out = part if out is None else out.unionByName(part)
    return out


def quarantine_rows(spark: SparkSession, d: str) -> DataFrame:
    """The payloads put into quarantine again, by category."""
    rows = table(spark, d, _ITEMS).select("repository_id", "parent_number", F.col("payload").alias("item")).distinct()
    parts = [I.quarantine(rows, I.STREAMS[1], c, F.concat(F.lit("no: "), F.lit(c)), now()) for c in (I.INVALID, I.MISSING)]
    return parts[0].unionByName(parts[1]).select("repository_id", "stream", "item_key", "category", "github_id", "parent_number", "reason", "attempt_count", "first_seen_at", "last_attempt_at", "resolved_at").distinct()


def canonical_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Payloads with sorted keys; a text that is no object is wrapped."""
    items = table(spark, d, _ITEMS).select("id", "payload").distinct()
    odd = items.select((-F.col("id")).alias("id"), F.concat(F.lit("no object "), "id").alias("payload"))
    return items.unionByName(odd).select("id", I.canonical_json("payload").alias("payload"))


def pending_items(spark: SparkSession, d: str) -> DataFrame:
    """The 1000 oldest open items of a repository's stream that wait for a parent."""
    once = table(spark, d, _ITEMS).dropDuplicates(["id"]).withColumn("category", normal_category())
    return I.pending(once, 3, I.STREAMS[1]).select("id", "repository_id", "stream", "category", "parent_number", "attempt_count")


def route_reconciled(spark: SparkSession, d: str) -> DataFrame:
    """Where quarantined comments go when they are tried again: to an issue before a pull request."""
    rows = table(spark, d, _ITEMS).dropDuplicates(["id"]).where("parent_number is not null")
    known = I.classify_parents(rows.select("repository_id", F.col("parent_number").alias("number")), table(spark, d, "issues"), table(spark, d, "pull_requests"))
    out = None
    for stream in I.STREAMS[1:]:
        for name, part in zip(("issue_comments", "pr_comments", "unresolved"), I.route(rows.where(F.col("stream") == stream), known, stream, reconcile=True)):
            part = part.select("id", F.lit(name).alias("goes_to"))
            out = part if out is None else out.unionByName(part)
    return out


# merges: base rows, changed ones (edited) and new ones (added), as expressions that both dialects read ------------------

_TEXTS = ["body", "author_login", "author_github_id", "github_url", "created_at", "updated_at", "collected_at"]
MERGES = {
    "issues": (["id", "github_id", "repository_id", "number", "title", "state", "closed_at", *_TEXTS], {"repository_id": "repository_id + 1000", "title": "concat(title, ' *')", "body": "CAST(NULL AS STRING)", "state": "'open'"}, "state = 'closed'", {"github_id": "-github_id"}, "state = 'open'"),
    "pull_requests": (["id", "github_id", "repository_id", "number", "title", "state", "closed_at", "merged_at", *_TEXTS], {"github_id": "github_id + 1", "merged_at": "CAST(NULL AS TIMESTAMP)", "author_login": "'x'"}, "state = 'closed'", {"number": "number + 1000000"}, "state = 'open'"),
    "issue_comments": (["id", "github_id", "repository_id", "issue_id", *_TEXTS], {"issue_id": "issue_id + 1", "body": "CAST(NULL AS STRING)", "repository_id": "repository_id + 1000"}, "author_login IS NULL", {"github_id": "-github_id"}, "author_login IS NOT NULL"),
    "pr_comments": (["id", "github_id", "repository_id", "pull_request_id", "comment_type", "path", "in_reply_to_github_id", *_TEXTS], {"path": "CAST(NULL AS STRING)", "in_reply_to_github_id": "github_id", "repository_id": "repository_id + 1000"}, "comment_type = 'review_comment'", {"comment_type": "'review_comment'"}, "comment_type = 'issue_comment'"),
    _ITEMS: (["id", "repository_id", "stream", "item_key", "category", "github_id", "parent_number", "payload", "reason", "attempt_count", "first_seen_at", "last_attempt_at", "resolved_at"], {"resolved_at": "CAST(NULL AS TIMESTAMP)", "attempt_count": "attempt_count + 50", "first_seen_at": "last_attempt_at", "reason": "'again'"}, "resolved_at IS NOT NULL", {"item_key": "concat(item_key, '-new')"}, "resolved_at IS NULL"),
}
# columns that a row keeps when it is merged again, told apart from the schema's own list of updates
KEPT = {"issues": ["repository_id"], "pull_requests": ["github_id"], "issue_comments": ["repository_id"], "pr_comments": ["repository_id"], _ITEMS: ["attempt_count", "first_seen_at"]}


def _exprs(columns: list[str], change: dict[str, str]) -> list[str]:
    return [f"{change.get(c, c)} AS {c}" for c in columns if c != "id"]


def _base(spark: SparkSession, d: str, t: str) -> DataFrame:
    rows = table(spark, d, t)
    return (rows.dropDuplicates(["id"]) if t == _ITEMS else latest(rows)).select(*MERGES[t][0])


def merge(t: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        columns, edit, edited, add, added = MERGES[t]
        base = _base(spark, d, t)
        batch = base.where(edited).selectExpr(*_exprs(columns, edit)).unionByName(base.where(added).selectExpr(*_exprs(columns, add)))
        batch = batch.select(*[F.col(c).cast(base.schema[c].dataType) for c in batch.columns])
        out = upsert(base, batch, KEYS[t], UPDATES[t], list(batch.columns))
        return with_ids(base, out, [*KEYS[t]], Cuts(spark, f"query-{t}"))

    query.__doc__ = f"{t} after a batch of changed and new rows, by the keys and updates of the schema."
    return query


def merge_cursors(spark: SparkSession, d: str) -> DataFrame:
    """Cursors set by a later batch, whatever their times were."""
    def marks(t: str, *streams: str) -> DataFrame:
        top = table(spark, d, t).groupBy("repository_id").agg(F.min("updated_at").alias("last_updated_at"), F.max("collected_at").alias("updated_at"))
        return top.select(F.col("repository_id").alias("id"), "repository_id", F.explode(F.array(*map(F.lit, streams))).alias("stream"), "last_updated_at", "updated_at")

    base = marks("issues", "issue_comments")
    out = upsert(base, marks("pull_requests", "issue_comments", "review_comments").drop("id"), KEYS["repository_cursors"], UPDATES["repository_cursors"])
    return with_ids(base, out, [*KEYS["repository_cursors"]], Cuts(spark, "query-cursors"))


def merge_stream_runs(spark: SparkSession, d: str) -> DataFrame:
    """Stream logs, made of the quarantine's counts, written again at the end: the start stays."""
    g = table(spark, d, _ITEMS).dropDuplicates(["id"]).groupBy("repository_id", "stream")
    run = lambda status, end: g.agg(F.lit("r").alias("pipeline_run_id"), F.lit(status).alias("status"), F.count(F.lit(1)).cast("int").alias("items_read"), F.min("first_seen_at").alias("started_at"), end.alias("completed_at"))
    base = run("running", F.lit(None).cast("timestamp_ntz"))
    batch = run("succeeded", F.max("last_attempt_at")).withColumn("started_at", F.col("completed_at"))
    return upsert(base, batch, KEYS["collection_stream_runs"], UPDATES["collection_stream_runs"])


def merge_annotations(spark: SparkSession, d: str) -> DataFrame:
    """Annotations after a second label run over what is left: failures give way to the new answers."""
    base = annotations(spark, d).select("corpus_id", "taxonomy_version", "prompt_version", "model_name", "raw_response", "status", "error_message").withColumn("error_message", F.when(F.col("error_message").isNotNull(), "failed before"))
    again = A.label(_left(spark, d), A.NoOpinion(), now()).select(*base.columns).withColumn("model_name", F.lit("m"))
    return upsert(base, again, KEYS["llm_annotations"], UPDATES["llm_annotations"])


def tried_again(spark: SparkSession, d: str) -> DataFrame:
    """Open items after a vain attempt: one attempt more, a new reason and time."""
    once = table(spark, d, _ITEMS).dropDuplicates(["id"])
    out = update_where(once, F.col("resolved_at").isNull() & (normal_category() == I.MISSING), attempt_count=F.col("attempt_count") + 1, reason=F.lit("still missing"), last_attempt_at=now())
    return out.select("id", "attempt_count", "reason", "first_seen_at", "last_attempt_at")


# labels ----------------------------------------------------------------------------------------------------------------


def _left(spark: SparkSession, d: str) -> DataFrame:
    return A.queue(table(spark, d, "corpus").dropDuplicates(["id"]), annotations(spark, d), "m")


class Questions:
    """A completer that fails on questions and answers badly on code, so that runs end in all ways."""

    model = "q"

    def complete(self, model_input: str) -> str:
        if "?" in model_input:
            raise RuntimeError("it asks something")
        return "[]" if "`" in model_input else '{"annotations": [{"aspect": "safety", "class": "neutral"}, {"aspect": "debugging", "class": "negative"}]}'


class Lengths:
    model_version = "v1"

    def predict(self, model_inputs: list[str]) -> list[dict]:
        return [{"n": len(x)} for x in model_inputs]


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return A.label(_left(spark, d), Questions(), now())


def label_run(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d).select("corpus_id", "taxonomy_version", "prompt_version", "model_name", "raw_response", "status", "error_message", "created_at")


def annotated_aspects(spark: SparkSession, d: str) -> DataFrame:
    return A.exploded(_labelled(spark, d))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    return A.predict(table(spark, d, "corpus").dropDuplicates(["id"]), Lengths(), now())


# runs and repositories ---------------------------------------------------------------------------------------------------


def repository_listing(spark: SparkSession, d: str) -> DataFrame:
    return control.listing(table(spark, d, "repositories"))


def enabled_repositories(spark: SparkSession, d: str) -> DataFrame:
    return control.listing(table(spark, d, "repositories"), enabled_only=True)


def recent_runs(spark: SparkSession, d: str) -> DataFrame:
    """The events as logged runs: the ten that began last."""
    runs = table(spark, d, "events").select(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("run_type"), F.lit("succeeded").alias("status"), F.col("ts").alias("started_at"), F.lit(None).cast("timestamp_ntz").alias("completed_at"), F.col("props").alias("stats"), F.lit(None).cast("string").alias("error_message"))
    return control.recent(runs, 10).select("id", "run_type", "status", "started_at")


# SQL -------------------------------------------------------------------------------------------------------------------

_LAST = "SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY id ORDER BY collected_at DESC) = 1"
_ONCE = f"SELECT DISTINCT * FROM {_ITEMS}"
_RAW = "author_login, author_github_id, body, github_url, created_at, updated_at, NULL AS problem"
_CAT = r"regexp_replace(lower(trim(category)), '[\s_-]+', '_', 'g')"
_C1 = "SELECT * REPLACE (coalesce(language, '') AS language) FROM corpus QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at) = 1"
_OK = "(source_type IN ('issue', 'issue_comment') OR (source_type <> 'pull_request' AND parent_id IS NOT NULL AND language IN ('positive', 'neutral', 'negative')))"
_LEFT = f"SELECT id AS corpus_id, model_input FROM ({_C1}) WHERE duplicate_of_id IS NULL AND NOT {_OK}"
_NOW = "TIMESTAMP '2026-01-01 00:00:00'"
_ANSWER = '{"annotations": [{"aspect": "safety", "class": "neutral"}, {"aspect": "debugging", "class": "negative"}]}'
_TRACE = f"'{A.TAXONOMY_VERSION}' AS taxonomy_version, '{A.PROMPT_VERSION}' AS prompt_version"
_STATUS = f"""SELECT corpus_id, model_input, CASE WHEN contains(model_input, '?') THEN 'it asks something' WHEN contains(model_input, '`') THEN 'the root must be an object with annotations and nothing else' END AS error_message,
    CASE WHEN contains(model_input, '?') THEN NULL WHEN contains(model_input, '`') THEN '[]' ELSE '{_ANSWER}' END AS raw_response FROM ({_LEFT})"""
_KNOWN = f"""SELECT u.id, u.stream, EXISTS (SELECT 1 FROM issues i WHERE i.repository_id = u.repository_id AND i.number = u.parent_number) AS is_issue,
    EXISTS (SELECT 1 FROM pull_requests p WHERE p.repository_id = u.repository_id AND p.number = u.parent_number) AS is_pr
    FROM ({_ONCE}) u WHERE parent_number IS NOT NULL AND stream IN ('issue_comments', 'review_comments')"""
_TIMES = f"SELECT stream, try_cast(replace(payload->>'$.updated_at', 'Z', '') AS TIMESTAMP) AS t FROM {_ITEMS} UNION ALL SELECT 'issues_and_pull_requests', updated_at FROM issues UNION ALL SELECT 'issues_and_pull_requests', updated_at FROM pull_requests"


def _merge_sql(t: str) -> str:
    columns, edit, edited, add, added = MERGES[t]
    base = _ONCE if t == _ITEMS else _LAST.format(t=t)
    keys, kept = KEYS[t], KEPT[t]
    value = {"id": f"CASE WHEN b.hit THEN b.id ELSE (SELECT max(id) FROM b) + row_number() OVER (PARTITION BY b.hit ORDER BY {', '.join(f'n.{k}' for k in keys)}) END"}
    for c in columns:
        value.setdefault(c, f"coalesce(b.{c}, n.{c})" if c in keys else f"CASE WHEN b.hit THEN b.{c} ELSE n.{c} END" if c in kept else f"CASE WHEN n.hit THEN n.{c} ELSE b.{c} END")
    return f"""WITH b AS (SELECT {', '.join(columns)}, true AS hit FROM ({base})),
        n AS (SELECT {', '.join(_exprs(columns, edit))}, true AS hit FROM b WHERE {edited} UNION ALL SELECT {', '.join(_exprs(columns, add))}, true FROM b WHERE {added})
        SELECT {', '.join(f'{value[c]} AS {c}' for c in columns)} FROM b FULL JOIN n ON {' AND '.join(f'b.{k} = n.{k}' for k in keys)}"""


QUERIES = {
    "parse_issue_stream": parse_issue_stream,
    "parse_issue_comments": parse_issue_comments,
    "parse_review_comments": parse_review_comments,
    "high_water_marks": high_water_marks,
    "quarantine_rows": quarantine_rows,
    "canonical_payloads": canonical_payloads,
    "pending_items": pending_items,
    "route_reconciled": route_reconciled,
    **{f"merge_{t}": merge(t) for t in MERGES},
    "merge_repository_cursors": merge_cursors,
    "merge_stream_runs": merge_stream_runs,
    "merge_annotations": merge_annotations,
    "tried_again": tried_again,
    "label_run": label_run,
    "annotated_aspects": annotated_aspects,
    "predictions": predictions,
    "repository_listing": repository_listing,
    "enabled_repositories": enabled_repositories,
    "recent_runs_topk": recent_runs,
}
SQL = {
    "parse_issue_stream": f"SELECT github_id, false AS is_pr, number, title, state, closed_at, NULL::TIMESTAMP AS merged_at, {_RAW} FROM ({_LAST.format(t='issues')}) UNION ALL SELECT github_id, true, number, title, state, closed_at, merged_at, {_RAW} FROM ({_LAST.format(t='pull_requests')})",
    "parse_issue_comments": f"SELECT github_id, issue_id::INTEGER AS parent_number, 'issue_comment' AS comment_type, NULL::VARCHAR AS path, NULL::BIGINT AS in_reply_to_github_id, {_NOW} AS collected_at, {_RAW} FROM ({_LAST.format(t='issue_comments')})",
    "parse_review_comments": f"SELECT github_id, pull_request_id::INTEGER AS parent_number, 'review_comment' AS comment_type, path, in_reply_to_github_id, {_RAW} FROM ({_LAST.format(t='pr_comments')})",
    "high_water_marks": f"""WITH m AS (SELECT s.stream, max(t) AS top FROM (VALUES ('issues_and_pull_requests'), ('issue_comments'), ('review_comments')) s(stream) LEFT JOIN ({_TIMES}) x ON x.stream = s.stream GROUP BY ALL)
        SELECT *, strftime(latest - INTERVAL 300 SECOND, '%Y-%m-%dT%H:%M:%SZ') AS since FROM (SELECT stream, 'none' AS floor, top AS latest FROM m UNION ALL SELECT stream, 'low', greatest(top, TIMESTAMP '2024-06-01 00:00:00') FROM m)""",
    "quarantine_rows": f"""SELECT DISTINCT repository_id, 'issue_comments' AS stream, payload->>'$.id' AS item_key, c AS category, (payload->>'$.id')::BIGINT AS github_id, CASE c WHEN 'missing_parent' THEN parent_number END AS parent_number,
        'no: ' || c AS reason, 1 AS attempt_count, {_NOW} AS first_seen_at, {_NOW} AS last_attempt_at, NULL::TIMESTAMP AS resolved_at FROM {_ITEMS}, (VALUES ('invalid_record'), ('missing_parent')) v(c)""",
    # the payloads of the tables are written with sorted keys already
    "canonical_payloads": f"""SELECT DISTINCT id, payload FROM {_ITEMS} UNION ALL SELECT DISTINCT -id, '{{"raw": "no object ' || id || '"}}' FROM {_ITEMS}""",
    "pending_items": f"SELECT id, repository_id, stream, {_CAT} AS category, parent_number, attempt_count FROM ({_ONCE}) WHERE repository_id = 3 AND stream = 'issue_comments' AND {_CAT} = 'missing_parent' AND resolved_at IS NULL ORDER BY id LIMIT 1000",
    "route_reconciled": f"""WITH r AS ({_KNOWN}) SELECT id, CASE WHEN stream = 'issue_comments' AND is_issue THEN 'issue_comments' WHEN is_pr THEN 'pr_comments' ELSE 'unresolved' END AS goes_to FROM r""",
    **{f"merge_{t}": _merge_sql(t) for t in MERGES},
    "merge_repository_cursors": """WITH b AS (SELECT repository_id AS id, repository_id, 'issue_comments' AS stream, min(updated_at) AS last_updated_at, max(collected_at) AS updated_at FROM issues GROUP BY repository_id),
        n AS (SELECT repository_id, stream, min(updated_at) AS last_updated_at, max(collected_at) AS updated_at FROM pull_requests, (VALUES ('issue_comments'), ('review_comments')) v(stream) GROUP BY ALL)
        SELECT coalesce(b.id, (SELECT max(id) FROM b) + row_number() OVER (PARTITION BY b.id IS NULL ORDER BY n.repository_id, n.stream)) AS id, coalesce(b.repository_id, n.repository_id) AS repository_id, coalesce(b.stream, n.stream) AS stream,
          coalesce(n.last_updated_at, b.last_updated_at) AS last_updated_at, coalesce(n.updated_at, b.updated_at) AS updated_at FROM b FULL JOIN n ON b.repository_id = n.repository_id AND b.stream = n.stream""",
    "merge_stream_runs": f"SELECT repository_id, stream, 'r' AS pipeline_run_id, 'succeeded' AS status, count(*)::INTEGER AS items_read, min(first_seen_at) AS started_at, max(last_attempt_at) AS completed_at FROM ({_ONCE}) GROUP BY repository_id, stream",
    "merge_annotations": f"""WITH a AS (SELECT id AS corpus_id, duplicate_of_id, {_OK} AS ok, CASE source_type WHEN 'issue' THEN '{{"annotations":[{{"aspect":"performance","class":"positive"}}]}}' WHEN 'pull_request' THEN '{{"annotations":[{{"aspect":"speed","class":"positive"}}]}}'
          WHEN 'issue_comment' THEN '{{"annotations":[]}}' ELSE CASE WHEN parent_id IS NULL THEN '[]' ELSE '{{"annotations":[{{"aspect":"safety","class":"' || language || '"}}]}}' END END AS raw FROM ({_C1}))
        SELECT corpus_id, {_TRACE}, 'm' AS model_name, CASE WHEN NOT ok AND duplicate_of_id IS NULL THEN '{{"annotations":[]}}' ELSE raw END AS raw_response,
          CASE WHEN ok OR duplicate_of_id IS NULL THEN 'succeeded' ELSE 'failed' END AS status, CASE WHEN NOT ok AND duplicate_of_id IS NOT NULL THEN 'failed before' END AS error_message FROM a""",
    "tried_again": f"""WITH o AS (SELECT *, coalesce(resolved_at IS NULL AND {_CAT} = 'missing_parent', false) AS hit FROM ({_ONCE}))
        SELECT id, (attempt_count + hit::INTEGER)::INTEGER AS attempt_count, CASE WHEN hit THEN 'still missing' ELSE reason END AS reason, first_seen_at, CASE WHEN hit THEN {_NOW} ELSE last_attempt_at END AS last_attempt_at FROM o""",
    "label_run": f"SELECT corpus_id, {_TRACE}, 'q' AS model_name, raw_response, CASE WHEN error_message IS NULL THEN 'succeeded' ELSE 'failed' END AS status, error_message, {_NOW} AS created_at FROM ({_STATUS})",
    "annotated_aspects": f"SELECT corpus_id, aspect, class FROM ({_STATUS}), (VALUES ('safety', 'neutral'), ('debugging', 'negative')) v(aspect, class) WHERE error_message IS NULL",
    "predictions": f"""SELECT id AS corpus_id, 'v1' AS model_version, '{{"n": ' || length(model_input) || '}}' AS predictions, {_NOW} AS created_at FROM ({_C1})""",
    "repository_listing": "SELECT id, full_name, enabled, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at, strftime(updated_at, '%Y-%m-%dT%H:%M:%S') AS updated_at FROM repositories",
    "enabled_repositories": "SELECT id, full_name, enabled, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at, strftime(updated_at, '%Y-%m-%dT%H:%M:%S') AS updated_at FROM repositories WHERE enabled",
    "recent_runs_topk": "SELECT event_id::VARCHAR AS id, event_type AS run_type, 'succeeded' AS status, ts AS started_at FROM events ORDER BY ts DESC, event_id::VARCHAR DESC LIMIT 10",
}
