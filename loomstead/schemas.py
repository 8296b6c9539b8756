"""Schemas of the stored tables; times are UTC without zone."""

from __future__ import annotations

_RAW = "id long, github_id long, repository_id long, author_login string, author_github_id long, body string, github_url string, created_at timestamp_ntz, updated_at timestamp_ntz, collected_at timestamp_ntz"
_PARENT = _RAW + ", number int, title string, state string, closed_at timestamp_ntz"

#: Table name to schema.
TABLES = {
    "repositories": "id long, full_name string, enabled boolean, created_at timestamp_ntz, updated_at timestamp_ntz",
    "repository_cursors": "id long, repository_id long, stream string, last_updated_at timestamp_ntz, updated_at timestamp_ntz",
    "issues": _PARENT,
    "pull_requests": _PARENT + ", merged_at timestamp_ntz",
    "issue_comments": _RAW + ", issue_id long",
    "pr_comments": _RAW + ", pull_request_id long, comment_type string, path string, in_reply_to_github_id long",
    "unresolved_collection_items": "id long, repository_id long, stream string, item_key string, category string, github_id long, parent_number int, payload string, reason string, attempt_count int, first_seen_at timestamp_ntz, last_attempt_at timestamp_ntz, resolved_at timestamp_ntz",
    "corpus": "id long, source_type string, source_id long, parent_id long, raw_text string, context_text string, target_text string, model_input string, clean_text string, language string, content_hash string, cleaning_version string, duplicate_of_id long, source_updated_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz",
    "llm_annotations": "id long, corpus_id long, taxonomy_version string, prompt_version string, model_name string, raw_response string, parsed_result struct<annotations:array<struct<aspect:string,class:string>>>, status string, error_message string, created_at timestamp_ntz, updated_at timestamp_ntz",
    "bert_predictions": "id long, corpus_id long, model_version string, predictions string, created_at timestamp_ntz",
    "pipeline_runs": "id string, run_type string, status string, started_at timestamp_ntz, heartbeat_at timestamp_ntz, completed_at timestamp_ntz, stats string, error_message string",
    "collection_stream_runs": "id long, pipeline_run_id string, repository_id long, stream string, status string, pages_read int, items_read int, items_written int, retries int, error_message string, started_at timestamp_ntz, completed_at timestamp_ntz",
}

#: Natural keys, by which rows are merged.
KEYS = {
    "repositories": ("full_name",),
    "repository_cursors": ("repository_id", "stream"),
    "issues": ("github_id",),
    "pull_requests": ("repository_id", "number"),
    "issue_comments": ("github_id",),
    "pr_comments": ("github_id", "comment_type"),
    "unresolved_collection_items": ("repository_id", "stream", "item_key"),
    "corpus": ("source_type", "source_id", "content_hash"),
    "llm_annotations": ("corpus_id", "taxonomy_version", "prompt_version", "model_name"),
    "bert_predictions": ("corpus_id", "model_version"),
    "pipeline_runs": ("id",),
    "collection_stream_runs": ("pipeline_run_id", "repository_id", "stream"),
}

_TEXTS = ("body", "author_login", "author_github_id", "github_url", "created_at", "updated_at", "collected_at")
#: Columns that a merge overwrites in a row that exists; all others keep their first value.
UPDATES = {
    "repository_cursors": ("last_updated_at", "updated_at"),
    "issues": ("number", "title", "state", "closed_at", *_TEXTS),
    "pull_requests": ("title", "state", "closed_at", "merged_at", *_TEXTS),
    "issue_comments": ("issue_id", *_TEXTS),
    "pr_comments": ("pull_request_id", "path", "in_reply_to_github_id", *_TEXTS),
    "unresolved_collection_items": ("category", "github_id", "parent_number", "payload", "reason", "last_attempt_at", "resolved_at"),
    "corpus": ("duplicate_of_id", "source_updated_at", "updated_at"),
    "llm_annotations": ("raw_response", "parsed_result", "status", "error_message", "updated_at"),
    "bert_predictions": ("predictions",),
    "collection_stream_runs": ("status", "pages_read", "items_read", "items_written", "retries", "error_message", "completed_at"),
}
#: Second unique keys, checked after a merge.
ALSO_UNIQUE = {"issues": ("repository_id", "number"), "pull_requests": ("github_id",)}
