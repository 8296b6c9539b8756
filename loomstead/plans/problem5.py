"""Queries on orphan references and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomstead.operators.references import find_orphans, orphan_report
from loomstead.sources.tables import table


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return find_orphans(*(table(spark, d, t) for t in ("issues", "pull_requests", "issue_comments", "pr_comments", "corpus", "unresolved_collection_items")))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(p5_found(spark, d))


_FOUND = r"""
WITH i AS (SELECT id, any_value(repository_id) repo, any_value(number)::BIGINT num, bool_or(state = 'deleted') del, min(collected_at) f FROM issues GROUP BY id),
p AS (SELECT id, any_value(repository_id) repo, any_value(number)::BIGINT num, bool_or(state = 'deleted') del, min(collected_at) f FROM pull_requests GROUP BY id),
ic AS (SELECT id, issue_id fk, min(collected_at) seen, min(created_at) tm FROM issue_comments GROUP BY ALL),
pc AS (SELECT id, pull_request_id fk, min(collected_at) seen, min(created_at) tm FROM pr_comments GROUP BY ALL),
c AS (SELECT id, parent_id fk, source_type IN ('issue', 'issue_comment') isi, min(source_updated_at) tm FROM corpus WHERE parent_id IS NOT NULL GROUP BY ALL),
u AS (SELECT id, repository_id repo, coalesce(stream = 'review_comments', false) rev,
  coalesce(parent_number::BIGINT, try_cast(regexp_extract(coalesce(payload->>'$.issue_url', payload->>'$.pull_request_url'), '/([0-9]+)/*\s*$', 1) AS BIGINT)) num, min(first_seen_at) seen
  FROM unresolved_collection_items WHERE coalesce(regexp_replace(lower(trim(category)), '[\s_-]+', '_', 'g') <> 'invalid_record', true) GROUP BY ALL),
n AS (SELECT repo, num, isp, bool_and(del) del, min(f) f FROM (SELECT repo, num, del, f, false isp FROM i UNION ALL SELECT repo, num, del, f, true FROM p) GROUP BY ALL),
r AS (
  SELECT 'issue_comments' table_name, ic.id record_id, tm, seen, i.id pid, del, f FROM ic LEFT JOIN i ON ic.fk = i.id WHERE fk IS NOT NULL
  UNION ALL SELECT 'pr_comments', pc.id, tm, seen, p.id, del, f FROM pc LEFT JOIN p ON pc.fk = p.id WHERE fk IS NOT NULL
  UNION ALL SELECT 'corpus', c.id, tm, NULL, i.id, del, f FROM c LEFT JOIN i ON c.fk = i.id WHERE isi
  UNION ALL SELECT 'corpus', c.id, tm, NULL, p.id, del, f FROM c LEFT JOIN p ON c.fk = p.id WHERE NOT isi
  UNION ALL SELECT 'unresolved_collection_items', u.id, seen, seen, any_value(n.num), bool_and(del), min(f) FROM u LEFT JOIN n ON u.repo = n.repo AND u.num = n.num AND (n.isp OR NOT rev) WHERE u.num IS NOT NULL GROUP BY u.id, seen)
SELECT DISTINCT table_name, record_id, strftime(tm, '%Y-%m') AS period,
  CASE WHEN pid IS NULL THEN 'missing' WHEN del THEN 'deleted' WHEN f > seen THEN 'late' END AS outcome
FROM r WHERE pid IS NULL OR del OR f > seen
"""

QUERIES = {"p5_found": p5_found, "p5_report": p5_report}
SQL = {
    "p5_found": _FOUND,
    "p5_report": f"SELECT table_name, period, outcome, count(*) AS n_references FROM ({_FOUND}) GROUP BY ALL",
}
