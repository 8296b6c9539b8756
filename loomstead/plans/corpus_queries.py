"""Queries on the corpus build, merges and versions, and their SQL."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead.functions.text import clean_normalised, clean_text, content_hash, language_tag, model_input, nfkc, paragraphs
from loomstead.operators.corpus import build_corpus, corpus_candidates, corpus_rows, current_versions, duplicate_pointers, latest
from loomstead.operators.upsert import keep_last, upsert
from loomstead.schemas import TABLES
from loomstead.sources.tables import table

def run_time():
    return F.to_timestamp(F.lit("2026-01-01 00:00:00")).cast("timestamp_ntz")



def candidates(spark: SparkSession, d: str) -> DataFrame:
    return corpus_candidates(*(latest(table(spark, d, t)) for t in ("issues", "pull_requests", "issue_comments", "pr_comments")))


def corpus_build(spark: SparkSession, d: str) -> DataFrame:
    empty = spark.createDataFrame([], TABLES["corpus"])
    return build_corpus(empty, candidates(spark, d), run_time())[0]


def corpus_build_counts(spark: SparkSession, d: str) -> DataFrame:
    """The counts of a first build, and of a second one on its result, which reads and writes all again and adds nothing."""
    now, rows = run_time(), candidates(spark, d)
    corpus, first = build_corpus(spark.createDataFrame([], TABLES["corpus"]), rows, now)
    again, second = build_corpus(corpus, rows, now)
    sizes = again.select(F.lit(1).alias("build"), "id").unionByName(corpus.select(F.lit(0).alias("build"), "id")).groupBy("build").agg(F.count(F.lit(1)).alias("rows"), F.max("id").alias("highest_id"))
    stats = spark.createDataFrame([(n, x["read"], x["written"], x["duplicates"], x["empty"]) for n, x in enumerate((first, second))], "build int, n_read long, n_written long, n_duplicates long, n_empty long")
    return stats.join(sizes, "build")


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", clean_text(F.col("text")).alias("cleaned"))


def normalised(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", nfkc("text").alias("text"))


def corpus_raw(spark: SparkSession, d: str) -> DataFrame:
    """Raw texts and hashes of all candidates, which don't depend on cleaning."""
    rows = corpus_rows(candidates(spark, d), run_time(), clean=lambda c: c)
    return rows.select("source_type", "source_id", "parent_id", "raw_text", "content_hash")


def clean_text_native(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", clean_normalised(F.col("text")).alias("cleaned"))


def strip_html_comments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issues").select("id", F.regexp_replace("body", "(?s)<!--.*?-->", "").alias("body")).distinct()


def languages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus").select("id", language_tag(F.col("target_text")).alias("language")).distinct()


def hashes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", content_hash(F.col("repo_name"), F.col("text")).alias("content_hash"))


def pointers(spark: SparkSession, d: str) -> DataFrame:
    once = table(spark, d, "corpus").dropDuplicates(["id"])
    return duplicate_pointers(once).select("id", "duplicate_of_id")


def inputs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus").select("id", model_input(F.col("context_text"), F.col("target_text")).alias("model_input")).distinct()


def joined_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pull_requests").select("id", paragraphs(F.col("title"), F.col("body")).alias("raw_text")).distinct()


def stats(spark: SparkSession, d: str) -> DataFrame:
    """Counts of a first build on the tables, with cleaning of texts that are in NFKC already."""
    rows = corpus_rows(candidates(spark, d), run_time(), clean=clean_normalised)
    kept = F.col("target_text") != ""
    return rows.groupBy("source_type").agg(F.count(F.lit(1)).alias("n_read"), F.count_if(kept).alias("n_written"), F.count_if(~kept).alias("n_empty"))


def versions(spark: SparkSession, d: str) -> DataFrame:
    return current_versions(table(spark, d, "corpus")).select("source_type", "source_id", "id", "content_hash")


def last_delivery(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "issues")).select("id", "github_id", "collected_at")


def merge_columns(spark: SparkSession, d: str) -> DataFrame:
    """Pull requests merged into the issues by repository and number, as a later batch: only state and updated_at change."""
    base = latest(table(spark, d, "issues")).select("repository_id", "number", "title", "state", "updated_at")
    batch = latest(table(spark, d, "pull_requests")).select("repository_id", (F.col("number") - 1).alias("number"), "title", "state", "updated_at")
    return upsert(base, batch, ("repository_id", "number"), ("state", "updated_at"), ["updated_at"])


def merge_versions(spark: SparkSession, d: str) -> DataFrame:
    """Corpus rows after the versions of the raw tables arrive: known versions get new times, others are added."""
    base = keep_last(table(spark, d, "corpus"), ("source_type", "source_id", "content_hash"), ["id"]).select("source_type", "source_id", "content_hash", "raw_text", "source_updated_at")
    batch = corpus_rows(candidates(spark, d), run_time(), clean=lambda c: c).select("source_type", "source_id", "content_hash", "raw_text", F.lit(None).cast("timestamp_ntz").alias("source_updated_at"))
    return upsert(base, batch, ("source_type", "source_id", "content_hash"), ("source_updated_at",))


# SQL -------------------------------------------------------------------------------------------------------------------

_LATEST = "SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY id ORDER BY collected_at DESC) = 1"
_ALL = ", ".join(f"{a} AS ({_LATEST.format(t=t)})" for a, t in (("i", "issues"), ("p", "pull_requests"), ("ic", "issue_comments"), ("pc", "pr_comments")))
_CANDIDATES = f"""WITH {_ALL}
SELECT 'issue' AS source_type, id AS source_id, id AS parent_id, title, body, NULL AS path, updated_at AS source_updated_at FROM i
UNION ALL SELECT 'pull_request', id, id, title, body, NULL, updated_at FROM p
UNION ALL SELECT 'issue_comment', ic.id, i.id, i.title, ic.body, NULL, ic.updated_at FROM ic JOIN i ON i.id = ic.issue_id
UNION ALL SELECT CASE comment_type WHEN 'issue_comment' THEN 'pr_issue_comment' ELSE 'pr_review_comment' END, pc.id, p.id, p.title, pc.body, pc.path, pc.updated_at
  FROM pc JOIN p ON p.id = pc.pull_request_id WHERE comment_type IN ('issue_comment', 'review_comment')"""
_JOIN = "concat_ws(chr(10) || chr(10), nullif(coalesce(title, ''), ''), nullif(coalesce(body, ''), ''))"
_RAW = f"CASE WHEN source_type IN ('issue', 'pull_request') THEN {_JOIN} ELSE coalesce(body, '') END"
_CONTEXT = "CASE source_type WHEN 'issue' THEN '' WHEN 'pull_request' THEN '' WHEN 'issue_comment' THEN 'Issue title: ' || coalesce(title, '') ELSE 'Pull request title: ' || coalesce(title, '') END"
_HASH = f"sha256('clean-v1' || chr(0) || ({_CONTEXT}) || chr(0) || ({_RAW}))"
_WS = r"\t-\r\x1c-\x20\x{85}\x{1680}\x{2028}\x{2029}"


def _clean(x: str) -> str:
    steps = [
        (r"\r\n?", "chr(10)", "g"), ("<!--.*?-->", "''", "gs"), (r"[\x{200b}\x{200c}\x{200d}\x{feff}]", "''", "g"),
        (r"[\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]", "chr(10)", "g"), (r"[\t\x1f\x20\x{1680}]+\n", "chr(10)", "g"),
        (r"\n{3,}", "chr(10) || chr(10)", "g"), (f"^[{_WS}]+", "''", "g"), (f"[{_WS}]+$", "''", "g"),
    ]
    x = f"coalesce({x}, '')"
    for pattern, to, options in steps:
        x = f"regexp_replace({x}, '{pattern}', {to}, '{options}')"
    return x


_TARGET = f"CASE WHEN source_type IN ('issue', 'pull_request') THEN concat_ws(chr(10) || chr(10), nullif({_clean('title')}, ''), nullif({_clean('body')}, '')) ELSE {_clean('body')} END"


@functools.cache
def _nfkc_sql(texts: str, column: str) -> str:
    """A query for (x, y): y is NFKC of each non-ASCII x. DuckDB has NFC, so only characters that compatibility alone
    changes are replaced before, by a table that Python's Unicode data gives."""
    changed = [(c, k) for c in map(chr, range(0x80, 0x110000)) if not 0xD800 <= ord(c) < 0xE000 and (k := unicodedata.normalize("NFKC", c)) != unicodedata.normalize("NFC", c)]
    rows = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in pair)) for pair in changed)
    return f"""SELECT x, nfc_normalize(string_agg(coalesce(k, c), '' ORDER BY i)) AS y FROM (
        SELECT x, unnest(cs) AS c, unnest(range(len(cs))) AS i FROM (SELECT x, regexp_extract_all(x, '(?s).') AS cs FROM (SELECT DISTINCT {column} AS x FROM ({texts})) WHERE regexp_matches(x, '[^\\x00-\\x7f]'))
        ) LEFT JOIN (VALUES {rows}) m(c, k) USING (c) GROUP BY x"""


_CORPUS_ONCE = "SELECT * FROM corpus QUALIFY row_number() OVER (PARTITION BY id ORDER BY source_updated_at) = 1"

# the candidates with title and body in NFKC as _t and _b
_NORMAL = f"""WITH c AS ({_CANDIDATES}), n AS ({_nfkc_sql('SELECT title AS v FROM c UNION ALL SELECT body FROM c', 'v')})
    SELECT c.*, coalesce(t.y, c.title) AS _t, coalesce(b.y, c.body) AS _b FROM c LEFT JOIN n t ON t.x = c.title LEFT JOIN n b ON b.x = c.body"""
_OWN = "source_type IN ('issue', 'pull_request')"
_ORDER = "list_position(['issue', 'pull_request', 'issue_comment', 'pr_issue_comment', 'pr_review_comment'], source_type)"
_BUILT = f"""WITH r AS (SELECT source_type, source_id, parent_id, {_RAW} AS raw_text, CASE WHEN {_OWN} THEN '' ELSE CASE source_type WHEN 'issue_comment' THEN 'Issue title: ' ELSE 'Pull request title: ' END || {_clean('_t')} END AS context_text,
      CASE WHEN {_OWN} THEN concat_ws(chr(10) || chr(10), nullif({_clean('_t')}, ''), nullif({_clean('_b')}, '')) ELSE {_clean('_b')} END AS target_text, {_HASH} AS content_hash, source_updated_at FROM ({_NORMAL})),
    k AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}, source_id, content_hash) AS id, len(regexp_extract_all(target_text, '[\\x{{3400}}-\\x{{9fff}}]')) AS cjk, len(regexp_extract_all(target_text, '[A-Za-z]')) AS latin FROM r WHERE target_text <> '')
    SELECT id, source_type, source_id, parent_id, raw_text, context_text, target_text, '[CONTEXT]' || chr(10) || coalesce(nullif(context_text, ''), '(none)') || chr(10) || chr(10) || '[TARGET]' || chr(10) || target_text AS model_input, target_text AS clean_text,
      CASE WHEN cjk > 0 AND cjk >= latin * 0.2::DOUBLE THEN 'zh' WHEN latin > 0 THEN 'en' ELSE 'unknown' END AS language, content_hash, 'clean-v1' AS cleaning_version, nullif(min(id) OVER (PARTITION BY content_hash), id) AS duplicate_of_id,
      source_updated_at, TIMESTAMP '2026-01-01 00:00:00' AS created_at, TIMESTAMP '2026-01-01 00:00:00' AS updated_at FROM k"""

QUERIES = {
    "corpus_candidates": candidates,
    "corpus_build": corpus_build,
    "corpus_build_counts": corpus_build_counts,
    "clean_text": cleaned,
    "nfkc_text": normalised,
    "corpus_raw": corpus_raw,
    "clean_text_native": clean_text_native,
    "strip_html_comments": strip_html_comments,
    "detect_language": languages,
    "content_hash": hashes,
    "duplicate_pointers": pointers,
    "model_input": inputs,
    "joined_parts": joined_parts,
    "corpus_stats": stats,
    "current_versions": versions,
    "upsert_last_wins": last_delivery,
    "upsert_update_columns": merge_columns,
    "corpus_versions_upsert": merge_versions,
}
SQL = {
    "corpus_candidates": _CANDIDATES,
    "corpus_build": _BUILT,
    "corpus_build_counts": f"""WITH k AS ({_BUILT}), n AS (SELECT count(*) AS n_read FROM ({_CANDIDATES}))
        SELECT build, n_read, n_written, n_duplicates, n_read - n_written AS n_empty, n_written AS rows, n_written AS highest_id FROM n, (SELECT count(*) AS n_written, count(duplicate_of_id) AS n_duplicates FROM k), (VALUES (0), (1)) v(build)""",
    "clean_text": f"SELECT doc_id, {_clean('coalesce(y, text)')} AS cleaned FROM documents LEFT JOIN ({_nfkc_sql('SELECT text FROM documents', 'text')}) n ON n.x = text",
    "nfkc_text": f"SELECT doc_id, coalesce(y, text) AS text FROM documents LEFT JOIN ({_nfkc_sql('SELECT text FROM documents', 'text')}) n ON n.x = text",
    "corpus_raw": f"SELECT source_type, source_id, parent_id, {_RAW} AS raw_text, {_HASH} AS content_hash FROM ({_CANDIDATES})",
    "clean_text_native": f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents",
    "strip_html_comments": "SELECT DISTINCT id, regexp_replace(body, '<!--.*?-->', '', 'gs') AS body FROM issues",
    "detect_language": r"""SELECT DISTINCT id, CASE WHEN c > 0 AND c >= l * 0.2::DOUBLE THEN 'zh' WHEN l > 0 THEN 'en' ELSE 'unknown' END AS language
        FROM (SELECT id, len(regexp_extract_all(target_text, '[\x{3400}-\x{9fff}]')) c, len(regexp_extract_all(target_text, '[A-Za-z]')) l FROM corpus)""",
    "content_hash": "SELECT doc_id, sha256('clean-v1' || chr(0) || coalesce(repo_name, '') || chr(0) || coalesce(text, '')) AS content_hash FROM documents",
    "duplicate_pointers": f"SELECT id, nullif(min(id) OVER (PARTITION BY content_hash), id) AS duplicate_of_id FROM ({_CORPUS_ONCE})",
    "model_input": "SELECT DISTINCT id, '[CONTEXT]' || chr(10) || coalesce(nullif(context_text, ''), '(none)') || chr(10) || chr(10) || '[TARGET]' || chr(10) || target_text AS model_input FROM corpus",
    "joined_parts": f"SELECT DISTINCT id, {_JOIN} AS raw_text FROM pull_requests",
    "corpus_stats": f"""SELECT source_type, count(*) AS n_read, count(*) FILTER (t <> '') AS n_written, count(*) FILTER (t = '') AS n_empty
        FROM (SELECT source_type, {_TARGET} AS t FROM ({_CANDIDATES})) GROUP BY ALL""",
    "current_versions": "SELECT source_type, source_id, id, content_hash FROM (SELECT DISTINCT source_type, source_id, id, content_hash, source_updated_at FROM corpus) QUALIFY row_number() OVER (PARTITION BY source_type, source_id ORDER BY source_updated_at DESC, id DESC) = 1",
    "upsert_last_wins": "SELECT id, any_value(github_id) AS github_id, max(collected_at) AS collected_at FROM issues GROUP BY id",
    "upsert_update_columns": f"""WITH {_ALL}, n AS (SELECT repository_id, number - 1 AS number, title, state, updated_at FROM p)
        SELECT coalesce(i.repository_id, n.repository_id) AS repository_id, coalesce(i.number, n.number) AS number, CASE WHEN i.id IS NOT NULL THEN i.title ELSE n.title END AS title,
          CASE WHEN n.state IS NOT NULL THEN n.state ELSE i.state END AS state, CASE WHEN n.state IS NOT NULL THEN n.updated_at ELSE i.updated_at END AS updated_at
        FROM i FULL JOIN n ON i.repository_id = n.repository_id AND i.number = n.number""",
    "corpus_versions_upsert": f"""WITH b AS (SELECT source_type, source_id, content_hash, raw_text, source_updated_at FROM ({_CORPUS_ONCE}) QUALIFY row_number() OVER (PARTITION BY source_type, source_id, content_hash ORDER BY id DESC) = 1),
        n AS (SELECT source_type, source_id, {_HASH} AS content_hash, {_RAW} AS raw_text FROM ({_CANDIDATES}))
        SELECT coalesce(b.source_type, n.source_type) AS source_type, coalesce(b.source_id, n.source_id) AS source_id, coalesce(b.content_hash, n.content_hash) AS content_hash,
          CASE WHEN b.source_id IS NOT NULL THEN b.raw_text ELSE n.raw_text END AS raw_text, CASE WHEN n.source_id IS NULL THEN b.source_updated_at END AS source_updated_at
        FROM b FULL JOIN n ON b.source_type = n.source_type AND b.source_id = n.source_id AND b.content_hash = n.content_hash""",
}
