from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loomstead.operators.corpus import build_corpus, corpus_candidates, corpus_rows, current_versions, duplicate_pointers
from loomstead.schemas import TABLES
from loomstead.streaming.collect import at

T0, T1, T2 = (datetime(2025, 1, d) for d in (1, 2, 3))
CAND = "source_type string, source_id long, parent_id long, title string, body string, path string, source_updated_at timestamp_ntz"


def build(spark, corpus, rows, now=T1):
    return build_corpus(corpus, spark.createDataFrame(rows, CAND), at(now))


def test_texts_by_kind_and_no_path_in_them(spark):
    rows = [("issue", 1, 1, "T", "B", None, T0), ("pr_review_comment", 2, 1, "T", "C", "src/secret.rs", T0), ("issue_comment", 3, 1, None, "D", None, T0)]
    got = {r.source_id: r for r in corpus_rows(spark.createDataFrame(rows, CAND), at(T1)).collect()}
    assert (got[1].target_text, got[1].context_text) == ("T\n\nB", "")
    assert (got[2].target_text, got[2].context_text) == ("C", "Pull request title: T")
    assert got[3].context_text == "Issue title: "
    assert not any("secret" in str(v) for v in got[2])
    with pytest.raises(Exception, match="unknown source type"):
        corpus_rows(spark.createDataFrame([("letter", 1, 1, "", "x", None, T0)], CAND), at(T1)).collect()


def test_versions_pointers_and_counts(spark):
    empty = spark.createDataFrame([], TABLES["corpus"])
    rows = [("pull_request", 1, 1, "S", "b", None, T0), ("issue", 5, 5, "S", "b", None, T0), ("issue", 2, 2, "S", "b", None, T0), ("issue", 3, 3, "", "<!-- x -->", None, T0)]
    c1, stats = build(spark, empty, rows)
    assert stats == {"read": 4, "written": 3, "duplicates": 2, "empty": 1}
    got = {(r.source_type, r.source_id): r for r in c1.collect()}
    assert [got[k].id for k in (("issue", 2), ("issue", 5), ("pull_request", 1))] == [1, 2, 3]
    assert [got[k].duplicate_of_id for k in (("issue", 2), ("issue", 5), ("pull_request", 1))] == [None, 1, 1]
    # a second build writes nothing new, an edit makes a version, going back finds the old one
    c2, stats = build(spark, c1, rows)
    assert stats["written"] == 3 and c2.count() == 3
    c3, _ = build(spark, c2, [("issue", 2, 2, "S", "edited", None, T1)])
    c4, _ = build(spark, c3, [("issue", 2, 2, "S", "b", None, T2)])
    assert c4.count() == 4 and c4.where("id = 1").first().source_updated_at == T2
    assert current_versions(c4).where("source_type = 'issue' and source_id = 2").first().id == 1
    assert c4.agg(F.max("id")).first()[0] == 4


def test_candidates_need_a_parent_and_a_positive_id(spark):
    make = lambda t, rows: spark.createDataFrame(rows, TABLES[t])
    raw = lambda i, body="b": (i, i, 1, "u", 1, body, "", T0, T0, T0)
    issues = make("issues", [(*raw(0), 9, "t", "open", None), (*raw(1), 1, "t", "open", None)])
    pulls = make("pull_requests", [(*raw(1), 2, "p", "open", None, None)])
    ic = make("issue_comments", [(*raw(4), 1), (*raw(5), 77)])
    pc = make("pr_comments", [(*raw(6), 1, "issue_comment", None, None), (*raw(7), 1, "review_comment", "f", None), (*raw(8), 1, "other", None, None)])
    got = {(r.source_type, r.source_id) for r in corpus_candidates(issues, pulls, ic, pc).collect()}
    assert got == {("issue", 1), ("pull_request", 1), ("issue_comment", 4), ("pr_issue_comment", 6), ("pr_review_comment", 7)}


def test_pointers_ignore_null_hashes(spark):
    rows = spark.createDataFrame([(1, None), (2, None), (3, "h"), (4, "h")], "id long, content_hash string").withColumn("duplicate_of_id", F.lit(None).cast("long"))
    assert {r.id: r.duplicate_of_id for r in duplicate_pointers(rows).collect()} == {1: None, 2: None, 3: None, 4: 3}
