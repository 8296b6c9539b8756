from datetime import datetime

from loomstead.operators.references import find_orphans, orphan_report
from loomstead.schemas import TABLES

T = [datetime(2025, 1, d) for d in range(1, 9)]


def tables(spark, issues=(), pulls=(), ic=(), pc=(), corpus=(), items=()):
    raw = lambda i, seen, repo=1: (i, i, repo, None, None, None, "", T[0], T[0], seen)
    make = lambda t, rows: spark.createDataFrame(rows, TABLES[t])
    return (
        make("issues", [(*raw(i, s), n, "t", state, None) for i, s, n, state in issues]),
        make("pull_requests", [(*raw(i, s), n, "t", state, None, None) for i, s, n, state in pulls]),
        make("issue_comments", [(*raw(i, s), p) for i, s, p in ic]),
        make("pr_comments", [(*raw(i, s), p, "issue_comment", None, None) for i, s, p in pc]),
        make("corpus", [(i, k, 1, p, "", "", "", "", "", None, "h", "v", None, T[0], T[0], T[0]) for i, k, p in corpus]),
        make("unresolved_collection_items", [(i, 1, stream, f"k{i}", cat, None, num, payload, "", 1, T[4], T[4], None) for i, stream, cat, num, payload in items]),
    )


def cases(found):
    return {(r.table_name, r.record_id): r.outcome for r in found.collect()}


def test_outcomes(spark):
    t = tables(
        spark,
        issues=[(1, T[2], 10, "open"), (1, T[6], 10, "open"), (2, T[1], 11, "deleted")],
        pulls=[(1, T[5], 20, "open")],
        ic=[(1, T[3], 1), (2, T[1], 1), (2, T[1], 1), (3, T[3], 2), (4, T[3], 99), (5, T[3], None)],
        pc=[(1, T[6], 1), (2, T[4], 1)],
        corpus=[(1, "issue", 1), (2, "issue_comment", 2), (3, "pull_request", 1), (4, "pr_review_comment", 2), (5, "issue", None)],
        items=[
            (1, "issue_comments", "missing_parent", 10, "{}"), (2, "issue_comments", None, None, '{"issue_url":"http://x/issues/20/"}'), (3, "review_comments", "Missing Parent", 10, "{}"),
            (4, "issue_comments", "Invalid-Record", 77, "{}"), (5, "issue_comments", None, None, "{}"), (6, "issue_comments", "x", 11, "no json"),
        ],
    )
    assert cases(find_orphans(*t)) == {
        ("issue_comments", 2): "late", ("issue_comments", 3): "deleted", ("issue_comments", 4): "missing", ("pr_comments", 2): "late",
        ("corpus", 2): "deleted", ("corpus", 4): "missing",
        ("unresolved_collection_items", 2): "late", ("unresolved_collection_items", 3): "missing", ("unresolved_collection_items", 6): "deleted",
    }
    assert sum(r.n_references for r in orphan_report(find_orphans(*t)).collect()) == 9


def test_empty_tables_and_clashing_columns(spark):
    t = tables(spark, ic=[(1, T[0], 5)])
    assert cases(find_orphans(*(x.withColumn("fk", x.id).withColumn("seen", x.id).withColumn("p_first", x.id) for x in t))) == {("issue_comments", 1): "missing"}
    assert find_orphans(*tables(spark)).count() == 0
