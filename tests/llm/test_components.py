import random

import pytest
from pyspark.sql import functions as F

from loomstead.llm.components import assign_splits, hash_to_min, related_groups
from loomstead.llm.problem1 import p1_found
from loomstead.schemas import TABLES
from loomstead.sources.shared import Cuts
from tests.conftest import DATA


def union_find(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_random_graphs_paths_and_a_star(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    pairs += [(1000 + i, 1001 + i) for i in range(40)] + [(2000 + i * 7 % 500, 2000) for i in range(500)] + [(9, 9)]
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs + [(None, 1), (1, None)], "a long, b long")
    got = {r.node: r.component for r in hash_to_min(df, Cuts(spark, "t")).collect()}
    assert got == union_find(pairs, {x for p in pairs for x in p})
    assert hash_to_min(df.limit(0), Cuts(spark, "t")).count() == 0


def test_ties_between_rows(spark):
    raw = lambda i, login, account: (i, i, 1, login, account, None, "", None, None, None)
    make = lambda t, rows: spark.createDataFrame(rows, TABLES[t])
    issues = make("issues", [(*raw(1, " Ann ", None), 1, "t", "open", None), (*raw(2, "bob", 7), 2, "t", "open", None), (*raw(3, "ghost", None), 3, "t", "open", None), (*raw(4, " ", None), 4, "t", "open", None)])
    pulls = make("pull_requests", [(*raw(1, "ANN", 9), 5, "t", "open", None, None)])
    ic = make("issue_comments", [(*raw(1, None, 7), 3), (*raw(2, "Ghost", None), 99)])
    pc = make("pr_comments", [(*raw(1, "", None), 1, "issue_comment", None, None)])
    c = [(10, "issue", 1, 1), (11, "pull_request", 1, 1), (12, "issue", 2, 2), (13, "issue_comment", 1, 3), (14, "issue", 3, None), (15, "issue", 4, None), (16, "issue_comment", 2, None),
         (17, "pr_issue_comment", 1, 1), (18, "issue", 4, None), (19, "pr_review_comment", 1, None), (20, "issue_comment", 50, None), (20, "issue_comment", 50, None)]
    corpus = make("corpus", [(i, k, s, p, *[""] * 5, None, "h", "v", None, None, None, None) for i, k, s, p in c])
    got = {r.corpus_id: r.group_id for r in related_groups(corpus, issues, pulls, ic, pc).collect()}
    assert got == {10: 10, 11: 10, 17: 10, 12: 12, 13: 12, 14: 12, 15: 15, 18: 15, 16: 16, 19: 19, 20: 20}
    extra = corpus.withColumn("kind", F.lit(1)).withColumn("k", F.lit(1))
    assert related_groups(extra.limit(0), issues, pulls, ic, pc).count() == 0


def test_splits_follow_their_weights_and_move_little(spark):
    groups = spark.range(20000).select(F.col("id").alias("group_id"))
    share = {r[0]: r[1] / 20000 for r in assign_splits(groups).groupBy("split").count().collect()}
    assert abs(share["train"] - 0.9) < 0.01 and abs(share["test"] - 0.05) < 0.01
    a = assign_splits(groups, (("x", 1), ("y", 1)))
    b = assign_splits(groups, (("x", 1), ("y", 1), ("z", 2))).withColumnRenamed("split", "later")
    moved = a.join(b, "group_id").where("split <> later")
    assert moved.where("later <> 'z'").count() == 0 and abs(moved.count() / 20000 - 0.5) < 0.02
    assert assign_splits(spark.createDataFrame([(None,)], "group_id long")).first().split is None
    with pytest.raises(ValueError):
        assign_splits(groups, (("x", 0),))


def test_all_of_the_tables(spark):
    rows = p1_found(spark, DATA).collect()
    assert len({r.corpus_id for r in rows}) == len(rows) and all(r.group_id <= r.corpus_id for r in rows)
