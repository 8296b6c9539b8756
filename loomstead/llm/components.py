"""Splits that keep related records together: Hash-to-min components and weighted rendezvous hashing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstead.operators.joins import hot_keys, join_unique
from loomstead.sources.shared import Cuts

#: Logins that belong to nobody.
NO_LOGINS = ("", "ghost")
#: Split and share of the components.
PROPORTIONS = (("train", 0.9), ("validation", 0.05), ("test", 0.05))
MAX_ROUNDS = 60


def hash_to_min(edges: DataFrame, cuts: Cuts, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Connected components (node, component) of ``edges`` (a, b); the component is its smallest node.

    Every node keeps a cluster, held as one row per member so that no cluster has to fit in a task. In each round a node
    with the smallest member m sends its cluster to m and m to every member. It ends when each cluster is either that of
    its component's minimum or just that minimum. A node whose cluster is a large share of all rows is joined with a
    broadcast of the few such nodes. Self-loops keep single nodes; null ends are ignored; no edges give no rows.
    """
    edges = edges.where("a is not null and b is not null").select("a", "b")
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
    both = both.unionByName(both.select("v", F.col("v").alias("u"))).distinct()
    pairs = cuts.cut(both, "cluster0")
    for k in range(1, max_rounds + 1):
        least = cuts.cut(pairs.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n")), f"least{k}")
        # settled: v is its own minimum, or it knows nothing but its minimum
        open_nodes = least.where((F.col("v") != F.col("m")) & (F.col("n") > 1)).limit(1).count()
        if not open_nodes:
            return least.select(F.col("v").alias("node"), F.col("m").alias("component"))
        hot = hot_keys(least, ["v"], "n")
        known = join_unique(pairs, least.select("v", "m"), ["v"], "inner", hot)
        sent = known.select(F.explode(F.array(F.struct(F.col("m").alias("v"), "u"), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("x")).select("x.v", "x.u")
        after = cuts.cut(sent.distinct(), f"cluster{k}")
        cuts.drop(pairs)
        cuts.drop(least)
        pairs = after
    raise RuntimeError(f"components not settled after {max_rounds} rounds")


def star_edges(members: DataFrame, cuts: Cuts) -> DataFrame:
    """Edges (a, b) from each member (id, kind, k) of a key to the key's smallest id."""
    members = cuts.cut(members.where("id is not null and k is not null").distinct(), "members")
    heads = cuts.cut(members.groupBy("kind", "k").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")), "heads")
    joined = join_unique(members, heads.select("kind", "k", "head"), ["kind", "k"], "inner", hot_keys(heads, ["kind", "k"], "n"))
    return joined.select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()


def authors(rows: DataFrame, source: str) -> DataFrame:
    return rows.where("id is not null").select(F.lit(source).alias("source"), F.col("id").alias("source_id"), "author_github_id", "author_login")


def login_key(column: str = "author_login") -> Column:
    login = F.lower(F.regexp_replace(column, r"(?U)^[\s\x{200b}\x{feff}]+|[\s\x{200b}\x{feff}]+$", ""))
    return F.when(~login.isin(*NO_LOGINS), login)


def related_groups(corpus: DataFrame, issues: DataFrame, pulls: DataFrame, issue_comments: DataFrame, pr_comments: DataFrame) -> DataFrame:
    """(corpus_id, group_id): rows tied by record, thread or author, transitively; the group is its smallest corpus id.

    Null, blank and ``ghost`` logins tie nothing, a null parent ties nothing, a source row that is absent gives no author,
    repeated rows count once, rows without an id are ignored, other columns are ignored, an empty corpus gives no rows.
    """
    cuts = Cuts(corpus.sparkSession, "components")
    own = corpus.where("id is not null").select("id", "source_type", "source_id", "parent_id").distinct()
    kind = F.col("source_type")
    of_issue, of_pr = kind.isin("issue", "issue_comment"), kind.isin("pull_request", "pr_issue_comment", "pr_review_comment")
    source = F.when(kind == "issue", "i").when(kind == "pull_request", "p").when(kind == "issue_comment", "ic").when(of_pr, "pc")
    thread = F.when(of_issue, "thread-i").when(of_pr, "thread-p")
    records = own.select("id", F.concat(F.lit("record-"), kind).alias("kind"), F.col("source_id").alias("k"))
    threads = own.select("id", thread.alias("kind"), F.explode(F.array_distinct(F.array(F.col("parent_id"), F.when(kind.isin("issue", "pull_request"), F.col("source_id"))))).alias("k")).where("kind is not null")
    people = reduce(DataFrame.unionByName, (authors(t, s) for t, s in ((issues, "i"), (pulls, "p"), (issue_comments, "ic"), (pr_comments, "pc"))))
    login = F.xxhash64(login_key())
    people = people.select("source", "source_id", F.explode(F.array(F.struct(F.lit("account").alias("kind"), F.col("author_github_id").cast("long").alias("k")), F.struct(F.lit("login").alias("kind"), F.when(login_key().isNotNull(), login).alias("k")))).alias("x"))
    people = people.select("source", "source_id", "x.kind", "x.k").where("k is not null").distinct()
    heads = own.select(F.col("id"), source.alias("source"), "source_id").groupBy("source", "source_id").agg(F.min("id").alias("id"))
    written = heads.join(people, ["source", "source_id"]).select("id", "kind", "k")
    edges = star_edges(records.unionByName(threads).unionByName(written), cuts)
    alone = own.select(F.col("id").alias("a"), F.col("id").alias("b"))
    return hash_to_min(edges.unionByName(alone), cuts).select(F.col("node").alias("corpus_id"), F.col("component").alias("group_id"))


def assign_splits(groups: DataFrame, proportions=PROPORTIONS, group: str = "group_id", seed: str = "splits-1") -> DataFrame:
    """Add ``split`` by weighted rendezvous hashing: each split scores weight / -ln(hash of group and split), the highest wins.

    All rows of a group get one split; a change of one weight moves only the groups that this split gains or loses.
    Weights need not sum to 1; a split of weight 0 gets nothing; a null group gets a null split.
    """
    scores = []
    for name, weight in proportions:
        if weight < 0:
            raise ValueError("weights can't be negative")
        if weight:
            u = (F.shiftrightunsigned(F.xxhash64(F.col(group), F.lit(f"{seed}/{name}")), 11) + F.lit(0.5)) / F.lit(float(2**53))
            scores.append(F.struct((F.lit(float(weight)) / -F.log(u)).alias("score"), F.lit(name).alias("name")))
    if not scores:
        raise ValueError("no split has a weight")
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return groups.withColumn("split", F.when(F.col(group).isNotNull(), best["name"]))


def split_report(assigned: DataFrame) -> DataFrame:
    """Rows, groups and largest group of each split."""
    sizes = assigned.groupBy("split", "group_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("split").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_groups"), F.max("n").alias("largest_group"))
