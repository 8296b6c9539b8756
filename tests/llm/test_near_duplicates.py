import itertools
import random

from pyspark.sql import functions as F

from loomstead.llm.near_duplicates import NearDuplicates
from loomstead.llm.problem3 import p3_found, p3_groups
from loomstead.llm.sketches import Vocabulary, shingle_hashes, words
from tests.conftest import DATA


def texts(n=160, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n // 2):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(40, 90))]
        out.append(" ".join(w))
        for _ in range(rng.randrange(0, 6)):
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice([[], [rng.choice(vocabulary)], w[at : at + 1] * 2]) + w[at + 1 :]
        out.append(" ".join(w))
    return out


def brute(rows, n, least, limit):
    v, sets = Vocabulary(), {}
    for i, t in rows:
        w = words(t)
        if len(w) >= least:
            sets[i] = set(shingle_hashes(v.ids(w), n).tolist())
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= limit}, sets


def pairs_of(near):
    rep = {r.id: r.rep for r in near.members.collect()}
    links = {(r.a, r.b) for r in near.links.collect()}
    return {(a, b) for a, b in itertools.combinations(sorted(rep), 2) if rep[a] == rep[b] or (min(rep[a], rep[b]), max(rep[a], rep[b])) in links}


def test_links_are_those_of_brute_force(spark):
    rows = list(enumerate(texts()))
    want, _ = brute(rows, 3, 40, 0.6)
    docs = spark.createDataFrame(rows, "id long, text string")
    assert pairs_of(NearDuplicates(docs, 0.6, 3, 40)) == want == pairs_of(NearDuplicates(docs, 0.6, 3, 40, exact=True)) and len(want) > 30


def test_pairs_close_to_the_similarity(spark):
    """Pairs at 0.60 to 0.70 that differ by one inserted block."""
    rng, rows = random.Random(5), []
    for i in range(600):
        w, limit = [f"x{rng.randrange(10**6)}" for _ in range(90)], rng.choice([0.6, 0.6, 0.65, 0.7])
        more, at = int(86 / limit) - 90, rng.randrange(2, 89)  # 86 common runs of 90 + more
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:at] + [f"y{rng.randrange(10**6)}" for _ in range(more)] + w[at:]))]
    v = Vocabulary()
    sets = {i: set(shingle_hashes(v.ids(words(t)), 3).tolist()) for i, t in rows}
    want = {(i, i + 1) for i in range(0, len(rows), 2) if len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) >= 0.6}
    docs = spark.createDataFrame(rows, "id long, text string")
    got = {(r.a, r.b) for r in NearDuplicates(docs, 0.6, 3, 40).links.collect()}
    assert len(want) == 600 and got <= want and len(want - got) <= 2
    assert {(r.a, r.b) for r in NearDuplicates(docs, 0.6, 3, 40, exact=True).links.collect()} == want


def test_hot_buckets_in_blocks(spark, monkeypatch):
    """A family of texts that differ in one word each, a third of all: its buckets are cut into blocks, no link is lost."""
    from loomstead.llm import near_duplicates as N

    rng = random.Random(7)
    w = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(w[: i % 80] + [f"v{i}"] + w[i % 80 + 1 :])) for i in range(60)]
    rows += [(100 + i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(60))) for i in range(120)]
    want, _ = brute(rows, 3, 40, 0.6)
    monkeypatch.setattr(N, "SPLIT", 5)
    split = []
    monkeypatch.setattr(N, "hot_buckets", lambda *a, real=N.hot_buckets: split.append(real(*a)) or split[-1])
    near = NearDuplicates(spark.createDataFrame(rows, "id long, text string"), 0.6, 3, 40)
    assert pairs_of(near) == want and split[0] and min(split[0].values()) > 5


def test_copies_nulls_and_short_texts(spark):
    t = texts(2)[0]
    rows = [(1, t), (2, t.upper()), (3, None), (4, ""), (5, "short"), (6, t), (6, t), (None, t), (7, "中" * 50)]
    near = NearDuplicates(spark.createDataFrame(rows, "id long, text string").withColumn("k", F.lit(1)), 0.8, 5, 40)
    got = {r.id: (r.class_id, r.n_links, r.group_id) for r in near.groups().collect()}
    assert got == {1: (1, 0, 1), 2: (1, 0, 1), 6: (1, 0, 1), 7: (7, 0, 7)}
    empty = NearDuplicates(spark.createDataFrame([], "id long, text string"))
    assert empty.links.count() == empty.groups().count() == 0


def test_groups_have_every_row(spark, tmp_path):
    rows = [(1, "one two three"), (2, "One two, three!"), (3, None), (4, ""), (5, "🦀 ..."), (5, "🦀 ..."), (None, "x")]
    spark.createDataFrame(rows, "id long, target_text string").write.parquet(str(tmp_path / "corpus.parquet"))
    got = sorted(tuple(r) for r in p3_groups(spark, str(tmp_path)).collect())
    assert got == [(1, 1, 0, 1), (2, 1, 0, 1), (3, 3, 0, 3), (4, 4, 0, 4), (5, 5, 0, 5)]


def test_words():
    assert words("Foo_bar-1 中文の Ünï") == ["foo", "bar", "1", "中", "文", "の", "ünï"] and words(None) == []


def test_the_tables(spark):
    import duckdb

    con = duckdb.connect()
    rows = con.execute(f"select id, any_value(target_text), any_value(content_hash) from '{DATA}/corpus.parquet' group by id").fetchall()
    h = {i: x for i, _, x in rows}
    want = {p for p in brute([(i, t) for i, t, _ in rows], 3, 40, 0.6)[0] if h[p[0]] != h[p[1]]}
    assert {tuple(r) for r in p3_found(spark, DATA).collect()} == want
