import collections
import random

import numpy as np
from pyspark.sql import functions as F

from loomstead.functions.text import clean_value
from loomstead.llm import leaks
from loomstead.llm.leaks import Items, Shard, find_leaks, suffix_array, without_leaks
from loomstead.llm.sketches import runs
from loomstead.sources.tables import table
from tests.conftest import DATA


def brute(docs, items, least=12):
    grams = collections.defaultdict(set)
    for i, t in items:
        w = runs(clean_value(t))
        for k in range(len(w) - least + 1):
            grams[tuple(w[k : k + least])].add(i)
    out = set()
    for d, t in docs:
        w = runs(clean_value(t))
        for k in range(len(w) - least + 1):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + least]), ())}
    return out


def test_layout_edges_and_lengths(spark, monkeypatch):
    passage = " ".join(f"w{i}" for i in range(20))
    items = [(1, passage), (2, "x " * 5 + " ".join(f"w{i}" for i in range(3, 16))), (3, "too short"), (4, None), (4, ""), (1, passage)]
    docs = [
        (1, "intro\n" + passage.replace(" ", "  **") + " outro"), (2, " ".join(passage.split()[:11])), (3, None), (4, ""), (5, " ".join(passage.split()[8:]) + " y"),
        (6, passage[:30] + "<!-- gone -->" + passage[30:]), (7, passage + " " + passage), (7, passage + " " + passage), (8, "w0 " * 40), (None, passage),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(9)).withColumn("n_words", F.lit(9))
    i = spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 1): (20, 1), (1, 2): (13, 4), (5, 1): (12, 0), (6, 1): (20, 0), (6, 2): (13, 3), (7, 1): (20, 0), (7, 2): (13, 3)}
    assert {(r.doc_id, r.item_id): (r.n_words, r.at_word) for r in find_leaks(d, i).collect()} == want
    monkeypatch.setattr(leaks, "BLOCK_WORDS", 1)  # one item a pass
    assert {(r.doc_id, r.item_id) for r in find_leaks(d, i).collect()} == set(want)
    assert find_leaks(d, i.limit(0)).count() == 0 == find_leaks(d.limit(0), i).count()
    assert {r.doc_id for r in without_leaks(d.where("doc_id is not null"), find_leaks(d, i)).select("doc_id").collect()} == {2, 3, 4, 8}


def test_a_document_doesnt_run_into_the_next():
    w = [f"w{i}" for i in range(12)]
    assert len(Shard([(1, w[:6]), (2, w[6:])]).search(Items([(1, w)]), 12)) == 0


def longest(doc, item, least):
    best = (0, 0)
    for a in range(len(doc)):
        for b in range(len(item)):
            n = 0
            while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n]:
                n += 1
            best = max(best, (n, -a))
    return (best[0], -best[1]) if best[0] >= least else None


def test_longest_matches_equal_brute_force(monkeypatch):
    """Few different words, so that matches overlap, repeat and nest; steps of a few locations."""
    rng = random.Random(5)
    monkeypatch.setattr(leaks, "STEP", 7)
    for words, least in (("ab", 4), ("abc", 3), ("abcdef", 2)):
        draw = lambda n: [rng.choice(words) for _ in range(rng.randrange(0, n))]
        docs, items = [(10 + k, draw(30)) for k in range(12)], [(k, draw(20)) for k in range(9)] + [(50, ["z"] * 9), (51, [])]
        got = {(r.doc_id, r.item_id): (r.n_words, r.at_word) for r in Shard(docs).search(Items(items), least).itertuples()}
        want = {(d, i): m for d, x in docs for i, y in items if (m := longest(x, y, least))}
        assert got == want


def test_the_array_is_in_order():
    rng = np.random.default_rng(2)
    for kinds in (1, 2, 50):
        docs = [rng.integers(0, kinds, rng.integers(0, 200)) for _ in range(9)]
        tokens = np.concatenate([np.append(x + len(docs), k) for k, x in enumerate(docs)]).astype(np.int32)
        assert suffix_array(tokens).tolist() == sorted(range(len(tokens)), key=lambda k: tokens[k:].tolist())


def test_one_word_over_and_over():
    got = Shard([(1, ["w"] * 20_000), (2, ["w"] * 30)]).search(Items([(7, ["w"] * 300)]), 12)
    assert {(r.doc_id, r.n_words, r.at_word) for r in got.itertuples()} == {(1, 300, 0), (2, 30, 0)}


def test_the_tables(spark):
    d, i = table(spark, DATA, "documents"), table(spark, DATA, "eval_items")
    want = brute([tuple(r) for r in d.select("doc_id", "text").collect()], [tuple(r) for r in i.select("item_id", "text").collect()])
    assert {(r.doc_id, r.item_id) for r in find_leaks(d, i).collect()} == want
