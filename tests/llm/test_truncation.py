import random

from pyspark.sql import functions as F

from loomstead.llm.problem8 import p8_found, p8_report
from loomstead.llm.truncation import cut_report, find_cuts, length_spikes, uses_beginning_with
from loomstead.sources.shared import Cuts
from tests.conftest import DATA

SENTENCES = ["The parser drops the second pass in release mode.", "Nobody expects the cache to leak on two laptops.", "We should move the field order out of the loop.", "Der Compiler verwirft die zweite Anfrage ohne Meldung."]


def corpus(limit=200):
    rng = random.Random(4)
    out = []
    for i in range(400):
        text = f"Case {i}. " + " ".join(rng.choice(SENTENCES) for _ in range(rng.randrange(1, 9)))
        out.append((i, "a" if i % 2 else "b", text[:limit] if i % 2 else text))
    return out


def test_a_limit_shows_as_a_spike(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    spikes = {(r.source, r.unit, r.length) for r in length_spikes(df).collect()}
    assert {("a", "chars", 200), ("a", "bytes", 200)} <= spikes
    got = {r.doc_id for r in find_cuts(df).collect()}
    cut = {i for i, s, t in rows if s == "a" and len(t) == 200 and not t.endswith(".")}
    assert len(cut) > 60 and cut <= got and len(got - cut) <= 2
    report = {r.source: r for r in cut_report(df, find_cuts(df)).collect()}
    assert report["b"].n_cut <= 2 and report["a"].n_texts == 200


def test_ends(spark):
    base = corpus(10**6)
    whole = ["Thanks", "It works.\n\n```rust\nlet x = 1;\n```", "It works. 🦀", "It works!\n\n-- \nann", "See:\n\nhttps://x.example/pull/12", "It works.\n<!-- note -->", "ok :)", "Done.\n\nRegards,\nAnn Berg", "完成了。"]
    cut = ["It works.\n\n```rust\nlet x = 1;", "The parser drops the `sec", "The parser drops the", "We should mo [...]", "The cache (message truncated)", "See https://x.example/pu", "Nobody expects,", "It works.\n<!-- please ke", "The parser drops the second pa�"]
    rows = base + [(1000 + i, "b", t) for i, t in enumerate(whole)] + [(2000 + i, "b", t) for i, t in enumerate(cut)] + [(3000, "b", None), (3001, "b", ""), (3002, "b", " \n​"), (3003, None, "The parser drops the"), (3003, None, "The parser drops the"), (None, "b", "The parser drops the")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(1))
    got = {r.doc_id: r.reason for r in find_cuts(df).collect()}
    assert {i for i in got if i >= 1000} == {2000 + i for i in range(len(cut))} | {3003}
    assert find_cuts(df.limit(0)).count() == 0


def test_copies_of_a_cut_text(spark):
    """However often a text cut in a word is delivered, it stays cut."""
    cut = "The parser drops the second pa"
    rows = corpus(10**6) + [(2000 + i, "b", cut) for i in range(200)]
    got = {r.doc_id for r in find_cuts(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert {i for i in got if i >= 2000} == set(range(2000, 2200))


def test_lines_with_dots(spark):
    """Copies of a cut text, or a few texts in many with the same cut line, are no phrase; a line that many texts share is."""
    line = "The parser drops the sec…"
    rows = [(10**6 + i, "a", f"It is.\n\n{line}") for i in range(9)] + [(2 * 10**6 + i, "a", f"{'So ' * i}it was.\n\n{line}") for i in range(9)]
    rows += [(3 * 10**6 + i, "a", f"{'So ' * i}it is odd.\n\nno idea why...") for i in range(30)]
    schema = "doc_id long, source string, text string"
    many = spark.range(40_000).selectExpr("id as doc_id", "'a' as source", "concat('Case ', id, if(id % 50 = 0, repeat(' or second pass', 20), ''), '.') as text")
    few = spark.createDataFrame(rows[:9] + rows[18:], schema).unionByName(many.limit(100))
    assert {r.doc_id // 10**6 for r in find_cuts(few).collect()} == {1} and find_cuts(few).count() == 9
    assert {r.doc_id for r in find_cuts(spark.createDataFrame(rows, schema).unionByName(many)).collect()} == {r[0] for r in rows[:18]}


def test_long_texts(spark):
    df = spark.createDataFrame([(1, "a", "word " * 60_000 + "end."), (2, "a", " " * 200_000 + "x.")], "doc_id long, source string, text string")
    assert find_cuts(df).count() == 0


def test_the_tables(spark):
    got = p8_found(spark, DATA).collect()
    assert got and len(set(got)) == len(got)
    assert sum(r.n_cut for r in p8_report(spark, DATA).collect()) == len(got)


def test_one_very_long_word(spark):
    """Words of a million letters, cut and whole, cost no more than their length."""
    word = "ab" * 500_000
    rows = corpus(10**6)[:40] + [(9000, "a", f"It keeps {word}"), (9001, "a", f"It keeps {word}c on."), (9002, "a", f"We saw {word} too."), (9003, "a", "x " + "QUJD" * 250_000 + " works.")]
    got = {r.doc_id for r in find_cuts(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert got == {9000}


def test_uses_against_brute_force(spark):
    rng = random.Random(2)
    every = ["".join(rng.choice("abé") for _ in range(rng.randrange(1, 6))) for _ in range(400)] + ["错", "错误", "错误们"]
    uses = {w: (rng.randrange(1, 9), rng.randrange(0, 2)) for w in every}
    wanted = sorted({w[: rng.randrange(1, 4)] for w in every} | {"zz", "错"})
    u = spark.createDataFrame([(w, n, e) for w, (n, e) in uses.items()], "word string, n long, n_end long")
    got = {r.word: (r.n, r.n_word, r.n_end) for r in uses_beginning_with(u, spark.createDataFrame([(w,) for w in wanted], "word string"), Cuts(spark, "t")).collect()}
    for w in wanted:
        alike = [w] if w[0] == "错" else [x for x in uses if x.startswith(w)]
        own = uses.get(w, (0, 0))
        assert got[w] == (sum(uses.get(x, (0, 0))[0] for x in alike), *own), w


def test_a_limit_that_was_changed(spark):
    """A spike below longer texts of the same months is no limit; a limit of former months is one."""
    rng = random.Random(6)
    rows = []
    for i in range(1200):
        size, month = rng.randrange(30, 400), 1 + i % 12
        limit = 150 if month < 7 else 250
        text = (f"Case {i} is " + "odd and so on " * 40)[: min(size, limit)]
        rows.append((i, "a", text, f"2024-{month:02d}-10 00:00:00"))
    rows += [(2000 + i, "a", f"Row {i:04d} of the table, which is always as wide as this.", f"2024-{1 + i % 12:02d}-11 00:00:00") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, t string").withColumn("created_at", F.col("t").cast("timestamp"))
    assert {r.length for r in length_spikes(df).collect()} == {150, 250}
    assert {r.length for r in length_spikes(df.drop("created_at")).collect()} == {250}
