import collections

from pyspark.sql import functions as F

from loomstead.llm.personal import find_personal, mentions, normalise, redact
from loomstead.llm.problem4 import p4_found, p4_redacted, rows
from tests.conftest import DATA


def kinds(text):
    return collections.Counter((m[0], text[m[1] : m[2]]) for m in mentions(normalise(text)) if m[3])


def test_seeds_and_decoys():
    assert kinds("Mail a.b+c@x.example or mailto:d@y.org, d (at) y.org") == {("email", "a.b+c@x.example"): 1, ("email", "mailto:d@y.org"): 1}
    assert not kinds("git@forge.example:a/b.git pkg@1.2.3 cc @someone https://u@h.example/x 192.0.2.1:80")
    assert kinds("Call +44 20 7946 0254 or (212) 555-0117.") == {("phone", "+44 20 7946 0254"): 1, ("phone", "(212) 555-0117"): 1}
    assert kinds("at Flat 5, 12 Tannery Lane, Brackenford") == {("address", "Flat 5, 12 Tannery Lane, Brackenford"): 1}
    assert kinds("Hafenstraße 42, 00891 Norrbeck") == {("address", "Hafenstraße 42, 00891 Norrbeck"): 1}
    assert kinds("2097 Heron St.\nWestmarrow 00382") == {("address", "2097 Heron St.\nWestmarrow 00382"): 1}
    assert kinds("Dr. Skell-Loth asked") == {("name", "Dr. Skell-Loth"): 1}
    assert kinds("leaked SSN 998-15-6879 of") == {("id_number", "998-15-6879"): 1}


def test_contexts_find_what_seeds_dont(spark):
    names = ["Ann Berg", "Bob Holm", "Cleo Vist", "Dan Mark"]
    text = [f"Signed-off-by: {n} <x{i}@m.example>" for i, n in enumerate(names * 3)] + [f"The dump leaked key SSN 998-15-687{i} of them." for i in range(8)]
    text += [f"My number is +1 212 555 01{i:02d}." for i in range(8)]
    hidden = ["Reported on behalf of Ann Newell.", "The dump leaked key card AB 1234567 of them.", "My number is 212.555.0199.", "Timing was 212.555.0199 cycles.", "The Parser fails."] + [f"Timing was 212.555.01{i}9 cycles." for i in range(3)]
    df = spark.createDataFrame([("t", i, x) for i, x in enumerate(text + hidden)] + [("t", 0, text[0]), ("t", None, "a@b.example"), ("t", 99, None), ("t", 98, "")], "table_name string, record_id long, text string").withColumn("kind", F.lit(1)).withColumn("l", F.lit(1))
    found = find_personal(df)
    got = {(r.record_id, r.kind) for r in found.collect() if r.record_id >= len(text)}
    n = len(text)
    assert got == {(n, "name"), (n + 1, "id_number"), (n + 2, "phone")}
    clean = {r.record_id: r.text for r in redact(df, found).collect()}
    assert clean[n] == "Reported on behalf of [NAME_1]." and clean[0] == "Signed-off-by: [NAME_1] <[EMAIL_1]>" and clean[98] == ""
    assert find_personal(df.limit(0)).count() == 0


def test_the_graph_judges_addresses(spark):
    """Kinds of streets are learnt from addresses with a postal code; other numbers after or before a name stay."""
    sure = [f"Ship it to {n} Elm Wynd, Borrowick {10000 + n} please." for n in range(11, 21)] + [f"Der Kurier fand Lindenpfad {n}, {20000 + n} Norrbeck nicht." for n in range(11, 21)]
    open_ = ["We met at 31 Oak Wynd again.", "Treffpunkt ist Eichenpfad 7 heute."]
    decoys = ["We met at 31 New Reviewers again.", "See Version 7 today."] + [f"It fails in Chapter {n} too." for n in range(9)]
    df = spark.createDataFrame([("t", i, x) for i, x in enumerate(sure + open_ + decoys)], "table_name string, record_id long, text string")
    judged = {r.record_id for r in find_personal(df).where("kind = 'address'").collect()}
    assert judged == set(range(22))
    assert {r.record_id for r in find_personal(df, rounds=0).where("kind = 'address'").collect()} == set(range(20))


def test_copies_of_a_text_count_once(spark):
    names = [("Ann Berg", 0), ("Bob Holm", 1), ("Cleo Vist", 2), ("Dan Mark", 3)]
    text = [f"Reported by {n} <x{i}@m.example>" for n, i in names] + ["Reported by Release Notes today."] * 200 + ["Reported by Eve Sand."]
    df = spark.createDataFrame([("t", i, x) for i, x in enumerate(text)], "table_name string, record_id long, text string")
    assert {r.record_id for r in find_personal(df).where("kind = 'name'").collect()} >= {0, 1, 2, 3, len(text) - 1}


def test_contexts_are_whole():
    """However long the words, the line or the sentence are."""
    from loomstead.llm.personal import _head, _left, _right, _sentences

    long = "w" * 500
    assert _left(f"x {long} {long} 1", 1003) == f"{long} {long}" and _right(f"1 {long} {long} z", 1) == f"{long} {long}"
    t = "One. Two three four " + "five " * 100 + "6"
    assert _head(t, len(t) - 1, _sentences(t)) == "two three four" and _head("A b 1", 4, [0]) is None
    assert _left("a\nb 1", 4) == "b" and _right("1 b\nc", 1) == "b"


def test_long_text_and_the_tables(spark):
    assert mentions("x" * 200_000) == [] and len(mentions("1 " * 20_000)) < 10
    got = p4_found(spark, DATA).collect()
    assert len(set(got)) == len(got) and {r.kind for r in got} >= {"email", "phone"}
    assert p4_redacted(spark, DATA).count() == rows(spark, DATA).where("text is not null").select("table_name", "record_id").distinct().count()
