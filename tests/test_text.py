import random
import unicodedata

from pyspark.sql import functions as F

from loomstead.functions import text as X


def rules(v):
    """The cleaning once more, by Python's own idea of lines and white space."""
    import re

    v = unicodedata.normalize("NFKC", v or "").replace("\r\n", "\n").replace("\r", "\n")
    v = re.sub("[​‌‍﻿]", "", re.sub(r"(?s)<!--.*?-->", "", v))
    return re.sub("\n{3,}", "\n\n", "\n".join(x.rstrip() for x in v.splitlines())).strip()


def test_cleaning_matches_the_rules_on_adversarial_texts(spark):
    rng = random.Random(3)
    pieces = ["a", "é", "中", "\r\n", "\r", "\n", "\n\n\n", " ", "\t", "<!--", "-->", "​", "﻿", "\x0b", "\x1c", "\x85", " ", "　", "＜!--", "ﬁ", " ", "\x1f", "```"]
    texts = [None, ""] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for i, got in df.select("i", X.clean_text(F.col("t"))).collect():
        assert got == rules(texts[i]) == X.clean_value(texts[i]), repr(texts[i])


def test_comments_go_before_invisible_characters(spark):
    assert X.clean_value("<!-​- x -->") == "<!-- x -->"
    assert X.clean_value("  a​ \r\n<!-- gone -->\r\n\n\n\nb  ") == "a\n\nb"


def test_language_tag_at_its_limits(spark):
    rows = {"aaaaa中": "zh", "aaaaaa中": "en", "привет": "unknown", "": "unknown", "ひらがな": "unknown", "Grüße": "en", "中": "zh"}
    df = spark.createDataFrame([(k,) for k in rows], "t string")
    assert {r[0]: r[1] for r in df.select("t", X.language_tag(F.col("t"))).collect()} == rows


def test_hash_inputs_and_urls(spark):
    df = spark.createDataFrame([(None, None, None, "https://h/a/issues/12"), ("", "", "x", "https://h/a/pulls/7/"), ("c", "t", "中", None)], "c string, t string, g string, u string")
    r = df.select(X.content_hash(F.col("c"), F.col("t")).alias("h"), X.model_input(F.col("c"), F.lit("T")).alias("m"), X.number_in_url(F.col("u")).alias("n"), X.paragraphs(F.col("t"), F.col("g")).alias("p")).collect()
    assert r[0].h == r[1].h != r[2].h
    assert r[0].m == "[CONTEXT]\n(none)\n\n[TARGET]\nT"
    assert [x.n for x in r] == [12, None, None]
    assert [x.p for x in r] == ["", "x", "t\n\n中"]


def test_long_runs_of_blanks_are_cheap(spark):
    assert X.clean_value(" " * 200_000 + "x" + " " * 200_000 + "y") == "x" + " " * 200_000 + "y"
