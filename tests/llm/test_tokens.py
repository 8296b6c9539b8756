import random

import pytest
from pyspark.sql import functions as F

from loomstead.llm.tokens import FOLDER, decode, encode, merge, merge_pairs, read_ranks
from loomstead.sources.tables import table
from tests.conftest import DATA

tokenizers = pytest.importorskip("tokenizers")


def reference():
    t = tokenizers.Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def test_texts_of_all_sorts_and_back(spark):
    rng = random.Random(2)
    odd = ["", " ", "\n\n  x", "it's WE'LL 'tis", "日本語のテキスト、長い", "émoji 🦀🦀 <|endoftext|>", "a b　c\x85d", "=" * 700, "9" * 50, "x" * 3000, "Грамматика", "\t\t\tif (a) {\r\n}"]
    odd += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x500), rng.randrange(0x4E00, 0x4F00), 0x1F600, 10, 32])) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(odd)] + [(1000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("ids", F.lit(1))
    want = reference()
    got = encode(df)
    ids = {r.doc_id: r.ids for r in got.collect()}
    assert ids == {i: want(t) for i, t in rows}
    assert {r.doc_id: r.decoded for r in decode(got).collect()} == {i: t or "" for i, t in rows}
    assert encode(df.limit(0)).count() == 0


def test_every_piece_merges_to_itself():
    """So a word that is a piece needs no merges, and each piece is made of just one pair of parts."""
    for name in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        ranks = read_ranks(name)
        assert all(merge(p, ranks) == [p] for p in ranks)
        pairs = merge_pairs(name)
        assert len(pairs) == len(set(pairs.values())) == sum(len(p) > 1 for p in ranks)


def test_folds_and_the_heap_agree(spark, monkeypatch):
    from loomstead.llm import tokens

    rng = random.Random(8)
    texts = ["".join(rng.choice(a) for _ in range(n)) for a in ("abcde", "=-", "éñ日本", "aA") for n in (1, 2, 7, 60, 90, 150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one = {r.doc_id: r.ids for r in encode(df).collect()}
    monkeypatch.setattr(tokens, "LONG_BYTES", 0)
    assert {r.doc_id: r.ids for r in encode(df).collect()} == one


def test_the_tables(spark):
    want = reference()
    docs = table(spark, DATA, "documents")
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert all(r.ids == want(text[r.doc_id]) for r in encode(docs).collect())
