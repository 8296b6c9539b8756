import numpy as np
from pyspark.sql import functions as F

from loomstead.llm import languages as L
from loomstead.llm.charlm import CharModels, plain
from loomstead.llm.problem2 import p2_found, rows
from tests.conftest import DATA


def test_models_are_distributions_and_tell_languages():
    m = CharModels({"a": ["abab abab cab"] * 3, "b": ["xyz zyx zzy"] * 3})
    # over all characters that may come next the probabilities sum to one
    for context in (" ", "ab", "xyz", "ca", " xz"):
        logs = []
        for c in list(m.numbers) + ["?"]:
            total, _ = m.scores([context + c])
            logs.append(total[0])
        before = m.scores([context])[0][0]
        assert np.allclose(np.exp(np.array(logs) - before).sum(axis=0), 1, atol=1e-5)
    assert m.scores([plain("abab"), plain("zyx")])[0].argmax(axis=1).tolist() == [0, 1]


def test_labels(spark):
    given = {"English": "en", "EN": "en", "en-US": "en", " zho ": "zh", "pt_BR": "pt", "nl": "nl", "und": None, "n/a": None, "": None, "unknown": None, "Deutsch": "de", None: None}
    df = spark.createDataFrame([(k,) for k in given], "l string")
    assert {r[0]: r[1] for r in df.select("l", L.label_code(F.col("l"))).collect()} == given


def test_prose():
    text = "A title here\n\n## Heading\n```rust\nlet x = 1;\n```\n> A quoted sentence stands here.\nerror[E0001]: no such thing\nMail me at a@b.example please.\n- fragment of list\nhttps://x.example/1\n**Bold heading**\nLast `code` words without stop"
    got = [(p, whole) for _, p, whole in L.sentences(text, True)]
    assert [w for _, w in got] == [True, True, None, False]
    assert got[1][0] == " a quoted sentence stands here " and got[-1][0] == " last words without stop "
    assert L.sentences(None, False) == [] == L.sentences("```\nopen", True)


def test_held_out_accuracy_and_cases(spark):
    m = L.fit(rows(spark, "/root/testdata/sf0.01"))
    assert m.held_accuracy > 0.98 and len(m.languages) == 8
    mixed = "The borrow checker rejects the second call in our build. It never explains the reason for that. Der Compiler verwirft die zweite Anfrage, und niemand weiß warum."
    en = "The borrow checker rejects the second call in our build."
    data = [(1, en, "en", False), (2, en, None, False), (3, en, "fr", False), (4, mixed, "en", False), (5, "LGTM", None, False), (6, "", "en", False), (7, "```\nlet x = 1;\n```", None, False), (8, en, "en", False), (8, en, "en", False)]
    df = spark.createDataFrame(data, "id long, text string, label string, titled boolean")
    assert {tuple(r) for r in L.found(L.row_languages(df, m)).collect()} == {(2, "en"), (3, "en"), (4, "en"), (4, "de")}
    parts = {(r.id, r.language) for r in L.segments(df, m).collect()}
    assert {(4, "en"), (4, "de")} <= parts
    assert L.fit(df.limit(0)) is None


def test_scores_are_a_sentences_own():
    """Equal alone, in a batch, in another order and in blocks."""
    rng = np.random.default_rng(1)
    vocabulary = {"en": "the parser drops a second pass in release mode nobody expects it".split(), "de": "der compiler verwirft die zweite anfrage ohne meldung niemand weiß warum".split()}
    make = lambda l: plain(" ".join(rng.choice(vocabulary[l], rng.integers(1, 12))))
    m = CharModels({l: [make(l) for _ in range(60)] for l in vocabulary})
    texts = [make(l) for l in vocabulary for _ in range(1500)] + [plain("x"), plain("")]
    whole, sizes = m.scores(texts)
    assert sizes.sum() > 60_000  # more than one block
    alone = np.concatenate([m.scores([t])[0] for t in texts])
    order = rng.permutation(len(texts))
    assert np.array_equal(whole, alone) and np.array_equal(m.scores([texts[i] for i in order])[0], whole[order])


def test_rejection_and_labels_of_any_language():
    import random

    rng = random.Random(3)
    words = {"en": "the parser drops second pass release mode nobody expects this cache".split(), "de": "der compiler verwirft zweite anfrage ohne meldung niemand weiß warum".split(), "nl": "de vertaler weigert tweede aanvraag zonder bericht niemand begrijpt waarom".split(), "el": "ο μεταγλωττιστής απορρίπτει δεύτερη κλήση χωρίς μήνυμα κανείς ξέρει γιατί".split()}
    make = lambda l: plain(" ".join(rng.choice(words[l]) for _ in range(rng.randrange(6, 14))))
    rows = [(l, [make(l) for _ in range(3)]) for l in ("en", "de", "nl") for _ in range(120)]
    rows += [("xx", [make(rng.choice(["en", "de"])) for _ in range(3)]) for _ in range(40)]  # a label that names nothing of its own
    rng.shuffle(rows)
    m = L.Identifier(rows)
    assert m.languages == ["de", "en", "nl"] and m.held_accuracy > 0.98
    assert m.held_rejected < 0.01 and np.isfinite(m.limit)
    assert (m.classify([make("el") for _ in range(50)])[0] == -1).mean() > 0.9
    assert (m.classify([make("nl") for _ in range(50)])[0] == 2).mean() > 0.95


def test_very_long_text():
    assert len(L.sentences("word " * 50_000 + ".", False)) == 1


def test_the_tables(spark):
    got = p2_found(spark, DATA).collect()
    assert got and len(set(got)) == len(got)
