from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from textkg.functions import chunking as ck
from textkg.functions import tagging as tg
from textkg.functions import text as tx


def one(spark, column, **values):
    schema = ", ".join(
        f"{k} {'array<string>' if isinstance(x, list) else 'string'}" for k, x in values.items()
    )
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "text, cleaned",
    [
        ("risk (see 1) of a/b", "risk  of a b"),
        ("it's 5%, yes", "its yes"),
        ("had 12 cases", "had cases"),
        ("dose 1.5 mg", "dose mg"),
        ("", ""),
    ],
)
def test_clean_text(spark, text, cleaned):
    assert one(spark, tx.clean_text(F.col("t")), t=text) == cleaned


def test_sentences_and_tokens(spark):
    assert one(spark, tx.sentences(F.col("t")), t="One two. Three!  \n\nFour? 5") == ["One two", "Three", "Four", "5"]
    assert one(spark, tx.tokens(F.col("t")), t="Ünder-score x1, (Y)") == ["ünder", "score", "x1", "y"]
    assert one(spark, tx.tokens(F.col("t")), t=" .. ") == []
    assert one(spark, tx.space_tokens(F.col("t")), t="a  b c  ") == ["a", "", "b", "c"]


@pytest.mark.parametrize("n_words", [0, 1, 2, 3, 7])
@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngram_law(spark, n_words, n):
    words = [f"w{i}" for i in range(n_words)]
    grams = one(spark, tx.ngrams(F.col("w"), n), w=words)
    assert len(grams) == (max(n_words - n + 1, 1) if n_words else 0)
    if n_words >= n:
        assert grams == [" ".join(words[i : i + n]) for i in range(n_words - n + 1)]
    elif n_words:
        assert grams == [" ".join(words)]
    assert len(one(spark, tx.ngrams(F.col("w"), n, strict=True), w=words)) == max(n_words - n + 1, 0)


def test_ngrams_up_to(spark):
    words = "a tug and a tug".split()
    want = words + ["a tug", "tug and", "and a", "a tug"] + ["a tug and", "tug and a", "and a tug"]
    assert one(spark, tx.ngrams_up_to(F.col("w"), 3), w=words) == want


def test_counted(spark):
    got = one(spark, tx.counted(F.col("w")), w=["b", "a", "b", "c", "b"])
    assert [tuple(r) for r in got] == [("a", 1), ("b", 3), ("c", 1)]
    assert one(spark, tx.counted(F.col("w")), w=[]) == []


@pytest.mark.parametrize(
    "phrase, kept, camel",
    [
        ("risk of the disease", "risk disease", "risk_Of_The_Disease"),
        ("of", "of", "of"),
        ("plain.", "plain.", "plain."),
        ("of the", "", "of_The"),
        ("vitamin d St. John", "vitamin d St. John", "vitamin_d_St_John"),
        ("der ßa", "der ßa", "der_ßa"),
    ],
)
def test_phrases(spark, phrase, kept, camel):
    assert one(spark, tx.phrase_without(F.col("p")), p=phrase) == kept
    assert one(spark, tx.to_camel_case(F.col("p")), p=phrase) == camel


def test_tags_and_lemmas(spark):
    words = "the studies was testing s needs ad quickly glass".split()
    got = [tuple(r) for r in one(spark, tg.lemmas(F.col("w")), w=words)]
    assert got == [
        ("the", "dt"), ("study", "nn"), ("was", "vb"), ("test", "vb"), ("need", "nn"),
        ("alzheimers_disease", "nn"), ("quickly", "rb"), ("glass", "nn"),
    ]


def test_dictionary_goes_before_rules(spark):
    t = spark.createDataFrame([("mice",), ("needs",)], "surface string")
    d = spark.createDataFrame([("mice", "mouse", "nns")], "surface string, lemma string, pos string")
    assert rows(tg.with_dictionary(t, d)) == [("mice", "mouse", "nns"), ("needs", "need", "nn")]


DT = set(tg.DETERMINERS)
VB = set(tg.AUXILIARIES)


def brute_candidates(words):
    def kind(w):
        if w in VB or w.endswith(("ing", "ed")):
            return "V"
        return "X" if w.endswith("ly") else "N"

    chunks = []
    for w in words:
        if w in DT:
            continue
        if chunks and chunks[-1][0] == kind(w):
            chunks[-1][1].append(w)
        else:
            chunks.append([kind(w), [w]])
    text = [(k, " ".join(ws)) for k, ws in chunks]
    return [
        (a[1], b[1], c[1]) for a, b, c in zip(text, text[1:], text[2:]) if (a[0], b[0], c[0]) == ("N", "V", "N")
    ]


def brute_longest(found):
    best = ("", "", "")
    for t in found:
        if len(best[0]) <= len(t[0]) and len(best[2]) < len(t[2]):
            best = t
    return best


def test_chunker_against_plain_python(spark):
    rng = random.Random(7)
    pool = "the cell gene of is was binding linked quickly risk mouse and shows tested badly drug".split()
    sentences = [[rng.choice(pool) for _ in range(rng.randint(0, 25))] for _ in range(200)] + [[], ["cell"]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sentences)], "i int, w array<string>")
    found = df.select("i", ck.candidates(F.col("w")).alias("f")).select("i", "f", ck.longest(F.col("f")).alias("b"))
    for r in found.collect():
        want = brute_candidates(sentences[r.i])
        assert [tuple(t) for t in r.f] == want
        assert tuple(r.b) == brute_longest(want)
