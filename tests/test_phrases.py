"""Annotation with terms of several words, against a scan of every place."""

from __future__ import annotations

import random

import pytest
from conftest import rows

from textkg.operators import phrases as ph

DOCS = "doc_id int, words array<string>"
TERMS = "words array<string>"


def brute(words, terms):
    """Leftmost longest, without overlaps."""
    out, at = [], 0
    while at < len(words):
        fits = [n for n in range(1, 7) if at + n <= len(words) and tuple(words[at : at + n]) in terms]
        if fits:
            out.append((at, max(fits), " ".join(words[at : at + max(fits)])))
            at += max(fits)
        else:
            at += 1
    return out


@pytest.mark.parametrize("shuffled", [False, True])
def test_against_a_scan(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(ph, "broadcast_if_small", lambda df: df)
    rng = random.Random(8)
    vocabulary = ["the", "of", "cell", "gene", "é", "risk"]
    terms = {tuple(rng.choices(vocabulary, k=rng.randrange(1, 7))) for _ in range(60)}
    terms = {t for t in terms if t not in {("the",), ("of",)}}
    texts = [rng.choices([*vocabulary, "other"], k=rng.randrange(0, 60)) for _ in range(60)] + [[], ["cell"], ["the"] * 40, None]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)
    given = [(list(t),) for t in terms] * 2 + [([],), (None,), ([None],)]
    found = rows(ph.annotate_phrases(docs, spark.createDataFrame(given, TERMS)))
    want = sorted((i, *hit) for i, words in enumerate(texts) for hit in brute(words or [], terms))
    assert found == want and {r[2] for r in found} >= {1, 2, 3}


def test_a_path_that_breaks_off_keeps_its_shorter_term(spark):
    terms = [(["new", "york", "times", "square"],), (["new", "york"],), (["times"],), (["york", "times"],)]
    docs = spark.createDataFrame([(1, "new york times in new york times square".split())], DOCS)
    assert rows(ph.annotate_phrases(docs, spark.createDataFrame(terms, TERMS))) == [
        (1, 0, 2, "new york"), (1, 2, 1, "times"), (1, 4, 4, "new york times square"),
    ]


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, ["a"])], DOCS)
    none = spark.createDataFrame([], TERMS)
    assert ph.annotate_phrases(docs, none).count() == 0
    assert ph.annotate_phrases(docs.limit(0), spark.createDataFrame([(["a"],)], TERMS)).count() == 0


def test_trie_has_one_edge_per_prefix(spark):
    terms = spark.createDataFrame([(["a", "b"],), (["a", "b", "c"],), (["a", "d"],)], TERMS)
    assert sorted((r.depth, r.node, r.token, r.term or "") for r in ph.term_trie(terms).collect()) == [
        (1, "", "a", ""), (2, "a", "b", "a b"), (2, "a", "d", "a d"), (3, "a b", "c", "a b c"),
    ]
