"""Cleanup, sentences, lemmas and triples with source places, against plain Python that carries a list of places along."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from textkg.functions import offsets as of
from textkg.functions import tagging as tg
from textkg.functions import text as tx


def cleaned(text):
    """(text, source place of every character)."""
    places = list(range(len(text)))
    for pattern, replacement in tx.CLEANUP_RULES:
        out, kept, last = [], [], 0
        for m in re.finditer(pattern, text):
            out += [text[last : m.start()], replacement]
            kept += places[last : m.start()] + ([places[m.start()]] if replacement else [])
            last = m.end()
        text, places = "".join([*out, text[last:]]), kept + places[last:]
    return text, places


def sentences(text):
    out, last = [], 0
    for m in [*re.finditer(r"[.!?]+\s+|\n+", text), None]:
        end = m.start() if m else len(text)
        if text[last:end].strip(" "):
            out.append((last, text[last:end]))
        last = m.end() if m else end
    return out


def tokens(text):
    return [(m.group(), m.start()) for m in re.finditer(r"[^\W_]+", text)]


def brute(text):
    """Per sentence, the tokens as (word, start, length) in the source."""
    clean, places = cleaned(text)
    out = []
    for start, sentence in sentences(clean):
        found = []
        for word, at in tokens(sentence):
            a, b = places[start + at], places[start + at + len(word) - 1]
            found.append((word.lower(), a, b - a + 1))
        out.append(found)
    return out


def texts():
    rng = random.Random(4)
    parts = ["a", "cells", "binding", "shows", "Drug's", "1", "23", "4.5", "(", ")", " ", " ", " ", ",", "%", "/", ".", "!", "?", "\n", "😀", "é", "of", "ly"]
    fixed = ["", " ", "(", "()", "a (b\nc) d", "x 1 2 3 y", "1,000 (see) 5% ", " 1'2 ", "a. b.  c?! d", "((a)b)c", "don't (x) stop/go. The 3 cats 4.5 ran"]
    return fixed + ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(300)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts())] + [(-1, None)], "doc_id int, text string").repartition(4)


def test_masked_text_is_the_cleaned_text_in_place(docs):
    rows = docs.select("doc_id", "text", of.mask_clean(F.col("text")).alias("m"), tx.clean_text(F.col("text")).alias("c")).collect()
    for r in rows:
        if r.text is None:
            assert r.m is None
            continue
        clean, places = cleaned(r.text)
        assert len(r.m) == len(r.text)
        assert r.m.replace(of.REMOVED, "") == r.c == clean
        assert [i for i, c in enumerate(r.m) if c != of.REMOVED] == places


def test_tokens_and_lemmas_lead_back_to_the_source(docs):
    masked = docs.select("doc_id", "text", of.mask_clean(F.col("text")).alias("m")).where("text IS NOT NULL")
    located = F.transform(of.located_sentences(F.col("m")), lambda s: of.located_tokens(s["text"], s["start"]))
    lemmas = F.transform(of.located_sentences(F.col("m")), lambda s: of.located_lemmas(s["text"], s["start"]))
    for r in masked.select("doc_id", "text", located.alias("t"), lemmas.alias("l")).collect():
        want = brute(r.text)
        assert [[(t.text.replace(of.REMOVED, "").lower(), t.start, len(t.text)) for t in s] for s in r.t] == want
        for found, sentence in zip(r.l, want):
            assert found[-1].lemma == "." and found[-1].pos == "" and found[-1].length == 0
            kept = iter(sentence)
            for p in found[:-1]:
                word = next(w for w in kept if w[1:] == (p.start, p.length))
                assert p.lemma.rstrip("y")[:2] in word[0] or p.lemma == "alzheimers_disease"
                # the mention is the word with what cleanup took out of it
                mention, _ = cleaned(r.text[p.start : p.start + p.length])
                assert mention.lower() == word[0]


def brute_triples(lemmas):
    """Noun run, verb run, noun run over (lemma, pos, start, length)."""
    runs = []
    for p in lemmas:
        if p.pos in ("dt", ""):
            continue
        kind = {"nn": "N", "vb": "V"}.get(p.pos, "X")
        if runs and runs[-1][0] == kind:
            runs[-1][1].append(p)
        else:
            runs.append((kind, [p]))
    parts = [(k, (" ".join(p.lemma for p in r), r[0].start, r[-1].start + r[-1].length - r[0].start)) for k, r in runs]
    return [a[1] + b[1] + c[1] for a, b, c in zip(parts, parts[1:], parts[2:]) if (a[0], b[0], c[0]) == ("N", "V", "N")]


def test_triples_against_plain_python(docs):
    masked = docs.select("doc_id", of.mask_clean(F.col("text")).alias("m"))
    sentence = masked.select("doc_id", F.explode(of.located_sentences(F.col("m"))).alias("s"))
    lemmas = of.located_lemmas(F.col("s.text"), F.col("s.start"))
    rows = sentence.select(lemmas.alias("l"), of.located_triples(lemmas).alias("t")).collect()
    got = [
        (t.subject, t.subject_start, t.subject_length, t.predicate, t.predicate_start, t.predicate_length, t.object, t.object_start, t.object_length)
        for r in rows for t in r.t
    ]
    assert got == [t for r in rows for t in brute_triples(r.l)] and len(got) > 20


def test_running_sums_over_blocks(spark):
    numbers = [(i * 7) % 5 for i in range(700)]
    for n in (0, 1, 255, 256, 257, 700):
        df = spark.createDataFrame([(numbers[:n],)], "n array<int>")
        assert df.select(of.running_sums(F.col("n"))).first()[0] == [sum(numbers[:i]) for i in range(n)]


def test_a_long_text(spark):
    text = "The cell (old) shows 7 drugs, don't ask. " * 1200
    df = spark.createDataFrame([(text,)], "text string").select("text", of.mask_clean(F.col("text")).alias("m"))
    s = df.select("text", F.inline(of.located_sentences(F.col("m"))).alias("sentence", "start"))
    last = s.orderBy(F.desc("start")).first()
    assert s.count() == 1200 and last.start == 41 * 1199
    assert tg.SYNONYMS  # the lemma rules are those of the tagging module
