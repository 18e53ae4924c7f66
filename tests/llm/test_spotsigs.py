"""Spot signatures against a plain reading of the definition and of the order of documents."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textkg.llm import queries, spotsigs

SCHEMA = "doc_id long, text string, lang string, n_chars long, part int, place long, id long, fingerprint string"
SF_DIR = "/root/testdata/sf0.001"


def signature_set(fingerprint):
    return {fingerprint[i : i + 16] for i in range(0, len(fingerprint), 16)}


def jaccard(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def row(i, text):
    return (i, text, "x", 1, 2, 3, 4, "f")


def following(rows):
    """Ids fall, rows without id come last; ids are distinct here."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return {a[0]: (a[1] or "", b[1] or "") for a, b in zip(order, order[1:] + order[:1])}


@pytest.mark.parametrize("count", [1, 2, 3, 500])
def test_next_documents(spark, count):
    rng = random.Random(count)
    ids = rng.sample([*range(-200, 800), 2**62, -(2**63), 2**63 - 1, 2**53 + 1, 2**53], count)
    rows = [row(i, rng.choice([None, "", f"text {i} é😀"])) for i in ids]
    if count == 500:
        rows.append(row(None, "nobody"))
    found = spotsigs.next_documents(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert {r.doc_id: (r.text, r.next_text) for r in found} == following(rows) and len(found) == len(rows)


def test_repeated_rows_and_ids_have_one_follower_each(spark):
    rows = [row(i % 5, f"t{i % 3}") for i in range(60)]
    found = spotsigs.next_documents(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(found) == 60
    assert sorted(r.next_text for r in found) == sorted(r[1] for r in rows)
    # an id is followed by itself or by the next lower one
    texts = {i: {r[1] for r in rows if r[0] == i} for i in range(5)}
    assert all(r.next_text in texts[r.doc_id] | texts[(r.doc_id - 1) % 5] for r in found)


def test_query_against_the_definition(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op13_spot_signatures"](spark, SF_DIR).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    pairs = following(docs)
    assert len(found) == len(docs)
    for i, (text, after) in pairs.items():
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        r = found[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other = signature_set(r.fingerprint), signature_set(r.edited_fingerprint)
        assert own == {f"{x:016x}" for x in spotsigs.signatures(text)}
        assert other == {f"{x:016x}" for x in spotsigs.signatures(edited)}
        assert r.near_edited == jaccard(own, other)
        assert r.near_next == jaccard(own, {f"{x:016x}" for x in spotsigs.signatures(after)})
    long = [r for r in found.values() if r.n_chars > 600]
    assert np.mean([r.near_edited for r in long]) > 0.4 > 0.1 > np.mean([r.near_next for r in long])


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert spotsigs.next_documents(none).count() == 0
    assert spotsigs.near_duplicates(none).count() == 0


def test_signatures_by_hand():
    def sigs(*chains):
        return {spotsigs.xxhash.xxh64_intdigest(c.encode()) for c in chains}

    assert spotsigs.signatures("Red cats, the big dog of my house ran") == sigs(
        " red cats big", " cats big dog", "the big dog my", "of my house ran"
    )
    assert spotsigs.signatures("red cats") == spotsigs.signatures("RED, cats!") != set()
    for empty in (None, "", " .,; ", "\x00"):
        assert spotsigs.signatures(empty) == set()
    assert len(spotsigs.signatures("日本語" * 40)) == 3
    assert len(spotsigs.signatures("ab" * 20_000)) == 2 and spotsigs.signatures("a") != spotsigs.signatures("b")


def test_an_edit_changes_only_signatures_near_it():
    rng = random.Random(2)
    words = [rng.choice(["the", "of", "und", *[f"w{k}" for k in range(500)]]) if k % 4 else "the" for k in range(400)]
    other = words.copy()
    other[200] = "changed"
    a, b = (spotsigs.signatures(" ".join(w)) for w in (words, other))
    assert 0.95 < jaccard(a, b) < 1


def test_likeness_is_pruned_by_length():
    a, b = np.arange(10, dtype=np.uint64), np.arange(4, dtype=np.uint64)
    none = np.zeros(0, np.uint64)
    assert spotsigs.likeness(a, b) == 0.4 and spotsigs.likeness(a, b, 0.5) == 0.0
    assert spotsigs.likeness(none, none) == 1.0 and spotsigs.likeness(a, none) == 0.0


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(9)
    texts = [None, "", "?", "one two", "one two"]
    for _ in range(40):
        base = [rng.choice(["the", "of", "a"]) if k % 3 == 0 else f"w{rng.randrange(60)}" for k in range(rng.randrange(8, 90))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            copy = base.copy()
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(60)}"
            texts.append(" ".join(copy[: len(copy) - rng.randrange(6)]))
    docs = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)] + [row(None, texts[9])], SCHEMA).repartition(5)
    sets = [spotsigs.signatures(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = 0
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or (sets[i] and jaccard(sets[i], sets[j]) >= 0.75):
                links += bool(sets[i]) and sets[i] != sets[j]
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    found = spotsigs.near_duplicates(docs).collect()
    assert links > 10 and len(found) == len(texts) + 1
    assert {r.doc_id: r.class_id for r in found if r.doc_id is not None} == {i: root(i) for i in range(len(texts))}
    pairs = spotsigs.similar_pairs(
        spotsigs.fingerprint_texts(docs.where("doc_id IS NOT NULL"), {"text": "fingerprint"}, ["doc_id"])
        .groupBy("fingerprint").agg(F.min("doc_id").alias("id"))
    )
    assert pairs.count() == pairs.distinct().count() == len(
        {tuple(sorted((min(k for k in range(len(texts)) if sets[k] == sets[x]) for x in (i, j))))
         for i in range(len(texts)) for j in range(i) if sets[i] != sets[j] and sets[i] and jaccard(sets[i], sets[j]) >= 0.75}
    )
