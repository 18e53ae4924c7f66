"""The context tree beside its base, and without a bound on its nodes."""

import math
import random
import zlib

import pytest

from textkg.llm import ctw
from textkg.llm.common import lower_words

SCHEMA = "doc_id long, text string"


def _held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(60):
        letters = "qxzjkvw" if _held_out(i) else "etaoinsh"  # held-out texts spell words that the tree has never met
        out.append((i, " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(30))))
    return out + [(60, None), (61, "")]


def test_scores_of_unknown_words_stay_near_the_base(spark, rows):
    got = ctw.score_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and any(r.held_out and r.tree_score < 1.5 * r.base_score for r in got)
    for r in got:
        mixed = max(r.base_score, r.tree_score) + math.log10((1 + 10 ** -abs(r.base_score - r.tree_score)) / 2)
        assert math.isfinite(r.score) and r.score == pytest.approx(mixed) and r.score >= r.base_score - 0.302


def test_strings_beyond_the_frequent_ones_are_scored_the_same(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    model = ctw.train(docs.where("crc32(cast(cast(doc_id AS string) AS binary)) % 7 <> 2"))
    streams = {i: b"\n" * ctw.DEPTH + b" ".join(lower_words(t)) + b"\n" for i, t in rows}
    strings = {
        i: [int.from_bytes(s[a - ctw.DEPTH : a][::-1] + s[a : a + 1], "big") for a in range(ctw.DEPTH, len(s))] for i, s in streams.items()
    }
    flat = [x for found in strings.values() for x in found]
    value = dict(zip(flat, ctw.log10_of_strings(model, flat)))
    want = {i: sum(value[x] for x in found) for i, found in strings.items()}
    for top in (0, 40, 1 << 21):
        got = {r.doc_id: r.tree_score for r in ctw.score_documents(docs, top_strings=top).collect()}
        assert got == pytest.approx(want)


def test_nothing_to_learn_from(spark):
    held = [i for i in range(60) if _held_out(i)][:2]
    got = ctw.score_documents(spark.createDataFrame([(held[0], "ab c"), (held[1], None)], SCHEMA)).collect()
    assert sorted(r.tree_score for r in got) == pytest.approx([5 * 8 * math.log10(0.5), 8 * math.log10(0.5)])
    assert ctw.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
