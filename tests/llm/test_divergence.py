"""The source audit against a plain count, and its transducer against a dictionary."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from textkg.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string, n long, value long, rank int, position long, tile int"


def brute(rows, min_docs=3, top=200):
    terms = lambda t: [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
                       for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t or "")]
    df, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        lang, source = r[2] or "", r[3] or ""
        sources[lang].add(source)
        df[lang].update(set(terms(r[1])))
        counts[lang, source].update(terms(r[1]))
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        v = len(kept)

        def p_of(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 1) // (total + v) for t in kept}

        whole = sum((counts[lang, s] for s in names), Counter())
        q = p_of(whole)
        p = {s: p_of(counts[lang, s]) for s in names}
        for s in names:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in names if o != s]
            marked = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", marked)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, x, k) for k, (x, i) in enumerate(found, 1) if part == "pair" or k <= top]
    return sorted(out)


def corpus():
    rng = random.Random(11)
    words = ["the", "The", "é", "É", "日本", "a1b", "don't", "x" * 3000, "ſ", "K"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(9)]
    rows = []
    for i in range(90):
        lang = rng.choice(["en", "en", "fr", None, ""])
        text = rng.choice([None, "", "  ..", "\x00\t"]) if i % 11 == 0 else " ".join(rng.choices(words, k=rng.randrange(1, 60)))
        rows.append((i, text, lang, rng.choice(["s1", "s2", "s3", None, "Š", "s10"]), 1, 2, 3, 4, 5))
    rows += rows[:5] * 3
    rows += [(500, None, "only", "one", 1, 2, 3, 4, 5), (501, "", "bare", "one", 1, 2, 3, 4, 5), (502, "once", "bare", "two", 1, 2, 3, 4, 5)]
    return rows


def collected(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


@pytest.mark.parametrize(
    "parameters",
    [{}, {"bucket_terms": 5, "share_entries": 10, "block_terms": 7, "tile_sources": 2}, {"top_terms": 3, "min_docs": 1}],
)
def test_against_plain_counts(spark, parameters):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    want = brute(rows, parameters.get("min_docs", 3), parameters.get("top_terms", 200))
    assert collected(dv.audit_sources(docs, **parameters)) == want


def test_no_rows(spark):
    assert dv.audit_sources(spark.createDataFrame([], SCHEMA)).count() == 0


def test_columns_and_types(spark):
    found = dv.audit_sources(spark.createDataFrame(corpus(), SCHEMA))
    assert found.dtypes == [
        ("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int"),
    ]


def test_transducer_ranks_and_size():
    rng = random.Random(5)
    terms = sorted({bytes(rng.choices(b"ab\xc3\xa9z", k=rng.randrange(1, 9))) for _ in range(3000)} | {b"q" * 50_000})
    machine = dv.Transducer(terms)
    asked = terms + [bytes(rng.choices(b"ab\xc3\xa9zy", k=rng.randrange(0, 10))) for _ in range(2000)] + [b"q" * 49_999, b"q" * 50_001]
    rank = {t: i for i, t in enumerate(terms)}
    raw = np.frombuffer(b"".join(asked), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in asked])])
    assert machine.ranks(raw, bounds).tolist() == [rank.get(t, -1) for t in asked]
    # minimal: no two states have the same continuations
    rights: dict[frozenset, int] = {}

    def right(state, depth=0):
        lo, hi = np.searchsorted(small.keys, [state << 8, (state + 1) << 8])
        out = {b""} if small.finals[state] else set()
        for k in range(lo, hi):
            out |= {bytes([small.keys[k] & 255]) + r for r in right(small.targets[k])}
        return out

    small = dv.Transducer(sorted([b"tap", b"taps", b"top", b"tops", b"stop", b"stops"]))
    for state in range(len(small.finals)):
        key = frozenset(right(state))
        assert key not in rights
        rights[key] = state
    assert dv.Transducer([]).ranks(raw, bounds).tolist() == [-1] * len(asked)


def test_counts_beyond_a_machine_word(spark):
    """Probabilities stay exact where SCALE times a count has more than 64 bits."""
    from pyspark.sql import functions as F

    count, total = 3 * 10**12 + 7, 7 * 10**15 + 11
    row = spark.range(1).select(
        dv._probability(F.lit(count), F.lit(total), F.lit(5)).alias("p"), dv._probability(F.lit(0), F.lit(0), F.lit(1)).alias("one")
    ).first()
    assert (row.p, row.one) == (1 + 10**9 * (count + 1) // (total + 5), 1 + 10**9)
