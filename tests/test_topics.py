"""Vocabulary, vectors, topics and the registry of kept tables."""

from __future__ import annotations

import hashlib
import math
import time
from collections import Counter
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from textkg.operators import topics as tp
from textkg.registry import fingerprint, kept_table
from textkg.session import cut_lineage, reclaim, shared_dir

TEXTS = ["cell gene cell protein", "gene protein cell", "court law judge", "law court trial judge law", "", "é é", "cell court"]


@pytest.fixture(scope="module")
def counts(spark):
    docs = spark.createDataFrame([(i, t.split()) for i, t in enumerate(TEXTS)] + [(99, None)], "doc_id int, words array<string>")
    return tp.term_counts(docs)


def test_vocabulary_and_vectors(counts):
    total = Counter(w for t in TEXTS for w in t.split())
    order = sorted(total, key=lambda w: (-total[w], w))
    terms = tp.vocabulary(counts)
    assert [(r.term, r.id, r.n) for r in terms.orderBy("id").collect()] == [(w, i, total[w]) for i, w in enumerate(order)]
    vectors = {r.doc_id: dict(zip(r.ids, r.counts)) for r in tp.sparse_vectors(tp.count_rows(counts, terms)).collect()}
    assert vectors == {i: {order.index(w): n for w, n in Counter(t.split()).items()} for i, t in enumerate(TEXTS) if t}
    short = tp.vocabulary(counts, min_docs=2, size=3)
    assert [r.term for r in short.orderBy("id").collect()] == ["cell", "court", "law"]


def brute(k, iterations, alpha, eta):
    """The same rounds over dictionaries; the model and the log-likelihood under it."""
    edges = {(d, w): n for d, t in enumerate(TEXTS) for w, n in Counter(t.split()).items()}
    terms = {w for _, w in edges}

    def start(w):
        u = [1 + int(hashlib.md5(f"{w}:{i}".encode()).hexdigest()[:8], 16) / 2**32 for i in range(k)]
        return [x / sum(u) for x in u]

    def model(shares):
        t, d = ({}, {})
        for (doc, w), g in shares.items():
            for side, key in ((t, w), (d, doc)):
                side[key] = [a + b for a, b in zip(side.get(key, [0.0] * k), g)]
        return t, d

    def scaled(doc, w):
        total = [sum(x[i] for x in t.values()) + len(terms) * (eta - 1) for i in range(k)]
        return [(t[w][i] + eta - 1) * (d[doc][i] + alpha - 1) / total[i] for i in range(k)]

    t, d = model({e: [n * s for s in start(e[1])] for e, n in edges.items()})
    for _ in range(iterations):
        shares = {}
        for e, n in edges.items():
            x = scaled(*e)
            shares[e] = [n * v / sum(x) for v in x]
        t, d = model(shares)
    likelihood = sum(n * math.log(sum(scaled(*e)) / (sum(d[e[0]]) + k * (alpha - 1))) for e, n in edges.items())
    return t, d, likelihood


@pytest.mark.parametrize("k, iterations, alpha, eta, hinted", [(2, 3, 1.5, 1.1, True), (3, 2, 100.0, 500.0, False), (1, 1, 2.0, 2.0, True), (2, 0, 2.0, 2.0, True)])
def test_rounds_against_plain_python(counts, monkeypatch, k, iterations, alpha, eta, hinted):
    if not hinted:
        monkeypatch.setattr(tp, "_small", lambda n, k: False)
    terms = tp.vocabulary(counts)
    found = tp.count_rows(counts, terms)
    weights = tp.fit_topics(found, terms, k, iterations, alpha, eta)
    t, d, likelihood = brute(k, iterations, alpha, eta)
    names = {r.id: r.term for r in terms.collect()}
    got = {(r.kind, names[r.id] if r.kind == "t" else r.id): [r[f"g{i}"] for i in range(k)] for r in weights.collect()}
    assert set(got) == {("t", w) for w in t} | {("d", x) for x in d}
    for kind, side in (("t", t), ("d", d)):
        for key, value in side.items():
            assert got[kind, key] == pytest.approx(value)
    assert tp.log_likelihood(found, weights, terms.count(), k, alpha, eta).first()[0] == pytest.approx(likelihood)
    best = tp.top_terms(weights, terms, k, top=4).collect()
    for topic in range(k):
        listed = sorted((r for r in best if r.topic == topic), key=lambda r: r.rank)
        total = sum(x[topic] for x in t.values())
        assert [r.rank for r in listed] == [1, 2, 3, 4]
        assert [r.weight for r in listed] == pytest.approx(sorted((x[topic] / total for x in t.values()), reverse=True)[:4])


def test_topics_part_the_two_subjects(counts):
    terms = tp.vocabulary(counts)
    weights = tp.fit_topics(tp.count_rows(counts, terms), terms, 2, 30, alpha=1.01, eta=1.01)
    top = {(r.topic, r.term) for r in tp.top_terms(weights, terms, 2, top=3).collect()}
    assert len({t for t, w in top if w in ("law", "judge")}) == 1


def test_no_rows(spark, counts):
    none = counts.limit(0)
    terms = tp.vocabulary(none)
    weights = tp.fit_topics(tp.count_rows(none, terms), terms, 2, 2)
    assert weights.count() == 0 and tp.top_terms(weights, terms, 2).count() == 0
    with pytest.raises(ValueError):
        tp.fit_topics(none, terms, alpha=1.0)


def _exchanges(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size())}


def test_a_fit_leaves_no_tables_and_no_exchanges(spark, counts):
    terms = cut_lineage(tp.vocabulary(counts))
    found = cut_lineage(tp.count_rows(counts, terms))
    scratch = Path(shared_dir(spark).removeprefix("file:")) / "scratch"
    reclaim(spark)
    tables, files = set(scratch.iterdir()), _exchanges(spark)
    weights = tp.fit_topics(found, terms, 2, 12)
    assert len(set(scratch.iterdir()) - tables) == 1  # the weights
    until = time.time() + 20  # Spark deletes them in the background
    while time.time() < until and (left := {f for f in _exchanges(spark) - files if f.endswith(".data")}):
        time.sleep(0.2)
    assert not left
    assert weights.count() == len({w for t in TEXTS for w in t.split()}) + sum(bool(t) for t in TEXTS)


def test_packed_counts_give_the_same_fit(spark, counts):
    terms = tp.vocabulary(counts)
    found = tp.count_rows(counts, terms)
    packed = tp.packed_counts(found)
    names = ["kind", "id", "g0", "g1"]
    one, other = (tp.fit_topics(x, terms, 2, 3, 2.0, 2.0, p) for x, p in ((found, None), (None, packed)))
    assert rows(one.select(*names)) == rows(other.select(*names))
    likelihoods = [tp.log_likelihood(x, one, terms.count(), 2, 2.0, 2.0, p).first()[0] for x, p in ((found, None), (None, packed))]
    assert likelihoods[0] == pytest.approx(likelihoods[1], rel=1e-12)


# ---- registry -----------------------------------------------------------------------------------------------------


def test_kept_table_is_made_once_per_input_and_setting(spark, tmp_path):
    source = tmp_path / "in.txt"
    source.write_text("one")
    made = []

    def make():
        made.append(1)
        return spark.createDataFrame([(len(made),)], "n int")

    def kept(**settings):
        return rows(kept_table(spark, f"test-{tmp_path.name}", [str(tmp_path)], settings, make))

    assert kept(a=1) == kept(a=1) == [(1,)]
    assert kept(a=2) == [(2,)] and kept(a=1) == [(1,)]
    before = fingerprint(spark, [str(tmp_path)], {})
    source.write_text("two words")
    assert fingerprint(spark, [str(tmp_path)], {}) != before
    assert kept(a=1) == [(3,)]


def test_a_table_that_failed_is_not_kept(spark, tmp_path):
    def broken():
        return spark.range(3).select(F.raise_error(F.lit("stopped")).alias("n"))

    for attempt in (broken, broken):
        with pytest.raises(Exception, match="stopped"):
            kept_table(spark, f"failing-{tmp_path.name}", [], {}, attempt)
    assert kept_table(spark, f"failing-{tmp_path.name}", [], {}, lambda: spark.range(2)).count() == 2


def test_counts_stay_in_their_blocks(spark, counts, monkeypatch):
    monkeypatch.setattr(tp, "PIECE_COUNTS", 3)  # several pieces a block
    terms = tp.vocabulary(counts)
    found = tp.count_rows(counts, terms)
    twice = found.unionByName(found.where("id < 4")).unionByName(spark.createDataFrame([(0, 999, 5), (77, 999, 1)], found.schema))
    blocks = tp._Blocks(twice, 2)
    blocks.hold()
    weights = terms.select(F.lit("t").alias("kind"), "id", F.lit(1.0).alias("g0"), F.lit(3.0).alias("g1"))
    state = blocks.gather(blocks.shares(blocks.load(weights), None, 1.0, 1.0))
    again = blocks.gather(blocks.shares(state, terms.count(), 2.0, 2.0))
    plan = again._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    # neither the counts nor the lists of terms are dealt again in a round; only packed weights move
    moved = [line for line in plan.split("InMemoryRelation")[0].splitlines() if "Exchange" in line]
    assert "FlatMapCoGroupsInArrow" in plan and not any("slots" in line or "ids" in line for line in moved)
    got = {(r.kind, r.id): (r.g0 + r.g1, r.g0 / r.g1) for r in blocks.unload(state).collect()}
    total = Counter()
    for r in twice.where("id <> 999").collect():
        total["t", r.id] += r.n
        total["d", r.doc_id] += r.n
    # terms without weights (999) count nowhere, and a document of such terms alone has none
    assert got == {key: (pytest.approx(n), pytest.approx(1 / 3)) for key, n in total.items()}
    assert {(r.kind, r.id): r.g0 + r.g1 for r in blocks.unload(again).collect()} == {key: pytest.approx(n) for key, n in total.items()}
    for table in (blocks.packed, blocks.lists):
        table.unpersist()
