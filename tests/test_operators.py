from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.feature import ElementwiseProduct, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textkg.functions.text import STOPWORDS
from textkg.operators import axioms as ax
from textkg.operators import closure as cl
from textkg.operators import counts as ct
from textkg.operators import graph as gr
from textkg.operators import lexicon as lx
from textkg.operators import lists as ls
from textkg.operators import matching as mt
from textkg.operators import ml
from textkg.operators import nearest as ne
from textkg.operators import ordinals as od
from textkg.operators import questions as qn
from textkg.operators import reasoning as rs
from textkg.operators import tfidf as ti
from textkg.operators import triples as tr
from textkg.operators.rules import BUILTINS, Builtin, Rule, derive, fixpoint

# ---- keyed lists and ordinals -------------------------------------------------------------------------------------


def test_key_lists_small_keys_are_whole(spark):
    df = spark.createDataFrame([("cat", 1), ("dog", 1), ("cat", 2)], "k string, v int")
    assert rows(ls.key_lists(df, "k", "v")) == [("cat", 0, [1, 2]), ("dog", 0, [1])]


def test_key_lists_split_a_hot_key_and_lose_nothing(spark):
    hot = [("hot", i) for i in range(500)] + [("hot", 7)] * 400 + [("cold", 1), ("cold", 1)]
    got = ls.key_lists(spark.createDataFrame(hot, "k string, v int"), "k", "v", max_list=50).collect()
    parts = [r for r in got if r.k == "hot"]
    assert len(parts) == 18
    assert max(len(r["values"]) for r in parts) <= 100
    assert Counter(x for r in parts for x in r["values"]) == Counter(v for k, v in hot if k == "hot")
    assert [(r.part, r["values"]) for r in got if r.k == "cold"] == [(0, [1, 1])]


def test_cogroup(spark):
    landings = spark.createDataFrame([("north pier", "cod"), ("mole", "eel"), ("north pier", "hake")], "place string, fish string")
    keepers = spark.createDataFrame([("north pier", "Ines"), ("lock", "Bo")], "place string, keeper string")
    assert rows(ls.cogroup_lists(landings, keepers, "place", "fish", "keeper")) == [
        ("lock", 0, [], ["Bo"]),
        ("mole", 0, ["eel"], []),
        ("north pier", 0, ["cod", "hake"], ["Ines"]),
    ]


def test_ordinals_are_gapless_and_ordered(spark):
    values = random.Random(1).sample(range(10**6), 3000)
    got = od.with_ordinal(spark.createDataFrame([(x,) for x in values], "x int"), ["x"], partitions=7)
    assert [tuple(r) for r in got.orderBy("ordinal").collect()] == [(x, i) for i, x in enumerate(sorted(values))]


def test_batches_and_cap(spark):
    got = od.batches(spark.range(450), "id", 200).orderBy("batch").collect()
    assert [r.n_ids for r in got] == [200, 200, 50] and got[1].ids.startswith("200,201,")
    assert [r.n_ids for r in od.batches(spark.range(450), "id", 200, cap=210).orderBy("batch").collect()] == [200, 10]


# ---- counts and weights -------------------------------------------------------------------------------------------


def test_noun_verb_report(spark):
    docs = spark.createDataFrame([(1, "cells linked cells"), (10, "cells linked"), (2, "cells")], "doc_id int, text string")
    assert rows(ct.noun_verb_report(docs, F.col("doc_id") == 10)) == [(1, "2\ncell\n\n1\nlink")]


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["a"]), (3, ["c"])], "doc_id int, words array<string>")
    score = {(r.doc_id, r.term): r.score for r in ti.tfidf(docs).collect()}
    assert score[1, "a"] == pytest.approx(2 * np.log(4 / 3)) and score[1, "b"] == pytest.approx(np.log(4 / 2))
    last = {r.term: r.score for r in ti.term_scores(docs, keep="last").collect()}
    assert last["a"] == pytest.approx(np.log(4 / 3))
    best = {r.term: r.score for r in ti.term_scores(docs).collect()}
    assert best["a"] == pytest.approx(2 * np.log(4 / 3))
    assert len(ti.hashed_scores(docs).collect()) == 3


def test_dictionary_hits_cover_all_words(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 2)], "word string, n bigint")
    d = spark.createDataFrame([("b",)], "word string")
    assert rows(ct.dictionary_hits(counts, "word", d)) == [("a", 3, 0, 0), ("b", 2, 1, 2)]


# ---- substring matching -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1 << 30, 0], ids=["broadcast", "shuffle"])
def test_substring_pairs_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(mt, "BROADCAST_BYTES", limit)
    rng = random.Random(3)
    make = lambda top: "".join(rng.choice("abß_") for _ in range(rng.randint(0, top)))
    texts = sorted({make(40) for _ in range(150)} | {"", "a", "abababababababababab"})
    terms = sorted({make(9) for _ in range(120)} | {"a", "ab", "abab", "x" * 20})
    t = spark.createDataFrame([(x,) for x in texts], "t string")
    s = spark.createDataFrame([(x,) for x in terms], "s string")
    for least in (1, 3):
        want = sorted((x, y) for x in texts for y in terms if len(y) >= least and y in x)
        assert rows(mt.substring_pairs(t, "t", s, "s", least).select("t", "s")) == want


def test_no_terms_match_nothing(spark):
    t = spark.createDataFrame([("abc",)], "t string")
    assert mt.substring_pairs(t, "t", spark.createDataFrame([], "s string"), "s").count() == 0


# ---- triples ------------------------------------------------------------------------------------------------------


def test_typed_triples_by_hand(spark):
    raw = spark.createDataFrame(
        [
            ("risk of dementia", "is linked", "amyloid plaque"),
            ("risk of dementia", "is linked", "amyloid plaque"),
            ("mouse", "eats", "cheese"),
            ("Dementia_care", "needs", "staff"),
        ],
        "subject string, predicate string, object string",
    )
    triples = tr.distinct_triples(tr.clean_triples(raw))
    assert triples.count() == 3
    gaz = tr.clean_gazetteer(
        spark.createDataFrame(
            [("Dementia", "DISEASE"), ("dementia care", "service"), ("amyloid", ""), ("x", "Gene"), ("de", "Gene")],
            "mention string, type string",
        )
    )
    assert rows(gaz) == [("amyloid", "Misc"), ("de", "Gene"), ("dementia", "Disease"), ("dementia_Care", "Service")]
    entities = tr.part_set(triples, "subject").union(tr.part_set(triples, "object")).distinct()
    typed = tr.type_entities(entities, gaz)
    assert rows(typed) == [
        ("Dementia_care", "Service"), ("amyloid_Plaque", "Misc"), ("risk_Dementia", "Disease"),
    ]
    got = tr.typed_triples(triples, typed, ["risk", "care", "plaque"])
    assert rows(got) == [
        ("care", "Dementia_care", "needs", "staff", "Other"),
        ("risk", "risk_Dementia", "is_Linked", "amyloid_Plaque", "plaque"),
    ]
    assert rows(tr.triples_with_terms(triples, typed)) == sorted(r[1:4] for r in rows(got))
    words = spark.createDataFrame([(0, "risk"), (1, "care"), (2, "plaque")], "ord int, word string")
    by_table = {r.entity: r["class"] for r in tr.schema_class_by_table(entities, words).collect()}
    by_list = entities.select("entity", tr.schema_class(F.col("entity"), ["risk", "care", "plaque"]).alias("c"))
    assert by_table == {r.entity: r.c for r in by_list.collect()}
    assert rows(tr.object_properties(got)) == [
        ("is_Linked", "risk", "plaque", "Func"), ("needs", "care", "Other", "Func"),
    ]
    assert len(rows(tr.individuals(got))) == 4 and len(rows(tr.facts(got))) == 2


def test_types_by_containment_and_untyped(spark):
    t = spark.createDataFrame([("risk", "p", "cat"), ("dog", "p", "bird")], "subject string, predicate string, object string")
    subj = spark.createDataFrame([("risk_Of_Flu", "Disease"), ("risk_Of", "Misc")], "entity string, type string")
    obj = spark.createDataFrame([], "entity string, type string")
    types = tr.triple_types(t, subj, obj)
    assert rows(types) == [("dog", "p", "bird", "Other", "Other"), ("risk", "p", "cat", "Misc", "Other")]
    assert rows(tr.keep_typed(types)) == [("risk", "p", "cat", "Misc", "Other")]
    assert rows(tr.untyped_entities(types)) == [("cat",), ("dog",)]


# ---- closures and components --------------------------------------------------------------------------------------


def brute_closure(edges):
    reach = set(edges)
    while True:
        more = {(a, d) for a, b in reach for c, d in edges if b == c} - reach
        if not more:
            return reach
        reach |= more


def test_closure_with_cycle_and_depths(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("x", "y"), ("a", "b")]
    got = cl.transitive_closure(spark.createDataFrame(edges, "child string, parent string"), "child", "parent")
    found = [tuple(r) for r in got.collect()]
    assert {(a, b) for a, b, _ in found} == brute_closure(set(edges)) and len(found) == len(set(found))
    assert ("a", "e", 4) in found and ("a", "a", 3) in found
    again = cl.transitive_closure(got.select("child", F.col("ancestor").alias("parent")), "child", "parent")
    assert {(r.child, r.ancestor) for r in again.collect()} == {(a, b) for a, b, _ in found}
    short = cl.transitive_closure(spark.createDataFrame(edges, "child string, parent string"), "child", "parent", 2)
    assert {tuple(r) for r in short.collect()} == {t for t in found if t[2] <= 2}
    direct = cl.direct_pairs(got, "child")
    assert set(rows(direct)) == {("a", "d"), ("b", "d"), ("c", "d"), ("d", "e"), ("x", "y")}


def brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return sorted((x, find(x)) for x in parent)


@pytest.mark.parametrize(
    "edges",
    [
        [(i, i + 1) for i in range(60)],
        [(0, i) for i in range(1, 80)],
        [(i, (i * 7) % 50) for i in range(50)] + [(100, 101), (102, 101)],
        [(5, 4), (4, 3), (9, 3), (8, 7), (7, 9), (20, 21)],
    ],
    ids=["chain", "star", "mixed", "tree"],
)
def test_components(spark, edges):
    got = cl.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert rows(got) == brute_components([e for e in edges if e[0] != e[1]])


# ---- graph, rules, reasoning --------------------------------------------------------------------------------------

KG = [("tom", "father", "ann"), ("ann", "father", "sue"), ("sue", "likes", "sue"), ("ann", "likes", "tom")]


@pytest.fixture(scope="module")
def kg(spark):
    return spark.createDataFrame(KG, "s string, p string, o string")


def test_bgp(kg):
    assert rows(gr.bgp(kg, [("?a", "father", "?b"), ("?b", "father", "?c")])) == [("tom", "ann", "sue")]
    assert rows(gr.bgp(kg, [("?x", "likes", "?x")])) == [("sue",)]
    assert rows(gr.bgp(kg, [("?a", "father", "?b"), ("?b", "likes", "?a")])) == [("tom", "ann")]
    assert rows(gr.bgp(kg, [("tom", "?p", "?o")])) == [("father", "ann")]
    with pytest.raises(ValueError):
        gr.bgp(kg, [("?a", "father", "?b"), ("?c", "likes", "?d")])


def test_recursive_rule_reaches_the_closure(spark):
    edges = [(f"n{i}", "next", f"n{i + 1}") for i in range(9)]
    facts = spark.createDataFrame(edges, "s string, p string, o string")
    rules = [
        Rule("base", (("?a", "next", "?b"),), ("?a", "reach", "?b")),
        Rule("step", (("?a", "reach", "?b"), ("?b", "reach", "?c")), ("?a", "reach", "?c")),
    ]
    got = fixpoint(facts, rules).where("p = 'reach'").select("s", "o")
    assert rows(got) == sorted((f"n{i}", f"n{j}") for i in range(10) for j in range(i + 1, 10))


def test_rule_provenance_and_builtins(spark, kg):
    rule = Rule("grand", (("?a", "father", "?b"), ("?b", "father", "?c")), ("?a", "grandfather", "?c"))
    r = derive(kg, rule).first()
    assert (r.s, r.p, r.o, r.rule) == ("tom", "grandfather", "sue", "grand")
    assert [tuple(x) for x in r.premises] == [("tom", "father", "ann"), ("ann", "father", "sue")]
    ids = spark.createDataFrame([("ex:1",), ("plain",)], "iri string")
    parts = Builtin("IRIparts", ("iri", "prefix", "id"), {"separator": ":"})
    assert rows(parts.apply(ids, BUILTINS)) == [("ex:1", "ex", "1")]
    bound = ids.withColumn("prefix", F.lit("no"))
    assert parts.apply(bound, BUILTINS).count() == 0
    years = spark.createDataFrame([(2024,), (2025,)], "y int")
    assert rows(Builtin("thisYear", ("y",), {"year": 2025}).apply(years, BUILTINS)) == [(2025,)]
    free = Builtin("thisYear", ("now",), {"year": 2025}).apply(years, BUILTINS)
    assert rows(free) == [(2024, 2025), (2025, 2025)]


def test_reasoning_against_brute_force(spark):
    rng = random.Random(5)
    t = sorted({(f"n{rng.randint(0, 9)}", f"p{rng.randint(0, 3)}", f"n{rng.randint(0, 9)}") for _ in range(120)})
    df = spark.createDataFrame(t + t[:9], "s string, p string, o string")
    pairs = [(a, b) for a in t for b in t]
    assert rows(rs.symmetric(df)) == sorted({a for a, b in pairs if a[0] == b[2] and a[2] == b[0] and a[1] == b[1]})
    assert rows(rs.inverse(df)) == sorted(
        a + (b[1],) for a, b in pairs if a[0] == b[2] and a[2] == b[0] and a[1] != b[1]
    )
    chained = Counter((a[1], b[1]) for a, b in pairs if a[2] == b[0] and a[0] != b[2])
    assert {(r.p, r.p2): r.n for r in rs.chain_counts(df).collect()} == dict(chained)
    assert {r.p: r.n for r in rs.transitive_counts(df).collect()} == {p: n for (p, q), n in chained.items() if p == q}
    middle = spark.createDataFrame([("n1",), ("n2",)], "m string")
    want = sorted(
        (a[0], a[1], a[2], b[1], b[2]) for a, b in pairs if a[2] == b[0] and a[0] != b[2] and a[2] in ("n1", "n2")
    )
    assert rows(rs.chain_pairs(df, middle, salts=4)) == want
    assert rows(rs.irreflexive_violations(df)) == sorted(x for x in t if x[0] == x[2])
    asym = sorted(a + (b[1],) for a, b in pairs if a[0] == b[2] and a[2] == b[0] and a[1] == "p1")
    assert rows(rs.asymmetry_violations(df, ["p1"])) == asym


def test_violations(spark):
    t = [("a", "age", "1"), ("a", "age", "2"), ("b", "age", "1"), ("a", "over", "b"), ("b", "over", "a"), ("c", "near", "c")]
    df = spark.createDataFrame(t, "s string, p string, o string")
    assert rows(rs.consistency_violations(df, ["age"], ["over"], ["near"])) == [
        ("asymmetric", "a", "over", 1), ("asymmetric", "b", "over", 1),
        ("functional", "a", "age", 2), ("irreflexive", "c", "near", 1),
    ]


def test_questions_and_answers(spark):
    facts = [
        ("Ines", "has_boat", "Petrel"), ("Ines", "greets", "Bo"), ("Ines", "sails_with", "Karim"),
        ("Ada", "has_captain", "Olle"), ("Juno", "has_captain", "Olle"),
    ]
    kg = spark.createDataFrame(facts, "s string, p string, o string")
    asked = ["who has boat Petrel", "who greets Bo", "who sails with Karim", "whose captain Olle", "why zzz Qqq"]
    q = spark.createDataFrame([(x,) for x in asked], "question string")
    got = defaultdict(set)
    for question, answer in rows(qn.answers(q, kg, kg.select(F.col("p").alias("predicate")).distinct())):
        got[question].add(answer)
    assert got == {
        "who has boat Petrel": {"Ines has boat Petrel"},
        "who greets Bo": {"Ines greets Bo"},
        "who sails with Karim": {"Ines sails with Karim"},
        "whose captain Olle": {"Ada captain Olle", "Juno captain Olle"},
        "why zzz Qqq": {"Answer not found"},
    }


def test_instances_and_equivalents(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a")], "child string, parent string")
    closure = cl.transitive_closure(edges, "child", "parent").withColumnRenamed("child", "class")
    assert rows(gr.equivalent_classes(closure)) == [("a", "b"), ("b", "a")]
    types = spark.createDataFrame([("i", "c"), ("i", "a")], "ind string, class string")
    assert rows(gr.instances(types, closure)) == [("i", "a", True), ("i", "b", False), ("i", "c", True)]
    wanted = spark.createDataFrame([("i", "b"), ("i", "z")], "ind string, class string")
    got = gr.entailed(wanted, gr.instances(types, closure), ["ind", "class"])
    assert rows(got) == [("i", "b", True), ("i", "z", False)]


def test_labels_by_language(spark):
    labels = spark.createDataFrame(
        [("a", "Haus", "de", 1), ("a", "house", "en", 2), ("b", "plain", None, 3), ("b", "casa", "es", 4), ("c", "casa", "es", 5)],
        "ind string, text string, lang string, n int",
    )
    got = gr.label_by_language(labels, "ind", "text", "lang", "n", ["en", "de"])
    assert sorted((r.ind, r.text) for r in got.collect()) == [("a", "house"), ("b", "plain")]


def test_axioms_of_a_harbour(spark):
    props = spark.createDataFrame(
        [("moorsAt", "Vessel", "Quay", "InvOf:hosts"), ("ownedBy", "Vessel", "Firm", "Func"), ("", "A", "B", "Func")],
        "property string, domain string, range string, kind string",
    )
    got = {(r.kind, r.s, r.o) for r in ax.object_property_axioms(props).collect()}
    assert got == {
        ("ObjectPropertyDomain", "moorsAt", "Vessel"), ("ObjectPropertyRange", "moorsAt", "Quay"),
        ("ObjectPropertyDomain", "hosts", "Quay"), ("ObjectPropertyRange", "hosts", "Vessel"),
        ("InverseObjectProperties", "moorsAt", "hosts"), ("ObjectPropertyDomain", "ownedBy", "Vessel"),
        ("ObjectPropertyRange", "ownedBy", "Firm"), ("FunctionalObjectProperty", "ownedBy", None),
    }
    facts = spark.createDataFrame(
        [("Petrel", "callSign", "P E T", "Data"), ("Petrel", "berths", "7", "Data"), ("Petrel", "moorsAt", "Mole", "Obj"), ("x", "y", "z", "No")],
        "subject string, property string, object string, kind string",
    )
    data = spark.createDataFrame(
        [("berths", "Vessel", "int"), ("callSign", "Vessel", "string")], "property string, domain string, datatype string"
    )
    assert {(r.kind, r.s, r.p, r.o, r.lit_type) for r in ax.fact_axioms(facts, data).collect()} == {
        ("DataPropertyAssertion", "Petrel", "callSign", "P E T", "string"),
        ("DataPropertyAssertion", "Petrel", "berths", "7", "integer"),
        ("ObjectPropertyAssertion", "Petrel", "moorsAt", "Mole", None),
    }


# ---- lexicon ------------------------------------------------------------------------------------------------------


def test_synonyms_of_a_large_synset(spark):
    members = [f"w{i:02d}" for i in range(30)]
    sets = spark.createDataFrame([("s", w) for w in members] + [("t", "lone")], "synset string, word string")
    asked = spark.createDataFrame([("w00",), ("w20",), ("lone",), ("none",)], "word string")
    got = {r.word: r.synonyms for r in lx.synonyms(asked, sets, 10).collect()}
    assert got == {"w00": members[1:11], "w20": members[:10], "lone": [], "none": None}


def test_word_distance(spark):
    up = cl.transitive_closure(
        spark.createDataFrame([("dog", "animal"), ("cat", "animal"), ("puppy", "dog")], "child string, parent string"),
        "child", "parent",
    ).withColumnRenamed("child", "word")
    pairs = spark.createDataFrame([("puppy", "cat"), ("puppy", "dog"), ("dog", "stone")], "w1 string, w2 string")
    assert {(r.w1, r.w2): r.distance for r in lx.word_distance(pairs, up).collect()} == {
        ("puppy", "cat"): 3, ("puppy", "dog"): 1, ("dog", "stone"): None,
    }


# ---- vectors ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block_rows", [4096, 17])
def test_cosine_top_k_against_numpy(spark, block_rows):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(120, 8))
    x[30:70] = x[30]  # copies: ties go to the lower id
    df = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "id bigint, vector array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 6)
    want = {}
    for i in range(len(x)):
        order = sorted((j for j in range(len(x)) if j != i), key=lambda j: (-sims[i, j], j))[:4]
        want[i] = order
    got = defaultdict(list)
    for r in ne.cosine_top_k(df, df, 4, block_rows).orderBy("id", "rank").collect():
        got[r.id].append(r.neighbour)
    assert got == want


def test_word_vectors(spark, tmp_path):
    words = [["cat", "sat", "mat"], ["dog", "sat", "log"], ["cat", "dog", "sat"]] * 6
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id int, words array<string>")
    path = str(tmp_path / "w2v")
    model = ml.load_or_fit(path, lambda: ml.fit_word_vectors(docs, size=6))
    again = ml.load_or_fit(path, lambda: pytest.fail("the saved model was not used"))
    assert rows(ml.word_vectors(model)) == rows(ml.word_vectors(again))
    terms = spark.createDataFrame([("cat",), ("unseen",)], "word string")
    listed, unknown = ml.all_synonyms(terms, ml.word_vectors(model), 2)
    single = [r.synonym for r in ml.synonyms(model, "cat", 2).orderBy(F.desc("similarity")).collect()]
    assert [tuple(r) for r in listed.collect()] == [("cat", single)]
    assert rows(unknown) == [("unseen",)]
    assert ml.render_synonyms(listed).first()[0] == "cat:" + ",".join(single)


def test_hashed_vectors_agree_with_exact_terms(spark):
    docs = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["a"]), (3, ["c"])], "doc_id int, words array<string>")
    values = ml.hashing_tfidf(docs).where("doc_id = 1").select(F.unwrap_udt("tfidf")["values"]).first()[0]
    exact = [r.score for r in ti.tfidf(docs).where("doc_id = 1").collect()]
    assert sorted(values) == pytest.approx(sorted(exact))


@pytest.mark.parametrize("optimizer", ["em", "online"])
def test_topics(spark, optimizer):
    texts = ["cell gene cell protein", "gene protein cell", "court law judge", "law court trial judge"] * 3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    vectors, vocabulary = ml.count_vectors(docs, "text", STOPWORDS)
    assert vectors.agg(F.sum(ml.n_tokens("features")), F.sum(ml.n_active("features"))).first() == (42, 39)
    model = ml.fit_topics(vectors, k=2, iterations=5, optimizer=optimizer)
    terms = ml.topic_terms(model, vocabulary, 3).collect()
    assert len(terms) == 6 and {r.term for r in terms} <= set(" ".join(texts).split())
    likelihood = ml.mean_log_likelihood(model, len(texts))
    assert (likelihood is not None and likelihood < 0) if optimizer == "em" else likelihood is None


def test_topics_of_a_fit_by_em(spark):
    texts = ["cell gene cell protein", "gene protein cell", "", "court law judge", "law court trial judge"]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id int, text string")
    vectors, vocabulary = ml.count_vectors(docs, "text", STOPWORDS)
    n = len(vocabulary.vocabulary)

    def fitted(iterations):
        model = ml.fit_topics(vectors, 2, iterations, alpha=3.0, eta=2.0)
        return model, {(r.kind, r.id): (r.g0, r.g1) for r in model.weights.collect()}

    start, after = fitted(0)[1], fitted(2)[1]
    assert {key[0]: 0 for key in start} == {"t": 0, "d": 0} and len(start) == n + 4  # a document without words has no weights
    # the same two rounds in plain python
    found = {(r.doc_id, r.id): r.n for r in ml._vector_counts(vectors).collect()}
    for _ in range(2):
        total = [sum(x[i] for (kind, _), x in start.items() if kind == "t") + n for i in range(2)]
        nxt = defaultdict(lambda: [0.0, 0.0])
        for (doc, term), count in found.items():
            x = [(start["t", term][i] + 1.0) * (start["d", doc][i] + 2.0) / total[i] for i in range(2)]
            for i in range(2):
                nxt["t", term][i] += count * x[i] / sum(x)
                nxt["d", doc][i] += count * x[i] / sum(x)
        start = nxt
    assert set(after) == set(start) and all(after[key] == pytest.approx(start[key]) for key in after)
    halves = vectors.select("doc_id", F.col("features").alias("whole")).crossJoin(spark.range(1))  # weights need not be whole numbers
    halves = VectorAssembler(inputCols=["whole"], outputCol="all").transform(halves)
    halves = ElementwiseProduct(scalingVec=Vectors.dense([0.5] * n), inputCol="all", outputCol="features").transform(halves)
    weights = ml.fit_topics(halves, 2, 1, alpha=3.0, eta=2.0).weights
    assert weights.where("kind = 't'").agg(F.sum(F.col("g0") + F.col("g1"))).first()[0] == pytest.approx(sum(found.values()) / 2)


def test_topic_queries_fit_with_all_rounds(spark, tmp_path, monkeypatch):
    """Fifty rounds with the settings of the model, not a part of them."""
    from textkg.operators import topics as tp
    from textkg.plans import load_all

    texts = ["cell gene cell protein", "gene protein cell", "court law judge", "law court trial judge"]
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id int, text string, lang string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    called, rounds, shares = [], [], tp._Blocks.shares

    def fit(rows, terms, *settings):
        called.append(settings[:4])
        return tp_fit(rows, terms, *settings)

    tp_fit = tp.fit_topics
    monkeypatch.setattr(tp, "fit_topics", fit)
    monkeypatch.setattr(tp._Blocks, "shares", lambda self, *a: rounds.append(1) or shares(self, *a))
    assert load_all().QUERIES["lda_topics"](spark, str(tmp_path)).groupBy("topic").count().count() == 3
    assert called == [(3, 50, 100.0, 500.0)] and len(rounds) == 51


def test_the_fit_has_the_whole_size(spark, tmp_path):
    """A thousand numbers a word, as in the reference."""
    from textkg.plans import load_all

    texts = ["the cat sat on the mat and the cat ran"] * 6
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id int, text string, lang string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    assert load_all().QUERIES["w2v_fit"](spark, str(tmp_path)).collect() == [(7, 1000)]
    assert "1000 AS vector_size" in load_all().ORACLES["w2v_fit"]
