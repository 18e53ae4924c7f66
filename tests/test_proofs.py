"""Derivations of least depth and proof trees, against rules applied by hand."""

from __future__ import annotations

import random

from conftest import rows

from textkg.operators.rules import TYPE, Rule, proof_text, proof_trees, proofs

KG = "s string, p string, o string"
RULES = [
    Rule("step", (("?a", "edge", "?b"),), ("?a", "path", "?b")),
    Rule("join", (("?a", "path", "?b"), ("?b", "path", "?c")), ("?a", "path", "?c")),
    Rule("loop", (("?a", "path", "?b"), ("?b", "path", "?a")), ("?a", TYPE, "Looped")),
]


def brute(edges):
    """fact -> (round, rule, premises): all derivations of each round, the first by name and premises."""
    known = {(a, "edge", b): (0, None, None) for a, b in edges}
    at = 0
    while True:
        at += 1
        found = {}

        def add(head, rule, premises):
            found.setdefault(head, []).append((rule, premises))

        facts = list(known)
        paths = [f for f in facts if f[1] == "path"]
        for f in facts:
            if f[1] == "edge":
                add((f[0], "path", f[2]), "step", [f])
        for f in paths:
            for g in paths:
                if f[2] == g[0]:
                    add((f[0], "path", g[2]), "join", [f, g])
                    if g[2] == f[0]:
                        add((f[0], TYPE, "Looped"), "loop", [f, g])
        new = {h: (at, *min(d)) for h, d in found.items() if h not in known}
        if not new:
            return known
        known |= new


def test_least_depth_on_random_graphs(spark):
    rng = random.Random(6)
    for _ in range(3):
        edges = {(f"n{rng.randrange(8)}", f"n{rng.randrange(8)}") for _ in range(10)}
        kg = spark.createDataFrame([(a, "edge", b) for a, b in edges] * 2, KG)
        got = {
            (r.s, r.p, r.o): (r.round, r.rule, None if r.premises is None else [tuple(x) for x in r.premises])
            for r in proofs(kg, RULES).collect()
        }
        assert got == brute(edges)


def test_trees_unroll_to_given_facts(spark):
    edges = [(f"n{i}", f"n{i + 1}") for i in range(6)] + [("n6", "n0")]
    known = proofs(spark.createDataFrame([(a, "edge", b) for a, b in edges], KG), RULES)
    facts = {(r.s, r.p, r.o): r for r in known.collect()}
    goals = spark.createDataFrame([("n0", "path", "n5"), ("n0", TYPE, "Looped"), ("n0", "edge", "n1"), ("x", "path", "y")], KG)
    trees = proof_trees(goals.union(goals), known).collect()
    nodes = {((r.goal_s, r.goal_p, r.goal_o), tuple(r.path)): r for r in trees}
    assert len(nodes) == len(trees)
    for (goal, path), r in nodes.items():
        below = [nodes[goal, path + (k,)] for k in (1, 2, 3) if (goal, path + (k,)) in nodes]
        if r.round is None:
            assert goal == ("x", "path", "y") and not below
        elif r.round == 0:
            assert r.rule is None and not below and r.p == "edge"
        else:
            assert [(b.s, b.p, b.o) for b in below] == [tuple(x) for x in facts[r.s, r.p, r.o].premises]
            assert all(b.round < r.round for b in below)
    assert {g for g, path in nodes if not path} == {tuple(g) for g in goals.collect()}


def test_written_trees(spark):
    kg = spark.createDataFrame([("a", "edge", "b"), ("b", "edge", "c")], KG)
    trees = proof_trees(spark.createDataFrame([("a", "path", "c")], KG), proofs(kg, RULES))
    assert rows(proof_text(trees)) == [
        (
            "a", "path", "c",
            "a path c [join]\n    a path b [step]\n        a edge b\n    b path c [step]\n        b edge c",
        )
    ]


def test_no_facts_and_no_goals(spark):
    none = spark.createDataFrame([], KG)
    assert proofs(none, RULES).count() == 0
    assert proof_trees(none, proofs(none, RULES)).count() == 0
    assert rows(proof_trees(spark.createDataFrame([("a", "p", "b")], KG), proofs(none, RULES)).select("s", "p", "o")) == [("a", "p", "b")]
