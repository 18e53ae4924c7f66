"""Patterns by semi-join reduction, against all assignments tried one by one."""

from __future__ import annotations

import random

import pytest
from conftest import rows

from textkg.operators.patterns import join_core, join_tree, reduce_patterns, solutions, variables

KG = "s string, p string, o string"


def brute(facts, patterns):
    """All solutions as dictionaries. Null equals nothing, so a variable of several places can't be null."""
    found = [{}]
    for pattern in patterns:
        after = []
        for known in found:
            for fact in set(facts):
                own, fits = dict(known), True
                for term, value in zip(pattern, fact):
                    if not term.startswith("?"):
                        fits = fits and term == value
                    elif term[1:] in own:
                        fits = fits and value is not None and own[term[1:]] == value
                    else:
                        own[term[1:]] = value
                if fits:
                    after.append(own)
        found = after
    return found


def picked(found, wanted):
    return sorted({tuple(f[w] for w in wanted) for f in found}, key=repr)


TREE = [("?a", "p", "?b"), ("?b", "q", "?c"), ("?b", "r", "?d"), ("?a", "q", "n1")]
CYCLE = [("?a", "p", "?b"), ("?b", "q", "?c"), ("?c", "r", "?a"), ("?c", "p", "?e")]
CHAINS = [("?a", "p", "?b"), ("?b", "q", "?c"), ("?c", "r", "?d"), ("?a", "q", "?x"), ("?x", "p", "?y"), ("?y", "q", "n2")]
LOOP = [("?a", "p", "?a"), ("?a", "q", "?b")]


def graph(seed, n):
    rng = random.Random(seed)
    name = lambda: rng.choice([None, *[f"n{i}" for i in range(7)]]) if rng.random() < 0.3 else f"n{rng.randrange(7)}"
    facts = [(name(), rng.choice([*"ppqqrr", None]), name()) for _ in range(n)]
    return facts + facts[: n // 5]


@pytest.mark.parametrize("patterns", [TREE, CHAINS, CYCLE, LOOP])
def test_all_variables(spark, patterns):
    names = list(dict.fromkeys(v for p in patterns for v in variables(p)))
    facts = graph(len(patterns), 60)
    want = picked(brute(facts, patterns), names)
    assert want
    assert sorted(rows_of(solutions(spark.createDataFrame(facts, KG), patterns)), key=repr) == want


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_wanted_variables_come_once(spark):
    facts = graph(5, 60)
    got = rows_of(solutions(spark.createDataFrame(facts, KG), TREE, ["d", "a"]))
    assert sorted(got, key=repr) == picked(brute(facts, TREE), ["d", "a"])


def test_every_row_kept_takes_part(spark):
    facts = graph(7, 80)
    found = reduce_patterns(spark.createDataFrame(facts, KG), TREE)
    assert len(found.core) == 1
    for table, pattern in zip(found.rows, TREE):
        assert sorted(rows_of(table), key=repr) == picked(brute(facts, TREE), variables(pattern))


def test_empty_and_constants(spark):
    empty = spark.createDataFrame([], KG)
    assert rows(solutions(empty, TREE)) == []
    kg = spark.createDataFrame([("x", "p", "y"), ("u", "q", "v"), ("u", "q", "v")], KG)
    assert rows(solutions(kg, [("?a", "p", "?b"), ("u", "q", "v")])) == [("x", "y")]
    nothing = solutions(kg, [("?a", "p", "?b"), ("u", "q", "w")], ["b"])
    assert rows(nothing) == [] and nothing.columns == ["b"]


def test_refusals(spark):
    kg = spark.createDataFrame([("x", "p", "y")], KG)
    with pytest.raises(ValueError, match="share no variable"):
        solutions(kg, [("?a", "p", "?b"), ("?c", "p", "?d")])
    with pytest.raises(ValueError, match="no pattern has"):
        solutions(kg, [("?a", "p", "?b")], ["z"])


def test_tree_starts_with_the_smallest_leaf():
    sets = [{"a", "b"}, {"b", "c"}, {"c", "d"}]
    assert join_tree(sets, [5, 9, 2]) == ([(2, 1), (0, 1)], [1])
    assert join_tree([{"a", "b"}, {"b", "c"}, {"c", "a"}], [3, 2, 1]) == ([], [2, 1, 0])


def test_a_cycle_is_joined_along_its_keys(spark):
    """Customers and suppliers of one place meet through their orders, not each with each."""
    n = 200
    home = [spark.createDataFrame([(f"{c}{i}", "here") for i in range(n)], f"{c} string, n string") for c in "cs"]
    orders = [(f"q{i}", f"c{i % n}") for i in range(2 * n)]
    deals = [(f"q{i}", f"s{i * 7 % n}") for i in range(2 * n)]
    tables = [*home, spark.createDataFrame(orders, "q string, c string"), spark.createDataFrame(deals, "q string, s string")]
    out, sizes = join_core(tables)
    assert out.count() == 2 * n and max(sizes) <= 2 * n
    kg = [(c, "inNation", p) for t in home for c, p in rows(t)] + [(q, "placedBy", c) for q, c in orders] + [(q, "by", s) for q, s in deals]
    found = solutions(
        spark.createDataFrame(kg, KG), [("?q", "placedBy", "?c"), ("?c", "inNation", "?n"), ("?q", "by", "?s"), ("?s", "inNation", "?n")], ["q", "s"]
    )
    assert rows(found) == sorted(deals)
