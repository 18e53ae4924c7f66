"""Conjunctive patterns answered by semi-join reduction.

Patterns that share variables form a tree when they are acyclic: again and again a pattern whose shared variables all occur in one other pattern
is taken away as a leaf of that one, the smallest first by measured counts. Semi-joins up the tree and down again then leave
in every pattern only rows that take part in a solution, so no join makes rows that a later one drops. The joins run up the tree, and each
leaf hands over only the columns that are wanted or shared: a branch without wanted variables is never joined at all.

What is left of a cyclic set of patterns is reduced pairwise, the larger by the smaller, and joined step by step, each time by the join that has
the fewest rows as counted beforehand.

Cases: patterns that share no variable with the rest are refused, as their result would be a product. A pattern of constants only
tests whether it holds. Null never equals anything, so it meets no other pattern and no constant. Repeated facts count once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkg.operators.graph import Pattern, pattern_rows
from textkg.session import broadcast_if_small, cut_lineage


@dataclass
class Reduced:
    """The rows of each pattern that take part in solutions, and the tree they were reduced along."""

    rows: list[DataFrame]
    counts: list[int]  # before the reduction
    leaves: list[tuple[int, int]]  # (leaf, its parent) in the order in which they were taken away
    core: list[int]  # the root alone, or the patterns of a cycle


def variables(pattern: Pattern) -> list[str]:
    return list(dict.fromkeys(t[1:] for t in pattern if t.startswith("?")))


def join_tree(sets: Sequence[set[str]], counts: Sequence[int]) -> tuple[list[tuple[int, int]], list[int]]:
    """Leaves with their parents in order of removal, and what can't be taken away."""
    left, leaves = set(range(len(sets))), []
    while len(left) > 1:
        found = []
        for i in left:
            shared = sets[i] & set().union(*(sets[j] for j in left - {i}))
            parents = [(counts[j], j) for j in left - {i} if shared <= sets[j]]
            if parents:
                found.append((counts[i], i, min(parents)[1]))
        if not found:
            break
        _, leaf, parent = min(found)
        leaves.append((leaf, parent))
        left.remove(leaf)
    return leaves, sorted(left, key=lambda i: (counts[i], i))


def _connected(sets: Sequence[set[str]]) -> bool:
    seen, todo = set(sets[0]), list(sets[1:])
    while todo:
        near = [s for s in todo if s & seen]
        if not near:
            return False
        seen.update(*near)
        todo = [s for s in todo if s not in near]
    return True


def _kept(rows: DataFrame, by: DataFrame) -> DataFrame:
    """The rows whose shared variables occur in `by`."""
    shared = [c for c in rows.columns if c in by.columns]
    return rows.join(broadcast_if_small(by.select(*shared).distinct()), shared, "left_semi").select(*rows.columns)


def reduce_patterns(kg: DataFrame, patterns: Sequence[Pattern], facts: Sequence[DataFrame] | None = None) -> Reduced:
    """Semi-joins up and down the tree; with `facts` each pattern has a table of its own instead of `kg`. All need a variable."""
    sets = [set(variables(p)) for p in patterns]
    if not all(sets):
        raise ValueError("a pattern of constants has no rows to reduce")
    if not _connected(sets):
        raise ValueError(f"patterns share no variable with the rest: {list(patterns)}")
    rows = [pattern_rows(source, p) for source, p in zip(facts or [kg] * len(patterns), patterns)]
    counts = [r.count() for r in rows]
    leaves, core = join_tree(sets, counts)
    # each table is written when everything below it has been applied, so it is computed once
    for leaf, parent in leaves:
        rows[leaf] = cut_lineage(rows[leaf].distinct())
        rows[parent] = _kept(rows[parent], rows[leaf])
    for i in core:
        rows[i] = cut_lineage(rows[i].distinct())
    if len(core) > 1:
        for at, i in enumerate(core):
            near = [j for j in core[:at] if sets[i] & sets[j]]
            for j in near:
                rows[i] = _kept(rows[i], rows[j])
            if near:
                rows[i] = cut_lineage(rows[i])
    for leaf, parent in reversed(leaves):
        rows[leaf] = cut_lineage(_kept(rows[leaf], rows[parent]))
    return Reduced(rows, counts, leaves, core)


def solutions(
    kg: DataFrame, patterns: Sequence[Pattern], wanted: Sequence[str] | None = None, facts: Sequence[DataFrame] | None = None
) -> DataFrame:
    """The distinct values of the wanted variables (all by default) over all solutions of the patterns."""
    sources = list(facts or [kg] * len(patterns))
    every = list(dict.fromkeys(name for p in patterns for name in variables(p)))
    wanted = list(wanted or every)
    unknown = [w for w in wanted if w not in every]
    if unknown:
        raise ValueError(f"no pattern has the variables {unknown}")
    tests = [i for i, p in enumerate(patterns) if not variables(p)]
    holds = all(not pattern_rows(sources[i], patterns[i]).isEmpty() for i in tests)
    open_ = [i for i in range(len(patterns)) if i not in tests]
    if not holds:
        none = [pattern_rows(sources[i], patterns[i]).where(F.lit(False)) for i in open_]
        typed = {f.name: f.dataType for rows in none for f in rows.schema}
        return none[0].select(*[F.lit(None).cast(typed[w]).alias(w) for w in wanted])
    found = reduce_patterns(kg, [patterns[i] for i in open_], [sources[i] for i in open_])
    rows = list(found.rows)
    for leaf, parent in found.leaves:
        own, above = rows[leaf].columns, rows[parent].columns
        shared = [c for c in own if c in above]
        new = [c for c in own if c not in above and c in wanted]
        if new:  # else the semi-joins have said all
            rows[parent] = rows[parent].join(rows[leaf].select(*shared, *new).distinct(), shared)
    out, _ = join_core([rows[i] for i in found.core])
    return out.select(*wanted).distinct()


def _met(left: DataFrame, right: DataFrame) -> float:
    """How many rows the join on all shared columns has, from the rows of each key."""
    shared = [c for c in left.columns if c in right.columns]
    per_key = [t.groupBy(*shared).agg(F.count("*").cast("double").alias(name)) for t, name in ((left, "__left"), (right, "__right"))]
    return per_key[0].join(per_key[1], shared).agg(F.sum(F.col("__left") * F.col("__right"))).first()[0] or 0.0


def join_core(tables: Sequence[DataFrame]) -> tuple[DataFrame, list[float]]:
    """The join of tables on all columns they share, and the rows of each step that was measured.

    Each step takes the pair, then the table, whose join has the fewest rows: two small tables that meet in a column of few values would else give
    their product. The last table needs no choice. Steps before it are written.
    """
    out, left, sizes = tables[0], list(tables[1:]), []
    while left:
        near = [(None, t) for t in left if set(t.columns) & set(out.columns)]
        if not sizes and len(left) > 1:
            near = [(a, b) for i, a in enumerate(tables) for b in tables[i + 1 :] if set(a.columns) & set(b.columns)]
        if len(left) > 1:
            measured = [_met(out if a is None else a, b) for a, b in near]
            sizes.append(min(measured))
            first, following = near[measured.index(sizes[-1])]
            if first is not None:
                out, left = first, [t for t in tables if t is not first]
        else:
            following = near[0][1]
        left = [t for t in left if t is not following]
        out = out.join(following, [c for c in following.columns if c in out.columns])
        if left:
            out = cut_lineage(out)
    return out, sizes


def reduction_report(found: Reduced, patterns: Sequence[Pattern]) -> DataFrame:
    """(pattern, n_rows, n_kept) of each pattern: facts it meets, and distinct ones that solutions use."""
    parts = [
        rows.agg(F.count("*").alias("n_kept")).select(F.lit(" ".join(p)).alias("pattern"), F.lit(n).cast("bigint").alias("n_rows"), "n_kept")
        for rows, n, p in zip(found.rows, found.counts, patterns)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
