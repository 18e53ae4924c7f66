"""Rules over kg(s, p, o): conjunctive bodies, one head, built-ins, provenance and fixpoints.

A type is the triple (individual, `a`, class). A rule is a join plan; what it derives carries the rule's name and the
premises used.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkg.functions.text import local_part
from textkg.operators.graph import Pattern, bgp
from textkg.session import cut_lineage

TYPE = "a"

# A built-in gets its argument columns (None for an unbound one) and its options, and returns when it applies and the
# value of every argument.
Definition = Callable[[Sequence[Column | None], Mapping[str, object]], tuple[Column, Sequence[Column]]]


def _iri_parts(args, options):
    applies, prefix, rest = local_part(args[0], str(options["separator"]))
    return applies, (args[0], prefix, rest)


def _this_year(args, options):
    year = F.lit(options["year"]) if "year" in options else F.year(F.current_date())
    return F.lit(True), (year.cast("int"),)


BUILTINS: dict[str, Definition] = {"IRIparts": _iri_parts, "thisYear": _this_year}


@dataclass(frozen=True)
class Builtin:
    """A named function in a rule body: bound arguments are compared, free ones become columns."""

    name: str
    args: tuple[str, ...]
    options: Mapping[str, object] = field(default_factory=dict)

    def apply(self, rows: DataFrame, registry: Mapping[str, Definition]) -> DataFrame:
        bound = [F.col(a) if a in rows.columns else None for a in self.args]
        applies, values = registry[self.name](bound, self.options)
        out = rows.where(applies)
        for known, value in zip(bound, values):
            if known is not None:
                out = out.where(known == value)
        return out.select(
            "*", *[value.alias(a) for a, known, value in zip(self.args, bound, values) if known is None]
        )


@dataclass(frozen=True)
class Rule:
    name: str
    body: tuple[Pattern, ...]
    head: Pattern
    builtins: tuple[Builtin, ...] = ()

    def text(self) -> str:
        atoms = [" ".join(a) for a in self.body] + [f"{b.name}({', '.join('?' + a for a in b.args)})" for b in self.builtins]
        return f"{', '.join(atoms)} -> {' '.join(self.head)}"


def _term(term: str) -> Column:
    return F.col(term[1:]) if term.startswith("?") else F.lit(term)


def _fact(pattern: Pattern) -> Column:
    return F.struct(*[_term(t).alias(n) for n, t in zip(("s", "p", "o"), pattern)])


def derive(
    kg: DataFrame,
    rule: Rule,
    registry: Mapping[str, Definition] = BUILTINS,
    facts: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """(s, p, o, rule, premises): what one rule derives from the facts, one row per set of premises.

    `facts` gives each body atom a table of its own.
    """
    rows = bgp(kg, rule.body, facts)
    for builtin in rule.builtins:
        rows = builtin.apply(rows, registry)
    return rows.select(
        *[_term(t).alias(n) for n, t in zip(("s", "p", "o"), rule.head)],
        F.lit(rule.name).alias("rule"),
        F.array(*[_fact(a) for a in rule.body]).alias("premises"),
    )


def derive_all(kg: DataFrame, rules: Sequence[Rule], registry: Mapping[str, Definition] = BUILTINS) -> DataFrame:
    return reduce(DataFrame.unionByName, [derive(kg, r, registry) for r in rules])


def fixpoint(kg: DataFrame, rules: Sequence[Rule], registry: Mapping[str, Definition] = BUILTINS) -> DataFrame:
    """(s, p, o, round): the facts (round 0) and everything the rules derive until nothing new appears.

    After the first round a derivation must use a fact of the round before: each rule runs once per body atom, with that
    atom on the new facts only.
    """
    rounds = [cut_lineage(kg.select("s", "p", "o").distinct().withColumn("round", F.lit(0)))]
    derived = derive_all(rounds[0].select("s", "p", "o"), rules, registry)
    while True:
        facts = reduce(DataFrame.unionByName, rounds)
        new = derived.select("s", "p", "o").distinct()
        fresh = cut_lineage(
            new.join(facts, ["s", "p", "o"], "left_anti").withColumn("round", F.lit(len(rounds)))
        )
        if fresh.isEmpty():
            return facts
        rounds.append(fresh)
        known = reduce(DataFrame.unionByName, rounds).select("s", "p", "o")
        derived = _derive_again(known, fresh.select("s", "p", "o"), rules, registry)


def _derive_again(known: DataFrame, latest: DataFrame, rules: Sequence[Rule], registry: Mapping[str, Definition]) -> DataFrame:
    """What the rules derive from known facts with at least one of the latest ones."""
    return reduce(
        DataFrame.unionByName,
        [
            derive(known, rule, registry, [latest if i == at else known for i in range(len(rule.body))])
            for rule in rules
            for at in range(len(rule.body))
        ],
    )


def proofs(kg: DataFrame, rules: Sequence[Rule], registry: Mapping[str, Definition] = BUILTINS) -> DataFrame:
    """(s, p, o, round, rule, premises): the facts and all they entail, each with one derivation of least depth.

    `round` is that depth, 0 for a given fact, whose rule and premises are null. The premises of a fact have lesser rounds, so derivations
    have no cycle. Among derivations of one round the first by rule name, then by premises, is kept.
    """
    given = kg.select("s", "p", "o").distinct()
    derived = derive_all(given, rules, registry)
    kinds = {f.name: f.dataType for f in derived.schema.fields}
    rounds = [
        cut_lineage(
            given.select(
                "*", F.lit(0).alias("round"), F.lit(None).cast(kinds["rule"]).alias("rule"), F.lit(None).cast(kinds["premises"]).alias("premises")
            )
        )
    ]
    while True:
        facts = reduce(DataFrame.unionByName, rounds)
        chosen = derived.groupBy("s", "p", "o").agg(F.min(F.struct("rule", "premises")).alias("by"))
        fresh = cut_lineage(
            chosen.join(facts.select("s", "p", "o"), ["s", "p", "o"], "left_anti").select(
                "s", "p", "o", F.lit(len(rounds)).alias("round"), "by.rule", "by.premises"
            )
        )
        if fresh.isEmpty():
            return facts
        rounds.append(fresh)
        known = reduce(DataFrame.unionByName, rounds).select("s", "p", "o")
        derived = _derive_again(known, fresh.select("s", "p", "o"), rules, registry)


def proof_trees(goals: DataFrame, derivations: DataFrame) -> DataFrame:
    """(goal_s, goal_p, goal_o, path, s, p, o, round, rule): the nodes of the proof tree of every goal(s, p, o).

    `path` is empty at the goal and adds the place of a premise per level, so sorting by it writes a tree from top to bottom. Leaves are given
    facts (round 0). A goal that is not entailed is one row without round. The trees are unrolled level by level from the top.
    """
    known = cut_lineage(derivations)
    level = goals.distinct().select(
        *[F.col(c).alias(f"goal_{c}") for c in ("s", "p", "o")], F.array().cast("array<int>").alias("path"), "s", "p", "o"
    )
    levels = []
    while True:
        met = cut_lineage(level.join(known, ["s", "p", "o"], "left"))
        if met.isEmpty():
            break
        levels.append(met)
        below = met.where("premises IS NOT NULL").select(
            "goal_s", "goal_p", "goal_o", "path", F.posexplode("premises").alias("place", "premise")
        )
        level = below.select(
            "goal_s", "goal_p", "goal_o", F.concat("path", F.array(F.col("place") + 1)).alias("path"), "premise.s", "premise.p", "premise.o"
        )
    rows = reduce(DataFrame.unionByName, levels) if levels else level.join(known, ["s", "p", "o"])
    return rows.select("goal_s", "goal_p", "goal_o", "path", "s", "p", "o", "round", "rule")


def proof_text(trees: DataFrame) -> DataFrame:
    """(goal_s, goal_p, goal_o, lines): the trees written with one fact a line, indented by depth; a derived fact names its rule."""
    fact = F.concat_ws(" ", "s", "p", "o")
    said = F.when(F.col("rule").isNotNull(), F.concat(fact, F.lit(" ["), "rule", F.lit("]"))).otherwise(fact)
    line = F.struct("path", F.concat(F.repeat(F.lit("    "), F.size("path")), said).alias("line"))
    written = F.transform(F.sort_array(F.collect_list(line)), lambda x: x["line"])
    return trees.groupBy("goal_s", "goal_p", "goal_o").agg(F.array_join(written, "\n").alias("lines"))


def rule_list(rules: Sequence[Rule], derived: DataFrame) -> DataFrame:
    """(rule, text, n_derived): every rule with the number of rows it derived, zero included."""
    spark = derived.sparkSession
    listed = spark.createDataFrame([(r.name, r.text()) for r in rules], "rule string, text string")
    counts = derived.groupBy("rule").agg(F.count("*").alias("n_derived"))
    return listed.join(counts, "rule", "left").withColumn("n_derived", F.coalesce("n_derived", F.lit(0)))
