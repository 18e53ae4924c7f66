"""Queries over kg(s, p, o) and types(ind, class)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Pattern = tuple[str, str, str]


def pattern_rows(kg: DataFrame, pattern: Pattern) -> DataFrame:
    """One column per variable of the pattern; a variable used twice must have equal values."""
    out = kg
    named: dict[str, str] = {}
    for column, term in zip(("s", "p", "o"), pattern):
        if not term.startswith("?"):
            out = out.where(F.col(column) == term)
        elif term[1:] in named:
            out = out.where(F.col(column) == F.col(named[term[1:]]))
        else:
            named[term[1:]] = column
    return out.select(*[F.col(column).alias(name) for name, column in named.items()])


def bgp(kg: DataFrame, patterns: Sequence[Pattern], facts: Sequence[DataFrame] | None = None) -> DataFrame:
    """Basic graph pattern: strings starting with `?` are variables, others constants.

    Patterns are joined on the variables they share; one that shares none with the rest is refused, as its result would
    be a product. `facts` gives each pattern a table of its own instead of `kg`.
    """
    left = list(zip(patterns, facts if facts is not None else [kg] * len(patterns)))
    first, source = left.pop(0)
    out = pattern_rows(source, first)
    while left:
        at = next(
            (i for i, (p, _) in enumerate(left) if any(t[1:] in out.columns for t in p if t.startswith("?"))), None
        )
        if at is None:
            raise ValueError(f"patterns share no variable with the rest: {[p for p, _ in left]}")
        following, source = left.pop(at)
        right = pattern_rows(source, following)
        shared = [c for c in right.columns if c in out.columns]
        # a pattern whose variables are all known only tests, so it must not multiply rows
        how = "left_semi" if set(right.columns) == set(shared) else "inner"
        out = out.join(right, shared, how)
    named = dict.fromkeys(t[1:] for p in patterns for t in p if t.startswith("?"))
    return out.select(*named)


def instances(types: DataFrame, class_closure: DataFrame) -> DataFrame:
    """(ind, class, asserted): asserted types and those implied by superclasses(class, ancestor)."""
    asserted = types.select("ind", "class").distinct()
    above = class_closure.select("class", F.col("ancestor").alias("__up")).where("class <> __up")
    implied = asserted.join(above, "class").select("ind", F.col("__up").alias("class"))
    tagged = asserted.withColumn("asserted", F.lit(True)).unionByName(implied.withColumn("asserted", F.lit(False)))
    return tagged.groupBy("ind", "class").agg(F.bool_or("asserted").alias("asserted"))


def equivalent_classes(class_closure: DataFrame) -> DataFrame:
    """(class, equivalent): classes that subsume each other, without the class itself."""
    back = class_closure.select(F.col("class").alias("ancestor"), F.col("ancestor").alias("class"))
    return (
        class_closure.select("class", "ancestor")
        .join(back, ["class", "ancestor"], "left_semi")
        .where("class <> ancestor")
        .select("class", F.col("ancestor").alias("equivalent"))
    )


def has_value(kg: DataFrame, prop: str, value: str) -> DataFrame:
    """(ind): individuals with the value for the property."""
    return kg.where((F.col("p") == prop) & (F.col("o") == value)).select(F.col("s").alias("ind")).distinct()


def class_intersection(
    all_types: DataFrame, kg: DataFrame, name: str, restrictions: Sequence[tuple[str, str]]
) -> DataFrame:
    """(ind): members of a class that have all (property, value) pairs; one semi-join each."""
    out = all_types.where(F.col("class") == name).select("ind").distinct()
    for prop, value in restrictions:
        out = out.join(has_value(kg, prop, value), "ind", "left_semi")
    return out


def property_values(kg: DataFrame, individuals: DataFrame) -> DataFrame:
    """(s, p, o) of the individuals(ind)."""
    return kg.join(individuals, kg.s == individuals.ind, "left_semi")


def inverse_values(kg: DataFrame, inverses: DataFrame) -> DataFrame:
    """(s, p, o) of inverse properties, given inverses(p, inverse)."""
    return kg.join(inverses, "p").select(
        F.col("o").alias("s"), F.col("inverse").alias("p"), F.col("s").alias("o")
    )


def property_domains(axioms: DataFrame, class_closure: DataFrame, kind: str = "DataPropertyDomain") -> DataFrame:
    """(property, class, asserted): domains of properties and the superclasses of those."""
    domains = axioms.where(F.col("kind") == kind).select(F.col("s").alias("ind"), F.col("o").alias("class"))
    return instances(domains, class_closure).withColumnRenamed("ind", "property")


def entailed(candidates: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates with `entailed`, true when the fact table holds them."""
    known = facts.select(*keys).distinct().withColumn("__known", F.lit(True))
    return candidates.join(known, list(keys), "left").withColumn(
        "entailed", F.coalesce("__known", F.lit(False))
    ).drop("__known")


def label_by_language(
    labels: DataFrame, ind: str, text: str, lang: str, tie: str, wanted: Sequence[str]
) -> DataFrame:
    """(ind, text, lang): the label in the first wanted language present, else an untagged one; others do not count."""
    rank = F.when(F.col(lang).isNull(), len(wanted) + 1)
    for i, code in enumerate(wanted, 1):
        rank = rank.when(F.col(lang) == code, i)
    order = F.struct(rank.alias("r"), F.col(tie).alias("t"))
    return (
        labels.withColumn("__rank", rank)
        .where("__rank IS NOT NULL")
        .groupBy(ind)
        .agg(F.min_by(F.struct(text, lang), order).alias("__best"))
        .select(ind, f"__best.{text}", f"__best.{lang}")
    )
