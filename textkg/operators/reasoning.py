"""Evidence of relation patterns in triples(s, p, o), taken as a set.

Pairs that mirror each other are listed: a triple meets at most one mirror per predicate. Pairs that chain through a
middle node multiply the edges on both sides of it, so they are counted from node degrees, without forming the pairs;
`chain_pairs` lists them for the middle nodes asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _set(triples: DataFrame) -> DataFrame:
    return triples.select("s", "p", "o").distinct()


def symmetric(triples: DataFrame) -> DataFrame:
    """(s, p, o): triples whose mirror with the same predicate exists; a loop is its own mirror."""
    t = _set(triples)
    mirror = t.select(F.col("o").alias("s"), "p", F.col("s").alias("o"))
    return t.join(mirror, ["s", "p", "o"], "left_semi")


def mirrored(triples: DataFrame) -> DataFrame:
    """(s, p, o, p2): triples with a mirror (o, p2, s), any predicate."""
    t = _set(triples)
    back = t.select(F.col("o").alias("s"), F.col("p").alias("p2"), F.col("s").alias("o"))
    return t.join(back, ["s", "o"]).select("s", "p", "o", "p2")


def inverse(triples: DataFrame) -> DataFrame:
    """(s, p, o, p2): mirrors under another predicate."""
    return mirrored(triples).where("p <> p2")


def asymmetry_violations(triples: DataFrame, declared: Sequence[str]) -> DataFrame:
    """(s, p, o, p2): triples of a declared asymmetric predicate that have a mirror of any predicate."""
    t = _set(triples)
    back = t.select(F.col("o").alias("s"), F.col("p").alias("p2"), F.col("s").alias("o"))
    return t.where(F.col("p").isin(*declared)).join(back, ["s", "o"]).select("s", "p", "o", "p2")


def irreflexive_violations(triples: DataFrame) -> DataFrame:
    """(s, p, o): loops."""
    return _set(triples.where("s = o"))


def _degrees(t: DataFrame) -> DataFrame:
    """(node, p, n_in, n_out)."""
    ends = F.array(
        F.struct(F.col("o").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("u")),
        F.struct(F.col("s").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("u")),
    )
    return (
        t.select("p", F.inline(ends)).groupBy("node", "p").agg(F.sum("i").alias("n_in"), F.sum("u").alias("n_out"))
    )


def chain_counts(triples: DataFrame) -> DataFrame:
    """(p, p2, n): pairs (a, p, m), (m, p2, b) with a <> b, per predicate pair.

    All pairs through m are in-degree times out-degree; those that return to a are the mirrored ones and are taken off.
    """
    t = _set(triples)
    degrees = _degrees(t)
    into = degrees.where("n_in > 0").select("node", "p", "n_in")
    out = degrees.where("n_out > 0").select("node", F.col("p").alias("p2"), "n_out")
    # rows per node are at most its number of predicates on either side
    through = into.join(out, "node").groupBy("p", "p2").agg(F.sum(F.col("n_in") * F.col("n_out")).alias("n"))
    returning = mirrored(t).groupBy("p", "p2").agg(F.count("*").alias("back"))
    return (
        through.join(returning, ["p", "p2"], "left")
        .select("p", "p2", (F.col("n") - F.coalesce("back", F.lit(0))).alias("n"))
        .where("n > 0")
    )


def transitive_counts(triples: DataFrame) -> DataFrame:
    """(p, n): pairs that support transitivity of p."""
    return chain_counts(triples).where("p = p2").select("p", "n")


def property_chain_counts(triples: DataFrame) -> DataFrame:
    """(p, p2, n): pairs that support a chain of two different predicates."""
    return chain_counts(triples).where("p <> p2")


def chain_pairs(triples: DataFrame, middle: DataFrame, salts: int = 32) -> DataFrame:
    """(s, p, m, p2, o): the pairs through the nodes of middle(m), written out.

    The edges into a node are dealt over `salts` parts and the edges out of it copied to each, so the pairs of one hot
    node are formed by many tasks.
    """
    t = _set(triples)
    into = (
        t.select("s", "p", F.col("o").alias("m"))
        .join(middle, "m", "left_semi")
        .withColumn("salt", F.pmod(F.xxhash64("s", "p"), F.lit(salts)))
    )
    out = (
        t.select(F.col("s").alias("m"), F.col("p").alias("p2"), "o")
        .join(middle, "m", "left_semi")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    )
    return into.join(out, ["m", "salt"]).where("s <> o").select("s", "p", "m", "p2", "o")


def consistency_violations(
    triples: DataFrame, functional: Sequence[str], asymmetric: Sequence[str], irreflexive: Sequence[str]
) -> DataFrame:
    """(violation, s, p, n): functional values over one, asymmetric mirrors, irreflexive loops; none means consistent."""
    t = _set(triples)
    many = (
        t.where(F.col("p").isin(*functional)).groupBy("s", "p").agg(F.count("*").alias("n")).where("n > 1")
    ).select(F.lit("functional").alias("violation"), "s", "p", "n")
    mirrors = (
        asymmetry_violations(t, asymmetric)
        .where("p = p2")
        .groupBy("s", "p")
        .agg(F.count("*").alias("n"))
        .select(F.lit("asymmetric").alias("violation"), "s", "p", "n")
    )
    loops = irreflexive_violations(t.where(F.col("p").isin(*irreflexive))).select(
        F.lit("irreflexive").alias("violation"), "s", "p", F.lit(1).cast("bigint").alias("n")
    )
    return many.unionByName(mirrors).unionByName(loops)
