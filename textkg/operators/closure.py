"""Iterative graph operators: bounded or full transitive closure, and connected components.

Each round is one join followed by a reliable checkpoint, so plans stay short and a lost executor costs one round. Only
new pairs enter the next round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkg.session import cut_lineage


def transitive_closure(edges: DataFrame, child: str, parent: str, max_depth: int | None = None) -> DataFrame:
    """(child, ancestor, depth): every ancestor once, at its least depth; cycles end when nothing new appears."""
    step = cut_lineage(edges.select(F.col(child).alias("__from"), F.col(parent).alias("__to")).distinct())
    fresh = step.select(F.col("__from").alias(child), F.col("__to").alias("ancestor"), F.lit(1).alias("depth"))
    rounds = [fresh]
    depth = 1
    while max_depth is None or depth < max_depth:
        depth += 1
        seen = reduce(DataFrame.unionByName, rounds)
        reached = (
            fresh.join(step, F.col("ancestor") == F.col("__from"))
            .select(child, F.col("__to").alias("ancestor"))
            .distinct()
        )
        fresh = cut_lineage(
            reached.join(seen, [child, "ancestor"], "left_anti").withColumn("depth", F.lit(depth))
        )
        if fresh.isEmpty():
            break
        rounds.append(fresh)
    return reduce(DataFrame.unionByName, rounds)


def direct_pairs(closure: DataFrame, child: str) -> DataFrame:
    """(child, ancestor): pairs of a closure with nothing strictly between; members of one cycle count as equal."""
    pairs = closure.select(F.col(child).alias("lo"), F.col("ancestor").alias("hi"))
    back = pairs.select(F.col("hi").alias("lo"), F.col("lo").alias("hi"))
    proper = cut_lineage(pairs.where("lo <> hi").join(back, ["lo", "hi"], "left_anti"))
    above = proper.select(F.col("lo").alias("mid"), F.col("hi").alias("top"))
    implied = proper.join(above, F.col("hi") == F.col("mid")).select("lo", F.col("top").alias("hi")).distinct()
    return proper.join(implied, ["lo", "hi"], "left_anti").select(
        F.col("lo").alias(child), F.col("hi").alias("ancestor")
    )


def star_edges(members: DataFrame, key: str, node: str) -> DataFrame:
    """(a, b) linking each node to the least node of its key: n edges for a group of n, not n * n."""
    heads = members.groupBy(key).agg(F.min(node).alias("__head"))
    return (
        members.join(heads, key)
        .select(F.col(node).alias("a"), F.col("__head").alias("b"))
        .where("a <> b")
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) from edges (a, b), the component being its least node.

    Alternates two star steps: every larger neighbour of a node is moved to the least neighbour, then every node's
    smaller neighbours are. The distance to the least node shrinks geometrically, also on chains, and edges never grow in
    number. Hot nodes meet one precomputed minimum each, so AQE can split them.
    """
    current = cut_lineage(
        edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u <> v").distinct()
    )
    before = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("m").alias("u"), "v")
            .distinct()
        )
        # edges now point from the lesser to the greater node; each greater node keeps its least neighbour
        kept = cut_lineage(large)
        low = kept.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            kept.join(low, "v")
            .select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v"))
            .where("u <> v")
            .distinct()
        )
        current = cut_lineage(small)
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    # at rest every edge is (component, node)
    members = current.select(F.col("v").alias("node"), F.col("u").alias("component"))
    heads = current.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return members.unionByName(heads)
