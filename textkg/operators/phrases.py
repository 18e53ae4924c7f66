"""Annotation of texts with dictionary terms of any number of words.

The terms are a token trie kept as a table: one row per edge (node, token, child), with the term where one ends. Texts walk it by joins: every
place of a text that a trie path can start at follows the edge of its next token, one join per level, and remembers the longest term
so far. A path of two or more words starts with its first two words at once, so a frequent first word alone opens no path.
Per document, overlapping finds are then thinned to the leftmost, and among those of one place the longest.

Nothing is collected: the trie side of a join is broadcast only when it was measured small, and else both sides are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkg.session import broadcast_if_small, cut_lineage


def term_trie(terms: DataFrame) -> DataFrame:
    """(depth, node, token, child, term): the edges of the trie of terms(words ARRAY<STRING>); `term` is set where one ends.

    Nodes are named by the words that lead to them. Empty and null terms are left out, repeated ones count once.
    """
    words = F.filter("words", lambda w: w.isNotNull())
    clean = terms.select(words.alias("words")).where(F.size("words") > 0).distinct()
    steps = clean.select("words", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("depth"))
    prefix = F.array_join(F.slice("words", F.lit(1), F.col("depth")), " ")
    edges = steps.select(
        "depth",
        F.array_join(F.slice("words", F.lit(1), F.col("depth") - 1), " ").alias("node"),
        F.element_at("words", F.col("depth")).alias("token"),
        prefix.alias("child"),
        F.when(F.col("depth") == F.size("words"), prefix).alias("term"),
    )
    return edges.groupBy("depth", "node", "token", "child").agg(F.max("term").alias("term"))


def longest_terms(docs: DataFrame, trie: DataFrame) -> DataFrame:
    """(doc_id, place, length, term): for every place of docs(doc_id, words) that a term starts at, the longest one."""
    trie = cut_lineage(trie)
    depth = trie.agg(F.max("depth")).first()[0] or 0

    def level(at: int, *columns) -> DataFrame:
        return broadcast_if_small(trie.where(F.col("depth") == at).select(*columns))

    places = docs.select("doc_id", "words", F.posexplode("words").alias("place", "token"))
    # what may still be read from a place
    ahead = F.slice("words", F.col("place") + 1, F.lit(max(depth, 1)))
    second = F.get("words", F.col("place") + 1)
    open_paths = places.select(
        "doc_id", "place", "token", F.concat_ws(" ", "token", second).alias("pair"), ahead.alias("ahead")
    )
    one = level(1, F.col("token"), F.col("term").alias("first_term")).where("first_term IS NOT NULL")
    walk = open_paths.join(one, "token", "left")
    pairs = level(2, F.col("child").alias("pair"), F.col("child").alias("node"), F.col("term").alias("pair_term"))
    walk = (
        walk.join(pairs, "pair", "left")
        .where("first_term IS NOT NULL OR node IS NOT NULL")
        .select(
            "doc_id", "place", "ahead", "node",
            F.when(F.col("pair_term").isNotNull(), 2).when(F.col("first_term").isNotNull(), 1).alias("length"),
        )
    )
    for at in range(3, depth + 1):
        edges = level(at, "node", F.col("token").alias("next"), F.col("child"), F.col("term").alias("found"))
        # a path that has ended gets a name of its own, so ended paths don't meet on one key
        ended = F.concat(F.lit("\n"), F.xxhash64("doc_id", "place").cast("string"))
        walk = (
            walk.select("doc_id", "place", "ahead", "length", F.coalesce("node", ended).alias("node"), F.get("ahead", F.lit(at - 1)).alias("next"))
            .join(edges, ["node", "next"], "left")
            .select(
                "doc_id", "place", "ahead", F.col("child").alias("node"),
                F.when(F.col("found").isNotNull(), at).otherwise(F.col("length")).alias("length"),
            )
        )
    return walk.where("length IS NOT NULL").select(
        "doc_id", "place", "length", F.array_join(F.slice("ahead", F.lit(1), F.col("length")), " ").alias("term")
    )


def without_overlaps(found: DataFrame) -> DataFrame:
    """The rows of found(doc_id, place, length, ...), one per place, that remain when each is taken from left to right unless it
    overlaps the one taken before.

    A document's rows are cut where no row reaches across, and only the short stretches between are folded.
    """
    in_order = Window.partitionBy("doc_id").orderBy("place")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.col("place") + F.col("length")).over(before)
    fresh = F.when(F.col("place") < reach, 0).otherwise(1)
    stretches = found.withColumn("__fresh", fresh).withColumn("__stretch", F.sum("__fresh").over(in_order)).drop("__fresh")
    rows = F.struct("place", *[c for c in found.columns if c not in ("doc_id", "place")])
    gathered = stretches.groupBy("doc_id", "__stretch").agg(F.sort_array(F.collect_list(rows)).alias("rows"))
    none = F.filter("rows", lambda r: F.lit(False))
    taken = F.aggregate(
        "rows",
        F.struct(F.lit(-1).alias("end"), none.alias("kept")),
        lambda acc, r: F.when(
            r["place"] >= acc["end"],
            F.struct((r["place"] + r["length"]).alias("end"), F.concat(acc["kept"], F.array(r)).alias("kept")),
        ).otherwise(acc),
        lambda acc: acc["kept"],
    )
    return gathered.select("doc_id", F.inline(taken)).select(*found.columns)


def annotate_phrases(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, place, length, term): leftmost longest terms(words) in docs(doc_id, words), without overlaps; ids identify documents."""
    return without_overlaps(longest_terms(docs, term_trie(terms)))
