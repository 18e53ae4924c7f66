"""Dictionary lookups: synonyms, senses, hypernyms, word distance and text annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_SYNONYMS = 10


def synonyms(words: DataFrame, synsets: DataFrame, limit: int = MAX_SYNONYMS) -> DataFrame:
    """(word, synonyms): up to `limit` other members of the word's synset in word order, null for an unknown word.

    `synsets(synset, word)` has one synset per word. A synset is cut to its first `limit` + 1 members before the lookup:
    no word needs more, and a large synset never pairs its members.
    """
    order = Window.partitionBy("synset").orderBy("word")
    heads = (
        synsets.withColumn("__rank", F.row_number().over(order))
        .where(F.col("__rank") <= limit + 1)
        .groupBy("synset")
        .agg(F.sort_array(F.collect_list("word")).alias("__members"))
    )
    asked = words.select("word").distinct()
    others = F.slice(F.filter("__members", lambda m: m != F.col("word")), 1, limit)
    return (
        asked.join(synsets, "word", "left")
        .join(heads, "synset", "left")
        .select("word", others.alias("synonyms"))
    )


def pos_list(senses: DataFrame) -> DataFrame:
    """(word, all_pos, best_pos, n_senses) from senses(word, pos, gloss): best is the most frequent, then the first."""
    per_pos = senses.groupBy("word", "pos").agg(F.count("*").alias("n"))
    return per_pos.groupBy("word").agg(
        F.array_join(F.sort_array(F.collect_set("pos")), ",").alias("all_pos"),
        F.min_by("pos", F.struct(-F.col("n"), "pos")).alias("best_pos"),
        F.sum("n").alias("n_senses"),
    )


def glosses(senses: DataFrame, words: DataFrame) -> DataFrame:
    """(word, pos, gloss) of the words asked for."""
    return senses.join(words.select("word").distinct(), "word", "left_semi").select("word", "pos", "gloss").distinct()


def common_ancestors(pairs: DataFrame, closure: DataFrame) -> DataFrame:
    """(w1, w2, ancestor, distance): ancestors shared by the two words of a pair, with the path length through each.

    `closure(word, ancestor, depth)`; a word counts as its own ancestor at depth 0. Rows per pair are bounded by the
    depths of its two words.
    """
    asked = pairs.select("w1", "w2").distinct()

    def line(word: str, depth: str) -> DataFrame:
        up = closure.select(F.col("word").alias(word), "ancestor", F.col("depth").alias(depth))
        own = asked.select("w1", "w2", F.col(word).alias("ancestor"), F.lit(0).alias(depth))
        return asked.join(up, word).select("w1", "w2", "ancestor", depth).unionByName(own)

    both = line("w1", "d1").join(line("w2", "d2"), ["w1", "w2", "ancestor"])
    return both.groupBy("w1", "w2", "ancestor").agg(F.min(F.col("d1") + F.col("d2")).alias("distance"))


def word_distance(pairs: DataFrame, closure: DataFrame) -> DataFrame:
    """(w1, w2, distance): the shortest path through a shared ancestor, null when there is none."""
    least = common_ancestors(pairs, closure).groupBy("w1", "w2").agg(F.min("distance").alias("distance"))
    return pairs.select("w1", "w2").distinct().join(least, ["w1", "w2"], "left")


def annotate(doc_terms: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(doc_id, word, n): dictionary words of each document, from (doc_id, word, n) of distinct terms."""
    return doc_terms.join(lexicon, "word", "left_semi").select("doc_id", "word", "n")


def annotate_ancestors(annotated: DataFrame, closure: DataFrame, levels: int) -> DataFrame:
    """(doc_id, word, ancestor, depth): the annotations with their ancestors up to `levels`, depth 0 being the word."""
    own = annotated.select("doc_id", "word", F.col("word").alias("ancestor"), F.lit(0).alias("depth"))
    up = closure.where(F.col("depth") <= levels)
    return own.unionByName(annotated.join(up, "word").select("doc_id", "word", "ancestor", "depth"))
