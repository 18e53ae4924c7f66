"""Part-of-speech and lemma rules as CASE expressions, with an optional dictionary on top."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Closed word classes; open classes fall to the suffix rules below.
DETERMINERS = "a an the this that these those of in on at by for with from to and or as".split()
AUXILIARIES = "is are was were be has".split()

# Domain synonyms: a lemma on the left is replaced by the term on the right.
SYNONYMS = {"ad": "alzheimers_disease"}


def pos_tag(word: Column) -> Column:
    return (
        F.when(word.isin(*DETERMINERS), "dt")
        .when(word.isin(*AUXILIARIES), "vb")
        .when(word.endswith("ing") | word.endswith("ed"), "vb")
        .when(word.endswith("ly"), "rb")
        .otherwise("nn")
    )


def lemma(word: Column) -> Column:
    size = F.length(word)
    return (
        F.when((size > 4) & word.endswith("ies"), F.concat(F.left(word, size - 3), F.lit("y")))
        .when((size > 5) & word.endswith("ing"), F.left(word, size - 3))
        .when((size > 4) & word.endswith("ed"), F.left(word, size - 2))
        .when((size > 3) & word.endswith("s") & ~word.endswith("ss"), F.left(word, size - 1))
        .otherwise(word)
    )


def normalize_term(word: Column, synonyms: dict[str, str] = SYNONYMS) -> Column:
    out = word
    for source, target in synonyms.items():
        out = F.when(word == source, target).otherwise(out)
    return out


def lemmas(words: Column) -> Column:
    """array<struct<lemma,pos>> for an array of tokens; lemmas of one letter are dropped."""
    pairs = F.transform(words, lambda w: F.struct(normalize_term(lemma(w)).alias("lemma"), pos_tag(w).alias("pos")))
    return F.filter(pairs, lambda p: F.length(p["lemma"]) > 1)


def with_dictionary(tokens: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Tag a `surface` column from dictionary(surface, lemma, pos); words it lacks use the rules.

    `dictionary` has one row per surface form, so the join never multiplies rows. Join a word count instead of raw
    tokens where only counts are needed.
    """
    d = dictionary.select(
        "surface", F.col("lemma").alias("__lemma"), F.col("pos").alias("__pos")
    )
    return (
        tokens.join(d, "surface", "left")
        .withColumn("lemma", F.coalesce("__lemma", normalize_term(lemma(F.col("surface")))))
        .withColumn("pos", F.coalesce("__pos", pos_tag(F.col("surface"))))
        .drop("__lemma", "__pos")
    )
