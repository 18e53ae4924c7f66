"""Word, tag and dictionary counts, per-document summaries and metric reports.

Counts run on tokens as partial and final hash aggregates. Per-document figures are array expressions on the document's
own row and do not shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkg.functions.tagging import lemmas
from textkg.functions.text import tokens
from textkg.session import once


def lemma_tokens(corpus: DataFrame) -> DataFrame:
    """(doc_id, lemma, pos), one row per lemma."""
    return corpus.select("doc_id", F.inline(lemmas(tokens(F.col("text")))))


def gram_rows(docs: DataFrame, words: str, *sizes: int) -> DataFrame:
    """(size, gram), one row per window of each size in an array of words without nulls, the windows `ngrams` lists.

    Places are rows before words are joined, so this runs as compiled code and not as a lambda per place.
    """
    held = docs.select(F.col(words).alias("__words")).where(F.size("__words") > 0)
    last = F.size("__words") - min(sizes)
    at = held.select("__words", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).alias("__at"))

    def gram(n: int) -> Column:
        window = F.concat_ws(" ", *[F.get("__words", F.col("__at") + i) for i in range(n)])
        return F.when((F.col("__at") == 0) | (F.col("__at") <= F.size("__words") - n), window)

    found = F.array(*[F.struct(F.lit(n).alias("size"), gram(n).alias("gram")) for n in sizes])
    return at.select(F.inline(found)).where("gram IS NOT NULL")


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def dictionary_hits(counts: DataFrame, word: str, dictionary: DataFrame) -> DataFrame:
    """Add `known` (1 or 0) and `hits` = n * known to a table of word counts; `dictionary(word)` holds distinct words.

    Joining counts rather than tokens moves each distinct word once.
    """
    known = dictionary.select(F.col("word").alias(word), F.lit(1).alias("__known"))
    return (
        counts.join(known, word, "left")
        .withColumn("known", F.coalesce("__known", F.lit(0)))
        .withColumn("hits", F.col("n") * F.col("known"))
        .drop("__known")
    )


def noun_verb_sets(corpus: DataFrame) -> DataFrame:
    """(doc_id, n_nouns, n_verbs, nouns, verbs): totals and sorted distinct lemmas per document."""
    found = once(corpus.select("doc_id", "text"), "l", lemmas(tokens(F.col("text"))))

    def lemma_list(tag: str) -> Column:
        return F.transform(F.filter("l", lambda p: p["pos"].rlike(f"^{tag}")), lambda p: p["lemma"])

    split = once(once(found, "nn", lemma_list("nn")), "vb", lemma_list("vb"))
    return split.select(
        "doc_id",
        F.size("nn").cast("bigint").alias("n_nouns"),
        F.size("vb").cast("bigint").alias("n_verbs"),
        F.sort_array(F.array_distinct("nn")).alias("nouns"),
        F.sort_array(F.array_distinct("vb")).alias("verbs"),
    )


def noun_verb_report(corpus: DataFrame, skip: Column | None = None) -> DataFrame:
    """(doc_id, report): count, nouns, blank line, count, verbs; documents lacking either kind are left out."""
    kept = corpus if skip is None else corpus.where(~skip)
    s = noun_verb_sets(kept).where((F.col("n_nouns") > 0) & (F.col("n_verbs") > 0))
    return s.select(
        "doc_id",
        F.concat_ws(
            "\n",
            F.col("n_nouns").cast("string"),
            F.array_join("nouns", "\n"),
            F.lit(""),
            F.col("n_verbs").cast("string"),
            F.array_join("verbs", "\n"),
        ).alias("report"),
    )


def metric_rows(one_row: DataFrame) -> DataFrame:
    """(name, value) rows from the columns of a one-row aggregate."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("bigint").alias("value")) for c in one_row.columns]
    )
    return one_row.select(F.inline(pairs))


def last_value(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """(key, value): the value written last per key."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))
