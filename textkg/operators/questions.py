"""Keyword questions over kg(s, p, o): a question table in, an answer table out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkg.operators.matching import substring_pairs

NOT_FOUND = "Answer not found"


def question_predicates(questions: DataFrame, predicates: DataFrame) -> DataFrame:
    """(question, predicate, value): the predicate whose name contains a question word, and the question's last word.

    The last matching word wins, and for one word the alphabetically last predicate; predicate is null without a match.
    """
    words = questions.select("question", F.posexplode(F.split("question", " ")).alias("word_no", "word"))
    # each distinct word is matched once, so common words do not multiply
    best = (
        substring_pairs(predicates, "predicate", words.select("word").distinct(), "word")
        .groupBy("word")
        .agg(F.max("predicate").alias("predicate"))
    )
    chosen = (
        words.join(best, "word")
        .groupBy("question")
        .agg(F.max_by("predicate", F.struct("word_no", "predicate")).alias("predicate"))
    )
    return (
        questions.select("question")
        .distinct()
        .join(chosen, "question", "left")
        .select("question", "predicate", F.element_at(F.split("question", " "), -1).alias("value"))
    )


def answers(questions: DataFrame, kg: DataFrame, predicates: DataFrame) -> DataFrame:
    """(question, answer): one row per subject found, the question's first word replaced by it.

    Found and unfound questions are separate joins: an inner join can be split on either side when one value is very
    common.
    """
    asked = question_predicates(questions, predicates)
    found = asked.join(kg, (F.col("predicate") == F.col("p")) & (F.col("value") == F.col("o"))).select(
        "question",
        F.concat(F.col("s"), F.substr("question", F.length(F.substring_index("question", " ", 1)) + 1)).alias("answer"),
    )
    held = kg.select(F.col("p").alias("predicate"), F.col("o").alias("value")).distinct()
    missing = asked.join(held, ["predicate", "value"], "left_anti").select("question", F.lit(NOT_FOUND).alias("answer"))
    return found.unionByName(missing)
