"""Subject-predicate-object candidates of one sentence, computed inside its row.

A sentence is cut into maximal runs of noun-like, verb-like and other words (determiners and prepositions removed); each
noun run, verb run, noun run in a row is a candidate. Positions are found with index filters over arrays, so the cost is
linear in the sentence and no window or shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textkg.functions.tagging import pos_tag
from textkg.functions.text import let

_CHUNKS = "array<struct<kind:string,words:string>>"
_TRIPLES = "array<struct<subject:string,predicate:string,object:string>>"


def _kind(tag: Column) -> Column:
    return F.when(tag == "nn", "N").when(tag == "vb", "V").otherwise("X")


def chunks(words: Column) -> Column:
    """array<struct<kind,words>> of the runs in an array of tokens."""

    def of_tagged(tagged: Column) -> Column:
        return let(
            F.filter(
                F.transform(
                    tagged, lambda t, i: F.when((i == 0) | (t["kind"] != F.get(tagged, i - 1)["kind"]), i)
                ),
                lambda i: i.isNotNull(),
            ),
            lambda starts: F.transform(
                starts,
                lambda at, j: F.struct(
                    F.get(tagged, at)["kind"].alias("kind"),
                    F.array_join(
                        F.slice(
                            tagged["word"], at + 1, F.coalesce(F.get(starts, j + 1), F.size(tagged)) - at
                        ),
                        " ",
                    ).alias("words"),
                ),
            ),
        )

    tagged = F.filter(
        F.transform(words, lambda w: F.struct(w.alias("word"), pos_tag(w).alias("pos"))), lambda t: t["pos"] != "dt"
    )
    kinds = F.transform(tagged, lambda t: F.struct(t["word"].alias("word"), _kind(t["pos"]).alias("kind")))
    return let(kinds, of_tagged).cast(_CHUNKS)


def candidates(words: Column) -> Column:
    """array<struct<subject,predicate,object>> in sentence order."""

    def of_chunks(c: Column) -> Column:
        hits = F.filter(
            F.transform(
                c,
                lambda x, i: F.when(
                    (x["kind"] == "N") & (F.get(c, i + 1)["kind"] == "V") & (F.get(c, i + 2)["kind"] == "N"),
                    F.struct(
                        x["words"].alias("subject"),
                        F.get(c, i + 1)["words"].alias("predicate"),
                        F.get(c, i + 2)["words"].alias("object"),
                    ),
                ),
            ),
            lambda t: t.isNotNull(),
        )
        return hits

    return let(chunks(words), of_chunks).cast(_TRIPLES)


def longest(found: Column) -> Column:
    """Ordered fold: a later candidate wins when its subject is at least as long and its object longer.

    The start value is the empty triple, so a sentence without candidates gives empty strings.
    """
    empty = F.struct(F.lit("").alias("subject"), F.lit("").alias("predicate"), F.lit("").alias("object"))
    return F.aggregate(
        found,
        empty,
        lambda best, t: F.when(
            (F.length(best["subject"]) <= F.length(t["subject"])) & (F.length(best["object"]) < F.length(t["object"])), t
        ).otherwise(best),
    )
