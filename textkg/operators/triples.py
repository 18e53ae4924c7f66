"""From raw candidates to typed triples and ontology rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkg.functions.chunking import longest
from textkg.functions.text import STOPWORDS, capitalize, phrase_without, to_camel_case
from textkg.operators.matching import first_match, substring_pairs
from textkg.session import broadcast_if_small, cut_lineage, deal, reclaim

OTHER = "Other"


def sentence_triples(found: DataFrame) -> DataFrame:
    """(doc_id, sent_no, subject, predicate, object, n_candidates): the longest candidate of each sentence."""
    best = F.struct(longest(F.col("found")).alias("b"), F.size("found").alias("n"))
    return found.select("doc_id", "sent_no", F.explode(F.array(best)).alias("x")).select(
        "doc_id", "sent_no", "x.b.subject", "x.b.predicate", "x.b.object", F.col("x.n").alias("n_candidates")
    )


def clean_triples(raw: DataFrame, stop: Sequence[str] = STOPWORDS) -> DataFrame:
    """Drop listed words from subject and object phrases and write all three parts as identifiers."""
    keep = [c for c in raw.columns if c not in ("subject", "predicate", "object")]
    cleaned = F.struct(
        to_camel_case(phrase_without(F.col("subject"), stop)).alias("subject"),
        to_camel_case(F.col("predicate")).alias("predicate"),
        to_camel_case(phrase_without(F.col("object"), stop)).alias("object"),
    )
    return raw.select(*keep, F.inline(F.array(cleaned)))


def distinct_triples(cleaned: DataFrame) -> DataFrame:
    """Distinct (subject, predicate, object), rows with all parts empty removed."""
    t = cleaned.select("subject", "predicate", "object")
    return t.where("subject <> '' OR predicate <> '' OR object <> ''").distinct()


def part_set(triples: DataFrame, part: str) -> DataFrame:
    """(entity): distinct non-empty values of one part."""
    return triples.select(F.col(part).alias("entity")).where("entity <> ''").distinct()


def clean_gazetteer(mentions: DataFrame) -> DataFrame:
    """(term, type) from (mention, type): identifiers in lower case without quotes, capitalized types.

    A mention without type becomes `Misc`; one-letter terms are dropped.
    """
    made = F.struct(
        to_camel_case(F.replace(F.lower("mention"), F.lit("'"), F.lit(""))).alias("term"),
        F.when(F.coalesce("type", F.lit("")) == "", "Misc").otherwise(capitalize(F.lower("type"))).alias("type"),
    )
    return mentions.select(F.inline(F.array(made))).where(F.length("term") > 1).distinct()


def type_entities(entities: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(entity, type) of the entities that contain a gazetteer term, ignoring case; entities are distinct.

    The longest term wins, then the alphabetically first; terms of two letters or less are not used.
    """
    folded = entities.select("entity", F.lower("entity").alias("__folded"))
    terms = gazetteer.select(F.lower("term").alias("__term"), "type").distinct()
    order = F.struct(-F.length("__term"), F.col("__term"), F.col("type"))
    return (
        substring_pairs(folded, "__folded", terms, "__term", min_length=3)
        .groupBy("entity")
        .agg(F.min_by("type", order).alias("type"))
    )


def schema_class(entity: Column, words: Sequence[str]) -> Column:
    """The first schema word, in list order, contained in the entity read as a phrase; else `Other`."""
    phrase = F.lower(F.replace(entity, F.lit("_"), F.lit(" ")))
    out = F.lit(OTHER)
    for word in reversed(words):
        out = F.when(F.contains(phrase, F.lit(word.lower())), word).otherwise(out)
    return out


def schema_class_by_table(entities: DataFrame, schema_words: DataFrame) -> DataFrame:
    """(entity, class) with the word list given as schema_words(ord, word), for lists too long for an expression."""
    phrases = entities.select(
        "entity", F.lower(F.replace("entity", F.lit("_"), F.lit(" "))).alias("__phrase")
    ).distinct()
    words = schema_words.select("ord", F.col("word").alias("class"), F.lower("word").alias("__word"))
    hit = first_match(
        phrases.select("__phrase").distinct(), "__phrase", words, "__word", "class", [F.col("ord")]
    )
    return phrases.join(hit, "__phrase", "left").select("entity", F.coalesce("class", F.lit(OTHER)).alias("class"))


def with_both(triples: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """Look up values(entity, value) for subject and object: adds `subject_<value>` and `object_<value>`, null if absent.

    `values` has one row per entity, so both joins keep the row count and AQE can split a hot subject or object.
    """
    out = triples
    for side in ("subject", "object"):
        out = out.join(
            values.select(F.col("entity").alias(side), F.col(value).alias(f"{side}_{value}")), side, "left"
        )
    return out


def triples_with_terms(triples: DataFrame, typed: DataFrame) -> DataFrame:
    """Triples whose subject or object contains a gazetteer term, given type_entities of both sides' entities."""
    marked = with_both(triples, typed.select("entity", F.lit(1).alias("hit")), "hit")
    return marked.where("subject_hit = 1 OR object_hit = 1").select("subject", "predicate", "object")


def typed_triples(triples: DataFrame, typed: DataFrame, words: Sequence[str]) -> DataFrame:
    """(subject_class, subject, predicate, object, object_class) of triples that hold a gazetteer term.

    A side that holds no term has class `Other`; blanks inside a class name are removed.
    """

    def side_class(side: str) -> Column:
        name = F.replace(schema_class(F.col(side), words), F.lit(" "), F.lit(""))
        return F.when(F.col(f"{side}_type").isNotNull(), name).otherwise(OTHER)

    both = with_both(triples, typed, "type").where("subject_type IS NOT NULL OR object_type IS NOT NULL")
    return both.select(
        side_class("subject").alias("subject_class"),
        "subject",
        "predicate",
        "object",
        side_class("object").alias("object_class"),
    )


# Items up to this length are met through pieces of their holders.
SHORT_ITEM = 6


def _type_by_containment(items: DataFrame, typed: DataFrame) -> DataFrame:
    """(entity, type): the type of the shortest typed entity that contains the item, then the alphabetically first.

    An item that is a typed entity is its own shortest holder, so only the others are searched for. Only one holder per item is
    wanted, so pairs are not formed for short ones: holders are cut into their pieces of the lengths that short
    items have, pieces that are no item fall out in the join with the items, and the best holder of each item comes from an aggregation that
    combines before its shuffle, so a task hands on one row per item at most. Long items are few per holder and are matched by prefix keys.
    """
    own = typed.groupBy("entity").agg(F.min_by("type", F.struct("type")).alias("type"), F.lit(True).alias("__own"))
    marked = cut_lineage(items.join(own, "entity", "left"))
    known = marked.where("__own").select("entity", "type")
    return known.unionByName(_type_by_longer(marked.where("__own IS NULL").select("entity"), typed))


def _type_by_longer(items: DataFrame, typed: DataFrame) -> DataFrame:
    """The same for items that are no typed entities; cheap to read again."""
    holders = typed.select(F.col("entity").alias("__holder"), "type")
    size = F.length("entity")
    lengths = sorted(r[0] for r in items.where(size <= SHORT_ITEM).select(size).distinct().collect())  # at most SHORT_ITEM rows
    order = F.struct(F.length("__holder"), F.col("__holder"), F.col("type"))
    long_items = items.where(size > SHORT_ITEM)
    out = substring_pairs(holders, "__holder", long_items, "entity").groupBy("entity").agg(F.min_by("type", order).alias("type"))
    if not lengths:
        return out
    places = F.flatten(
        F.array(
            *[
                F.when(F.length("__holder") >= n, _pieces(F.col("__holder"), n)).otherwise(F.array().cast("array<string>"))
                for n in lengths
            ]
        )
    )
    short_items = broadcast_if_small(items.where(size <= SHORT_ITEM).select("entity").distinct())
    found = deal(holders).select("__holder", "type", F.explode(places).alias("entity")).join(short_items, "entity")
    best = found.groupBy("entity").agg(
        F.min(F.struct(F.length("__holder").alias("n"), F.col("__holder").alias("h"), F.col("type"))).alias("best")
    )
    return out.unionByName(best.select("entity", F.col("best.type").alias("type")))


def _pieces(text: Column, n: int) -> Column:
    """All pieces of `n` code points of a text that has at least as many."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(n)))


def triple_types(triples: DataFrame, typed_subjects: DataFrame, typed_objects: DataFrame) -> DataFrame:
    """(subject, predicate, object, subject_type, object_type) by containment in a typed entity of the same side.

    The types of each side are written, a row per item, so the pieces of its holders are off the disk before the next side is searched.
    """
    out = triples
    for side, typed in (("subject", typed_subjects), ("object", typed_objects)):
        found = cut_lineage(_type_by_containment(part_set(triples, side), typed))
        reclaim(triples.sparkSession)
        out = out.join(
            found.select(F.col("entity").alias(side), F.col("type").alias(f"{side}_type")), side, "left"
        ).withColumn(f"{side}_type", F.coalesce(f"{side}_type", F.lit(OTHER)))
    return out.select("subject", "predicate", "object", "subject_type", "object_type")


def keep_typed(types: DataFrame) -> DataFrame:
    """Rows with a type on at least one side, distinct."""
    return types.where(f"NOT (subject_type = '{OTHER}' AND object_type = '{OTHER}')").distinct()


def untyped_entities(types: DataFrame) -> DataFrame:
    """(entity): the subject when it has no type, otherwise the object when it has none."""
    entity = F.when(F.col("subject_type") == OTHER, F.col("subject")).when(
        F.col("object_type") == OTHER, F.col("object")
    )
    return types.select(entity.alias("entity")).where("entity IS NOT NULL").distinct()


def individuals(typed: DataFrame) -> DataFrame:
    """(class, individual) of both sides, distinct."""
    sides = F.array(
        F.struct(F.col("subject_class").alias("class"), F.col("subject").alias("individual")),
        F.struct(F.col("object_class").alias("class"), F.col("object").alias("individual")),
    )
    return typed.select(F.inline(sides)).distinct()


def facts(typed: DataFrame) -> DataFrame:
    """(subject, property, object, kind) with kind `Obj`, distinct."""
    return typed.select("subject", F.col("predicate").alias("property"), "object", F.lit("Obj").alias("kind")).distinct()


def object_properties(typed: DataFrame) -> DataFrame:
    """(property, domain, range, kind) with kind `Func`, distinct."""
    return typed.select(
        F.col("predicate").alias("property"),
        F.col("subject_class").alias("domain"),
        F.col("object_class").alias("range"),
        F.lit("Func").alias("kind"),
    ).distinct()
