"""The given tables and the working sets derived from them, one lazy DataFrame each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkg.functions import text as tx
from textkg.functions.chunking import candidates
from textkg.session import once, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """corpus(doc_id, text, lang): text work is heavy per row, so few splits are spread over the cores."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, words ARRAY<STRING>)."""
    return once(corpus(spark, sf_dir), "words", tx.tokens(F.col("text"))).select("doc_id", "words")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos_no, surface), one row per token."""
    return corpus(spark, sf_dir).select("doc_id", F.posexplode(tx.tokens(F.col("text"))).alias("pos_no", "surface"))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, sent_no, sentence)."""
    return corpus(spark, sf_dir).select(
        "doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("sent_no", "sentence")
    )


def sentence_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, sent_no, sentence, found ARRAY<triple>)."""
    return once(sentences(spark, sf_dir), "found", candidates(tx.tokens(F.col("sentence"))))


def raw_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, sent_no, subject, predicate, object) of every candidate."""
    return sentences(spark, sf_dir).select(
        "doc_id", "sent_no", F.inline(candidates(tx.tokens(F.col("sentence"))))
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lexicon(word): distinct tokens of the benchmark texts."""
    return (
        table(spark, sf_dir, "benchmark").select(F.explode(tx.tokens(F.col("text"))).alias("word")).distinct()
    )


# Mention types of the gazetteer, in the order of `length(term) % 5`.
MENTION_TYPES = ("Gene", "Disease", "Chemical", "Species", "Mutation")


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gazetteer(term, type): lexicon words of five letters or more, typed by length."""
    types = F.array(*[F.lit(t) for t in MENTION_TYPES])
    return (
        lexicon(spark, sf_dir)
        .where(F.length("word") >= 5)
        .select(F.col("word").alias("term"), F.get(types, F.length("word") % 5).alias("type"))
    )


# Ontology classes by the words that name them, in file order: the first contained word wins.
SCHEMA_WORDS = ("tion", "ment", "heit", "thou", "and", "ver", "ier", "ing", "con", "ea")


def lex_hyper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lex_hyper(child, parent): the longest proper prefix of a word that is a word itself."""
    words = lexicon(spark, sf_dir)
    prefixes = words.where(F.length("word") > 1).select(
        F.col("word").alias("child"),
        F.explode(
            F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda n: F.left("word", n))
        ).alias("word"),
    )
    return prefixes.join(words, "word").groupBy("child").agg(F.max_by("word", F.length("word")).alias("parent"))


def synsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """synsets(synset, word): words of one length with the same first four letters are synonyms."""
    key = F.concat_ws("/", F.left("word", F.lit(4)), F.length("word").cast("string"))
    return lexicon(spark, sf_dir).select(key.alias("synset"), "word")


def senses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """senses(word, pos, gloss): one sense per word and benchmark item it occurs in."""
    from textkg.functions.tagging import pos_tag

    words = table(spark, sf_dir, "benchmark").select(
        "item_id", F.explode(F.array_distinct(tx.tokens(F.col("text")))).alias("word")
    )
    pos = F.when(F.col("item_id") % 2 == 0, pos_tag(F.col("word"))).otherwise("nn")
    return words.select("word", pos.alias("pos"), F.concat(F.lit("item "), F.col("item_id")).alias("gloss"))


def word_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(w1, w2): distinct neighbours in the benchmark texts."""
    pairs = F.transform(
        F.array(tx.tokens(F.col("text"))),
        lambda w: F.arrays_zip(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))),
            F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))),
        ),
    )
    return (
        table(spark, sf_dir, "benchmark").select(F.inline(F.flatten(pairs)).alias("w1", "w2")).where("w1 <> w2").distinct()
    )


def _id(kind: str, key: str):
    return F.concat(F.lit(kind + ":"), F.col(key))


def kg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kg(s, p, o): who lives where and who ordered what."""

    def edges(name: str, s, p: str, o) -> DataFrame:
        return table(spark, sf_dir, name).select(s.alias("s"), F.lit(p).alias("p"), o.alias("o"))

    return (
        edges("customer", _id("customer", "c_custkey"), "inNation", _id("nation", "c_nationkey"))
        .unionByName(edges("supplier", _id("supplier", "s_suppkey"), "inNation", _id("nation", "s_nationkey")))
        .unionByName(edges("nation", _id("nation", "n_nationkey"), "inRegion", _id("region", "n_regionkey")))
        .unionByName(edges("orders", _id("order", "o_orderkey"), "placedBy", _id("customer", "o_custkey")))
    )


def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """types(ind, class): customers by market segment, parts by brand, the others by their own class."""

    def typed(name: str, ind, cls) -> DataFrame:
        return table(spark, sf_dir, name).select(ind.alias("ind"), cls.alias("class"))

    return (
        typed("customer", _id("customer", "c_custkey"), F.col("c_mktsegment"))
        .unionByName(typed("part", _id("part", "p_partkey"), F.col("p_brand")))
        .unionByName(typed("supplier", _id("supplier", "s_suppkey"), F.lit("Supplier")))
        .unionByName(typed("nation", _id("nation", "n_nationkey"), F.lit("Nation")))
        .unionByName(typed("region", _id("region", "r_regionkey"), F.lit("Region")))
    )


# The upper part of the class tree (child, parent); Customer and Client name the same class.
UPPER_CLASSES = (
    ("Customer", "Party"),
    ("Customer", "Client"),
    ("Client", "Customer"),
    ("Supplier", "Party"),
    ("Party", "Thing"),
    ("Nation", "Place"),
    ("Region", "Place"),
    ("Place", "Thing"),
    ("Product", "Thing"),
)


def class_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(child, parent): segments under Customer, brands under the part types they come in, types under Product."""
    customer = table(spark, sf_dir, "customer")
    part = table(spark, sf_dir, "part")
    return (
        customer.select(F.col("c_mktsegment").alias("child"), F.lit("Customer").alias("parent"))
        .unionByName(part.select(F.col("p_brand").alias("child"), F.col("p_type").alias("parent")))
        .unionByName(part.select(F.col("p_type").alias("child"), F.lit("Product").alias("parent")))
        .distinct()
        .unionByName(spark.createDataFrame(list(UPPER_CLASSES), "child string, parent string"))
    )


def class_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(class, ancestor, depth)."""
    from textkg.operators.closure import transitive_closure

    return transitive_closure(class_edges(spark, sf_dir), "child", "parent").withColumnRenamed("child", "class")


def follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s, p, o): users linked by event type to the number in the event's properties; loops and mirrors occur."""
    k = F.get_json_object("props", "$.k")
    return (
        table(spark, sf_dir, "events")
        .select(F.col("user_id").cast("string").alias("s"), F.col("event_type").alias("p"), k.alias("o"))
        .where("o IS NOT NULL")
        .distinct()
    )


def triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subject, property, object, kind): object facts of the graph and literal facts of customers and parts."""

    def literal(name: str, ind, prop: str, value: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            ind.alias("subject"),
            F.lit(prop).alias("property"),
            F.col(value).cast("string").alias("object"),
            F.lit("Data").alias("kind"),
        )

    links = kg(spark, sf_dir).select(
        F.col("s").alias("subject"), F.col("p").alias("property"), F.col("o").alias("object"), F.lit("Obj").alias("kind")
    )
    return (
        links.unionByName(literal("customer", _id("customer", "c_custkey"), "fullName", "c_name"))
        .unionByName(literal("part", _id("part", "p_partkey"), "fullName", "p_name"))
        .unionByName(literal("part", _id("part", "p_partkey"), "size", "p_size"))
    )


def _kind_of(column: str):
    return F.initcap(F.substring_index(column, ":", 1))


def object_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(property, domain, range, kind) read off the facts: one value per subject is `Func`, else an inverse is named."""
    facts = triplets(spark, sf_dir).where("kind = 'Obj'")
    per_subject = facts.groupBy("property", "subject", _kind_of("object").alias("range")).agg(
        F.count_distinct("object").alias("n")
    )
    return per_subject.groupBy("property", _kind_of("subject").alias("domain"), "range").agg(
        F.when(F.col("property") == "placedBy", "InvOf:placed").when(F.max("n") == 1, "Func").otherwise("").alias("kind")
    )


def data_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(property, domain, datatype) read off the facts: values that are all whole numbers are `int`."""
    facts = triplets(spark, sf_dir).where("kind = 'Data'")
    return facts.groupBy("property", _kind_of("subject").alias("domain")).agg(
        F.when(F.bool_and(F.col("object").rlike("^[0-9]+$")), "int").otherwise("string").alias("datatype")
    )


def axioms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkg.operators import axioms as ax

    edges = class_edges(spark, sf_dir)
    classes = edges.select(F.explode(F.array("child", "parent")).alias("class")).distinct()
    individuals = types(spark, sf_dir).select("class", F.col("ind").alias("individual"))
    return (
        ax.class_declarations(classes, F.concat(F.lit("class "), F.col("class")))
        .unionByName(ax.subclass_axioms(edges))
        .unionByName(ax.individual_axioms(individuals))
    )
