"""Stored annotation files: PubTator lines, BioC XML, annotation JSON and annotator payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textkg.sources.text_files import read_lines

BIOC_SCHEMA = (
    "id string, passage array<struct<infon:array<struct<_key:string,_VALUE:string>>,offset:int,text:string>>"
)
ANNOTATION_SCHEMA = "sourcedb string, sourceid string, text string"

# The element and field names of the two annotation formats.
_INFONS = "array<struct<_key:string,_VALUE:string>>"
BIOC_MENTION_SCHEMA = (
    f"id string, passage array<struct<offset:int,annotation:array<struct<_id:string,infon:{_INFONS},"
    "location:array<struct<_offset:int,_length:int>>,text:string>>>>"
)
DENOTATION_SCHEMA = (
    "sourcedb string, sourceid string, text string, denotations array<struct<id:string,span:struct<begin:int,end:int>,obj:string>>"
)

_CLASS = "struct<`@id`:string,prefLabel:string,links:struct<self:string,ontology:string>>"
PAYLOAD_SCHEMA = (
    f"annotations array<struct<annotatedClass:{_CLASS},"
    f"hierarchy:array<struct<annotatedClass:struct<`@id`:string>,distance:int>>>>"
)
PAGE_SCHEMA = (
    "page int, nextPage int, collection array<struct<`@id`:string,prefLabel:string>>, links struct<nextPage:string>"
)
LISTING_SCHEMA = "name string, acronym string, `@id` string"


def read_pubtator(spark: SparkSession, path: str) -> DataFrame:
    """(pmid, start_off, end_off, mention, type, concept_id) of the tab rows.

    Title and abstract lines (`id|t|...`, `id|a|...`) and blank lines are left out wherever they stand, so files of many
    articles split freely. A missing concept id or type stays empty.
    """
    lines = read_lines(spark, path).where(~F.col("value").rlike(r"^[^|\t]*\|[ta]\|") & F.contains("value", F.lit("\t")))
    parts = lines.select(F.split("value", "\t", -1).alias("f"))

    def field(i: int) -> Column:
        return F.coalesce(F.get("f", F.lit(i)), F.lit(""))

    return parts.select(
        field(0).alias("pmid"),
        field(1).try_cast("int").alias("start_off"),
        field(2).try_cast("int").alias("end_off"),
        field(3).alias("mention"),
        field(4).alias("type"),
        field(5).alias("concept_id"),
    )


def read_bioc(spark: SparkSession, path: str) -> DataFrame:
    """(id, passage_no, kind, offset, text), one row per passage."""
    docs = spark.read.format("xml").option("rowTag", "document").schema(BIOC_SCHEMA).load(path)
    rows = docs.select("id", F.posexplode("passage").alias("passage_no", "p"))
    kind = F.get(F.filter("p.infon", lambda i: i["_key"] == "type"), F.lit(0))["_VALUE"]
    return rows.select("id", "passage_no", kind.alias("kind"), "p.offset", "p.text")


def _infon(infons: str, key: str) -> Column:
    return F.get(F.filter(infons, lambda i: i["_key"] == key), F.lit(0))["_VALUE"]


def read_bioc_mentions(spark: SparkSession, path: str) -> DataFrame:
    """(id, passage_no, annotation_id, type, identifier, start, stop, mention), one row per annotation and location.

    Positions count from the begin of the document, as `offset` of a location does; an annotation in several pieces has a row for each.
    """
    docs = spark.read.format("xml").option("rowTag", "document").schema(BIOC_MENTION_SCHEMA).load(path)
    found = docs.select("id", F.posexplode("passage").alias("passage_no", "p")).select(
        "id", "passage_no", F.explode("p.annotation").alias("a")
    )
    return found.select("id", "passage_no", "a", F.explode("a.location").alias("at")).select(
        "id",
        "passage_no",
        F.col("a._id").alias("annotation_id"),
        _infon("a.infon", "type").alias("type"),
        _infon("a.infon", "identifier").alias("identifier"),
        F.col("at._offset").alias("start"),
        (F.col("at._offset") + F.col("at._length")).alias("stop"),
        F.col("a.text").alias("mention"),
    )


def read_denotations(spark: SparkSession, path: str) -> DataFrame:
    """(sourceid, denotation_id, type, start, stop, mention): the denotations of annotation JSON with the text they cover."""
    docs = spark.read.schema(DENOTATION_SCHEMA).json(path)
    rows = docs.select("sourceid", "text", F.explode("denotations").alias("d"))
    start, stop = F.col("d.span.begin"), F.col("d.span.end")
    return rows.select(
        "sourceid", F.col("d.id").alias("denotation_id"), F.col("d.obj").alias("type"), start.alias("start"), stop.alias("stop"),
        F.substring("text", start + 1, stop - start).alias("mention"),
    )


def read_annotation_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANNOTATION_SCHEMA).json(path)


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """(class_id, label, ontology, ancestor_id, distance): one row per annotation and ancestor, null without ancestors."""
    found = spark.read.schema(PAYLOAD_SCHEMA).json(path).select(F.explode("annotations").alias("a"))
    return found.select(
        F.col("a.annotatedClass.links.self").alias("class_id"),
        F.col("a.annotatedClass.prefLabel").alias("label"),
        F.col("a.annotatedClass.links.ontology").alias("ontology"),
        F.explode_outer("a.hierarchy").alias("h"),
    ).select("class_id", "label", "ontology", F.col("h.annotatedClass.@id").alias("ancestor_id"), "h.distance")


def read_paged_labels(spark: SparkSession, path: str) -> DataFrame:
    """(id, label) over all stored pages of a listing, entries without a label left out."""
    entries = spark.read.schema(PAGE_SCHEMA).json(path).select(F.explode("collection").alias("c"))
    return entries.where("c.prefLabel IS NOT NULL").select(F.col("c.@id").alias("id"), F.col("c.prefLabel").alias("label"))


def read_listing(spark: SparkSession, path: str, acronym: str | None = None) -> DataFrame:
    """(name, id) of a listing, optionally of one acronym, ignoring case."""
    entries = spark.read.schema(LISTING_SCHEMA).json(path)
    if acronym is not None:
        entries = entries.where(F.lower("acronym") == acronym.lower())
    return entries.select("name", F.col("@id").alias("id"))


def mapping_json(creator: Column, source: Column, comment: Column, terms: Column) -> Column:
    """A `sameAs` mapping record; `terms` is array<struct<ontology, term array<string>>>."""
    return F.to_json(
        F.struct(
            creator.alias("creator"),
            F.lit("http://www.w3.org/2002/07/owl#sameAs").alias("relation"),
            source.alias("source"),
            comment.alias("comment"),
            terms.alias("terms"),
        )
    )
