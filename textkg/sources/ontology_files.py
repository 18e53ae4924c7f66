"""Ontology files: the six comma files, OWL/XML and functional syntax."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textkg.session import once

FILE_SCHEMAS = {
    "Classes": "class string",
    "SubClasses": "parent string, child string",
    "ObjectProperties": "property string, domain string, range string, kind string",
    "DataProperties": "property string, domain string, datatype string",
    "Individuals": "class string, individual string",
    "Triplets": "subject string, property string, object string, kind string",
}

# The element names of OWL/XML and the two ways a name is written in them.
_NAME = "struct<_IRI:string,_abbreviatedIRI:string>"
_ENTITIES = ("Class", "NamedIndividual", "ObjectProperty", "DataProperty", "Datatype")
_LITERAL = "struct<_datatypeIRI:string,_VALUE:string>"
_XSD = "http://www.w3.org/2001/XMLSchema#"
_HEADER = (
    '<?xml version="1.0"?>\n<Ontology xmlns="http://www.w3.org/2002/07/owl#" xmlns:xsd="http://www.w3.org/2001/XMLSchema#"'
    ' xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#">'
)
_FOOTER = "</Ontology>"

# An axiom starts a line with this much blank; the names inside it stand further in.
_INDENT = "    "

# One schema for all axioms: the names by their sort in order, a literal, and an annotation before them.
_AXIOM_SCHEMA = (
    ", ".join(f"{e} array<{_NAME}>" for e in _ENTITIES)
    + f", Literal {_LITERAL}, Annotation array<struct<Literal:{_LITERAL}>>"
)

# Per axiom kind, in the order of the file: the sorts of the names and the column each of them is.
LAYOUT: dict[str, tuple[tuple[str, str], ...]] = {
    "Declaration": (("Class", "s"),),
    "NamedIndividual": (("NamedIndividual", "s"),),
    "ObjectProperty": (("ObjectProperty", "s"),),
    "DataProperty": (("DataProperty", "s"),),
    "SubClassOf": (("Class", "s"), ("Class", "o")),
    "ClassAssertion": (("Class", "o"), ("NamedIndividual", "s")),
    "ObjectPropertyDomain": (("ObjectProperty", "s"), ("Class", "o")),
    "ObjectPropertyRange": (("ObjectProperty", "s"), ("Class", "o")),
    "FunctionalObjectProperty": (("ObjectProperty", "s"),),
    "InverseObjectProperties": (("ObjectProperty", "s"), ("ObjectProperty", "o")),
    "DataPropertyDomain": (("DataProperty", "s"), ("Class", "o")),
    "DataPropertyRange": (("DataProperty", "s"), ("Datatype", "o")),
    "ObjectPropertyAssertion": (("ObjectProperty", "p"), ("NamedIndividual", "s"), ("NamedIndividual", "o")),
    "DataPropertyAssertion": (("DataProperty", "p"), ("NamedIndividual", "s"), ("Literal", "o")),
}

# Declarations of other entities than classes share the element of `Declaration`.
_DECLARED = ("NamedIndividual", "ObjectProperty", "DataProperty")


def read_ontology_file(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the six files by its name."""
    return spark.read.schema(FILE_SCHEMAS[name]).csv(path, escape="\"")


def _element(kind: str) -> str:
    return "Declaration" if kind in _DECLARED else kind


def _escaped(text: Column) -> Column:
    """Text as it stands in an element or attribute; line ends are written as references, so an axiom keeps its lines."""
    for plain, written in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\t", "&#9;"), ("\n", "&#10;"), ("\r", "&#13;")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def write_owl_xml(axioms: DataFrame, path: str) -> None:
    """Write axioms of all kinds as OWL/XML into one folder.

    The part files in the order of their names are one document: the first holds the head, the last the end, those between the axioms, as
    they lie in their partitions.
    """
    spark = axioms.sparkSession

    def written(sort: str, column: str) -> Column:
        if sort == "Literal":
            kind = F.concat(F.lit(_XSD), F.coalesce(F.col("lit_type"), F.lit("string")))
            return F.concat(F.lit('<Literal datatypeIRI="'), kind, F.lit('">'), _escaped(F.col(column)), F.lit("</Literal>"))
        if sort == "Datatype":
            return F.concat(F.lit('<Datatype abbreviatedIRI="xsd:'), _escaped(F.col(column)), F.lit('"/>'))
        return F.concat(F.lit(f'<{sort} IRI="#'), _escaped(F.col(column)), F.lit('"/>'))

    inner = F.lit("\n" + 2 * _INDENT)
    note = F.concat(
        inner, F.lit('<Annotation><AnnotationProperty abbreviatedIRI="rdfs:comment"/><Literal>'), _escaped(F.col("annotation")),
        F.lit("</Literal></Annotation>"),
    )
    body = F.lit(None).cast("string")
    for kind, names in LAYOUT.items():
        parts = [F.concat(inner, written(*n)) for n in names]
        whole = F.concat(
            F.lit(f"{_INDENT}<{_element(kind)}>"), F.coalesce(note, F.lit("")), *parts, F.lit(f"\n{_INDENT}</{_element(kind)}>")
        )
        body = F.when(F.col("kind") == kind, whole).otherwise(body)
    head, end = (spark.createDataFrame([(line,)], "value string").coalesce(1) for line in (_HEADER, _FOOTER))
    lines = axioms.select(body.alias("value")).where("value IS NOT NULL")
    head.union(lines).union(end).write.text(path, lineSep="\n")


def read_owl_xml(spark: SparkSession, path: str) -> DataFrame:
    """(kind, s, p, o, lit_type, annotation) of all axioms of the known kinds, in one scan of the files.

    The files split freely: a record ends where a line starts with the indent of an axiom, as the usual writers set it, and is then
    parsed alone. Elements of other kinds are left out.
    """
    # the end tag of an axiom, and the end of the document behind the last one, are records of their own
    records = spark.read.text(path, lineSep=f"\n{_INDENT}<").select(
        F.regexp_replace("value", r"^\s*<", "").alias("record")
    )
    element = F.regexp_extract("record", r"^(\w+)>", 1)
    known = sorted({_element(k) for k in LAYOUT})
    found = records.withColumn("element", element).where(F.col("element").isin(*known))
    whole = F.concat(F.lit("<"), "record", F.lit("</"), "element", F.lit(">"))
    parsed = once(found, "x", F.from_xml(whole, _AXIOM_SCHEMA, {"ignoreSurroundingSpaces": "false"}))
    kind = F.col("element")
    for sort in _DECLARED:
        kind = F.when((F.col("element") == "Declaration") & F.col(f"x.{sort}").isNotNull(), sort).otherwise(kind)

    def name(sort: str, place: int) -> Column:
        if sort == "Literal":
            return F.coalesce("x.Literal._VALUE", F.lit(""))
        entry = F.get(f"x.{sort}", F.lit(place))
        return F.regexp_replace(F.coalesce(entry["_IRI"], entry["_abbreviatedIRI"]), "^(#|xsd:)", "")

    columns = {c: F.lit(None).cast("string") for c in ("s", "p", "o")}
    for axiom_kind, names in LAYOUT.items():
        seen: dict[str, int] = {}
        for sort, column in names:
            place = seen[sort] = seen.get(sort, -1) + 1
            columns[column] = F.when(F.col("kind") == axiom_kind, name(sort, place)).otherwise(columns[column])
    lit_type = F.when(F.col("kind") == "DataPropertyAssertion", F.regexp_extract("x.Literal._datatypeIRI", "[^#:]*$", 0)).when(
        F.col("kind") == "DataPropertyRange", F.regexp_extract("o", "[^#:]*$", 0)
    )
    rows = parsed.withColumn("kind", kind).select("kind", "x", *[c.alias(n) for n, c in columns.items()])
    o = F.when(F.col("kind") == "DataPropertyRange", F.regexp_extract("o", "[^#:]*$", 0)).otherwise(F.col("o"))
    return rows.select(
        "kind", "s", "p", o.alias("o"), lit_type.alias("lit_type"), F.get("x.Annotation", F.lit(0))["Literal"]["_VALUE"].alias("annotation")
    )


def functional_syntax(axioms: DataFrame) -> DataFrame:
    """(value): each axiom as one line of OWL functional syntax."""

    def named(column: str) -> Column:
        return F.concat(F.lit(":"), column)

    kind, s, p, o = F.col("kind"), named("s"), named("p"), named("o")
    comment = F.concat(F.lit('Annotation(rdfs:comment "'), F.regexp_replace("annotation", r'(["\\])', r"\\$1"), F.lit('") '))
    note = F.coalesce(comment, F.lit(""))
    literal = F.concat(F.lit('"'), F.regexp_replace("o", r'(["\\])', r"\\$1"), F.lit('"^^xsd:'), F.col("lit_type"))
    body = (
        F.when(kind == "Declaration", F.concat(note, F.lit("Class("), s, F.lit(")")))
        .when(kind.isin(*_DECLARED), F.concat(note, kind, F.lit("("), s, F.lit(")")))
        .when(kind == "ClassAssertion", F.concat_ws(" ", o, s))
        .when(kind == "ObjectPropertyAssertion", F.concat_ws(" ", p, s, o))
        .when(kind == "DataPropertyAssertion", F.concat_ws(" ", p, s, literal))
        .when(kind == "DataPropertyRange", F.concat_ws(" ", s, F.concat(F.lit("xsd:"), F.col("o"))))
        .otherwise(F.concat_ws(" ", s, o))
    )
    head = F.when(kind.isin(*_DECLARED), "Declaration").otherwise(kind)
    line = F.concat(head, F.lit("("), body, F.lit(")"))
    return axioms.select(line.alias("value"))
