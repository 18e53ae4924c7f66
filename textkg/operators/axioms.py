"""Ontology axioms as rows: axioms(kind, s, p, o, lit_type, annotation)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkg.session import broadcast_if_small

COLUMNS = ("kind", "s", "p", "o", "lit_type", "annotation")


def axiom(
    kind: str,
    s: Column,
    p: Column | None = None,
    o: Column | None = None,
    lit_type: Column | None = None,
    annotation: Column | None = None,
) -> Column:
    empty = F.lit(None).cast("string")
    values = (F.lit(kind), s, p, o, lit_type, annotation)
    return F.struct(*[(empty if c is None else c).alias(n) for n, c in zip(COLUMNS, values)])


def _rows(df: DataFrame, *axioms: Column) -> DataFrame:
    return df.select(F.inline(F.array(*axioms)))


def class_declarations(classes: DataFrame, annotation: Column | None = None) -> DataFrame:
    """From classes(class), with an optional comment per declaration."""
    return _rows(classes, axiom("Declaration", F.col("class"), annotation=annotation))


def subclass_axioms(subclasses: DataFrame) -> DataFrame:
    """From subclasses(parent, child): the child is the subject."""
    return _rows(subclasses, axiom("SubClassOf", F.col("child"), o=F.col("parent")))


def individual_axioms(individuals: DataFrame) -> DataFrame:
    """From individuals(class, individual): a declaration and a class assertion each."""
    return _rows(
        individuals,
        axiom("NamedIndividual", F.col("individual")),
        axiom("ClassAssertion", F.col("individual"), o=F.col("class")),
    )


def _inverse_name() -> Column:
    return F.when(
        F.contains(F.col("kind"), F.lit("InvOf")), F.nullif(F.get(F.split("kind", ":"), F.lit(1)), F.lit(""))
    )


def property_declarations(object_properties: DataFrame, data_properties: DataFrame) -> DataFrame:
    """A declaration of every named object property, of the inverses named with them, and of every data property."""
    names = F.filter(F.array("property", _inverse_name()), lambda n: n.isNotNull() & (n != ""))
    objects = object_properties.select(F.explode(names).alias("property")).distinct()
    data = data_properties.where("property <> ''").select("property").distinct()
    return _rows(objects, axiom("ObjectProperty", F.col("property"))).unionByName(
        _rows(data, axiom("DataProperty", F.col("property")))
    )


def object_property_axioms(properties: DataFrame) -> DataFrame:
    """From properties(property, domain, range, kind): kind `Func` marks a functional property, `InvOf:p` an inverse.

    The inverse gets domain and range swapped. Rows without a property name, and inverses without one, give nothing.
    """
    name, domain, range_ = F.col("property"), F.col("domain"), F.col("range")
    inverse = F.nullif(F.get(F.split("kind", ":"), F.lit(1)), F.lit(""))
    is_inverse = F.contains(F.col("kind"), F.lit("InvOf")) & inverse.isNotNull()
    base = [axiom("ObjectPropertyDomain", name, o=domain), axiom("ObjectPropertyRange", name, o=range_)]
    functional = [F.when(F.col("kind") == "Func", axiom("FunctionalObjectProperty", name))]
    inverted = [
        F.when(is_inverse, a)
        for a in (
            axiom("ObjectPropertyDomain", inverse, o=range_),
            axiom("ObjectPropertyRange", inverse, o=domain),
            axiom("InverseObjectProperties", name, o=inverse),
        )
    ]
    rows = F.filter(F.array(*base, *functional, *inverted), lambda a: a.isNotNull())
    return properties.where("property <> ''").select(F.inline(rows)).distinct()


def data_property_axioms(properties: DataFrame) -> DataFrame:
    """From properties(property, domain, datatype), datatype `string` or `int`."""
    lit_type = F.when(F.col("datatype") == "int", "integer").when(F.col("datatype") == "string", "string")
    rows = F.array(
        axiom("DataPropertyDomain", F.col("property"), o=F.col("domain")),
        axiom("DataPropertyRange", F.col("property"), o=lit_type, lit_type=lit_type),
    )
    return properties.select(F.inline(rows)).where("kind = 'DataPropertyDomain' OR o IS NOT NULL").distinct()


def fact_axioms(triplets: DataFrame, data_properties: DataFrame) -> DataFrame:
    """From triplets(subject, property, object, kind): `Obj` links individuals, `Data` gives a literal, others are left out.

    Literal types come from the declared data properties. A property that several domains declare is one row here, `string`
    unless all of them say `int`; an undeclared one is a string.
    """
    kind = F.when(F.col("datatype") == "int", "integer").otherwise("string")
    types = broadcast_if_small(data_properties.groupBy("property").agg(F.max(kind).alias("__lit")))
    s, p, o = F.col("subject"), F.col("property"), F.col("object")
    made = F.when(F.col("kind") == "Obj", axiom("ObjectPropertyAssertion", s, p, o)).when(
        F.col("kind") == "Data", axiom("DataPropertyAssertion", s, p, o, F.coalesce("__lit", F.lit("string")))
    )
    return (
        triplets.where(F.col("kind").isin("Obj", "Data")).join(types, "property", "left").select(F.inline(F.array(made)))
    )


def signature_counts(axioms: DataFrame) -> DataFrame:
    """(entity_kind, n): distinct classes, individuals, object and data properties named in the axioms."""
    kind = F.col("kind")
    roles = F.array(
        F.when(
            kind.isin("Declaration", "SubClassOf"), F.struct(F.lit("class").alias("entity_kind"), F.col("s").alias("e"))
        ),
        F.when(
            kind.isin("SubClassOf", "ClassAssertion", "ObjectPropertyDomain", "ObjectPropertyRange", "DataPropertyDomain"),
            F.struct(F.lit("class").alias("entity_kind"), F.col("o").alias("e")),
        ),
        F.when(
            kind.isin("NamedIndividual", "ClassAssertion", "ObjectPropertyAssertion", "DataPropertyAssertion"),
            F.struct(F.lit("individual").alias("entity_kind"), F.col("s").alias("e")),
        ),
        F.when(
            kind == "ObjectPropertyAssertion", F.struct(F.lit("individual").alias("entity_kind"), F.col("o").alias("e"))
        ),
        F.when(
            kind.isin(
                "ObjectPropertyDomain", "ObjectPropertyRange", "FunctionalObjectProperty", "InverseObjectProperties"
            ),
            F.struct(F.lit("object property").alias("entity_kind"), F.col("s").alias("e")),
        ),
        F.when(
            kind == "InverseObjectProperties",
            F.struct(F.lit("object property").alias("entity_kind"), F.col("o").alias("e")),
        ),
        F.when(
            kind == "ObjectPropertyAssertion",
            F.struct(F.lit("object property").alias("entity_kind"), F.col("p").alias("e")),
        ),
        F.when(
            kind.isin("DataPropertyDomain", "DataPropertyRange"),
            F.struct(F.lit("data property").alias("entity_kind"), F.col("s").alias("e")),
        ),
        F.when(
            kind == "DataPropertyAssertion", F.struct(F.lit("data property").alias("entity_kind"), F.col("p").alias("e"))
        ),
    )
    entities = axioms.select(F.inline(F.filter(roles, lambda r: r.isNotNull()))).distinct()
    return entities.groupBy("entity_kind").agg(F.count("*").alias("n"))
