from __future__ import annotations

import json
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from textkg.operators import axioms as ax
from textkg.session import broadcast_if_small, cut_lineage, scratch_path, shared_dir
from textkg.sources import annotations as an
from textkg.sources import articles as ar
from textkg.sources import ontology_files as of
from textkg.sources import text_files as tf


def put(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def test_documents_and_lines(spark, tmp_path):
    put(tmp_path, "1.txt", "one\ntwo\n")
    put(tmp_path, "2.txt", "")
    assert sorted((r.file, r.text) for r in tf.read_documents(spark, str(tmp_path)).collect()) == [("1.txt", "one\ntwo\n")]
    assert rows(tf.read_lines(spark, [str(tmp_path / "1.txt"), str(tmp_path / "1.txt")])) == [
        ("one",), ("one",), ("two",), ("two",),
    ]


def test_word_list_keeps_file_order(spark, tmp_path):
    put(tmp_path, "words.txt", "Risk,Drug\nGene\n\nCell,Mouse\n")
    got = tf.read_word_list(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.ord, r.word) for r in got] == list(enumerate(["Risk", "Drug", "Gene", "Cell", "Mouse"]))


def test_places_of_split_files(spark, tmp_path):
    lines = [",".join(f"w{i}x{j}" for j in range(i % 4)) for i in range(300)]
    put(tmp_path, "a.txt", "\n".join(lines))
    put(tmp_path, "b.txt", "one\r\n\r\ntwo,,three\r\n")
    put(tmp_path, "empty.txt", "")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert tf.read_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 10
        numbered = rows(tf.read_numbered_lines(spark, str(tmp_path)).select("file", "line", "value"))
        words = rows(tf.read_word_list(spark, str(tmp_path)).select("file", "ord", "word"))
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    other = [("b.txt", 0, "one"), ("b.txt", 1, ""), ("b.txt", 2, "two,,three")]
    assert numbered == sorted([("a.txt", i, x) for i, x in enumerate(lines)] + other)
    listed = [w for x in lines for w in x.split(",") if w]
    assert words == sorted([("a.txt", i, w) for i, w in enumerate(listed)] + [("b.txt", i, w) for i, w in enumerate(["one", "two", "three"])])


def test_token_file(spark, tmp_path):
    put(tmp_path, "t.txt", 'needs need VBZ\n" " ``\n')
    assert rows(tf.read_token_file(spark, str(tmp_path))) == [('"', '"', "``"), ("needs", "need", "VBZ")]


def test_write_rows_single_file(spark, tmp_path):
    df = spark.range(100).repartition(8).withColumn("x", F.lit("a"))
    tf.write_rows(df, str(tmp_path / "one"), single_file=True)
    tf.write_rows(df, str(tmp_path / "many"))
    assert len(list((tmp_path / "one").glob("part-*"))) == 1 and len(list((tmp_path / "many").glob("part-*"))) > 1
    for name in ("one", "many"):
        assert tf.read_rows(spark, str(tmp_path / name), "id bigint, x string").count() == 100


def test_pubtator(spark, tmp_path):
    put(
        tmp_path,
        "a.txt",
        "1|t|A title\n1|a|An abstract, with | bars\n1\t0\t5\tflu, bird\tDisease\tD1\n1\t7\t9\tIL6\tGene\t\n1\t1\t2\tx\t\t\n\n"
        "2|t|Other\n2|a|Text\n2\t3\t6\tcat\tSpecies\t9685\n\n",
    )
    assert rows(an.read_pubtator(spark, str(tmp_path))) == [
        ("1", 0, 5, "flu, bird", "Disease", "D1"),
        ("1", 1, 2, "x", "", ""),
        ("1", 7, 9, "IL6", "Gene", ""),
        ("2", 3, 6, "cat", "Species", "9685"),
    ]


def test_bioc(spark, tmp_path):
    put(
        tmp_path,
        "a.xml",
        "<collection><document><id>1</id><passage><infon key='type'>title</infon><offset>0</offset><text>A &amp; B</text>"
        "</passage><passage><infon key='type'>abstract</infon><offset>8</offset><text>C</text></passage></document></collection>",
    )
    assert rows(an.read_bioc(spark, str(tmp_path))) == [("1", 0, "title", 0, "A & B"), ("1", 1, "abstract", 8, "C")]


def test_bioc_mentions(spark, tmp_path):
    put(
        tmp_path,
        "a.xml",
        "<collection><document><id>7</id><passage><offset>0</offset><text>Salt reef</text>"
        "<annotation id='T1'><infon key='type'>Place</infon><infon key='identifier'>P:1</infon><location offset='5' length='4'/>"
        "<text>reef</text></annotation></passage><passage><offset>10</offset><text>kelp and kelp</text>"
        "<annotation id='T2'><infon key='type'>Plant</infon><location offset='10' length='4'/><location offset='19' length='4'/>"
        "<text>kelp</text></annotation></passage></document><document><id>8</id><passage><offset>0</offset><text>none</text>"
        "</passage></document><document><id>9</id></document></collection>",
    )
    got = an.read_bioc_mentions(spark, str(tmp_path)).na.fill("-")
    assert rows(got) == [
        ("7", 0, "T1", "Place", "P:1", 5, 9, "reef"), ("7", 1, "T2", "Plant", "-", 10, 14, "kelp"), ("7", 1, "T2", "Plant", "-", 19, 23, "kelp"),
    ]


def test_denotations(spark, tmp_path):
    rows_ = [
        {"sourcedb": "X", "sourceid": "1", "text": "a 😀 reef", "denotations": [{"id": "T1", "span": {"begin": 4, "end": 8}, "obj": "Place"}]},
        {"sourcedb": "X", "sourceid": "2", "text": "bare"},
        {"sourcedb": "X", "sourceid": "3", "text": None, "denotations": []},
    ]
    put(tmp_path, "a.json", "\n".join(map(json.dumps, rows_)))
    assert rows(an.read_denotations(spark, str(tmp_path))) == [("1", "T1", "Place", 4, 8, "reef")]


def test_annotator_payloads(spark, tmp_path):
    cls = lambda n: {"@id": f"u/{n}", "prefLabel": n, "links": {"self": f"s/{n}", "ontology": "O"}}
    payload = {
        "annotations": [
            {"annotatedClass": cls("a"), "hierarchy": [{"annotatedClass": {"@id": "u/t"}, "distance": 1}, {"annotatedClass": {"@id": "u/r"}, "distance": 2}]},
            {"annotatedClass": cls("b"), "hierarchy": []},
        ]
    }
    put(tmp_path, "p.json", json.dumps(payload))
    assert sorted(map(str, rows(an.read_payload(spark, str(tmp_path)).select("class_id", "label", "ontology", F.coalesce("ancestor_id", F.lit("-")))))) == [
        "('s/a', 'a', 'O', 'u/r')", "('s/a', 'a', 'O', 'u/t')", "('s/b', 'b', 'O', '-')",
    ]


def test_pages_and_listing(spark, tmp_path):
    (tmp_path / "p").mkdir(), (tmp_path / "l").mkdir()
    put(tmp_path / "p", "1.json", json.dumps({"page": 1, "nextPage": 2, "collection": [{"@id": "1", "prefLabel": "x"}, {"@id": "2"}]}))
    put(tmp_path / "p", "2.json", json.dumps({"page": 2, "collection": [{"@id": "3", "prefLabel": "y"}]}))
    assert rows(an.read_paged_labels(spark, str(tmp_path / "p"))) == [("1", "x"), ("3", "y")]
    put(tmp_path / "l", "l.json", '{"name":"n","acronym":"BRO","@id":"i"}\n{"name":"m","acronym":"X","@id":"j"}\n')
    assert rows(an.read_listing(spark, str(tmp_path / "l"), "bro")) == [("n", "i")]


def test_articles(spark, tmp_path):
    def article(pmid, title, abstract):
        return (
            f"<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><ArticleTitle>{title}</ArticleTitle>{abstract}"
            "</Article></MedlineCitation></PubmedArticle>"
        )

    put(
        tmp_path,
        "a.xml",
        "<PubmedArticleSet>"
        + article(1, "T", "<Abstract><AbstractText Label='A'>one</AbstractText><AbstractText Label='B'>two</AbstractText></Abstract>")
        + article(2, "U", "")
        + article(3, "T", "<Abstract><AbstractText>three</AbstractText></Abstract>")
        + article(4, "T", "")
        + "</PubmedArticleSet>",
    )
    arts = ar.read_articles(spark, str(tmp_path))
    assert rows(ar.abstract_text(arts)) == [("1", "onetwo"), ("2", ""), ("3", "three"), ("4", "")]
    early = arts.where("pmid < 4")
    got = {r.title: r.abstract for r in ar.title_abstracts(early, F.col("pmid").cast("int")).collect()}
    assert got == {"T": "three", "U": None}
    got = {r.title: r.abstract for r in ar.title_abstracts(arts, F.col("pmid").cast("int")).collect()}
    assert got == {"T": None, "U": None}


def test_stored_search_results(spark, tmp_path):
    put(tmp_path, "a.xml", "<?xml version='1.0'?>\n<eSearchResult><Count>9</Count><IdList>\n<Id>5</Id>\n<Id>5</Id><Id>4</Id></IdList></eSearchResult>")
    put(tmp_path, "b.xml", "<all><eSearchResult><IdList/></eSearchResult>\n<eSearchResult><IdList><Id>7</Id></IdList><QueryTranslation>x y</QueryTranslation>\n</eSearchResult></all>")
    assert [tuple(r) for r in ar.read_search_results(spark, str(tmp_path)).orderBy("file", "ord").collect()] == [
        ("a.xml", None, 9, 0, "5"), ("a.xml", None, 9, 1, "5"), ("a.xml", None, 9, 2, "4"), ("b.xml", "x y", None, 0, "7")
    ]


def test_id_list(spark):
    df = spark.createDataFrame([("<r><IdList><Id>1</Id><Id>22</Id></IdList><Id>9</Id></r>",)], "x string")
    assert df.select(ar.id_list(F.col("x"))).first()[0] == ["1", "22"]


def _harbour(spark):
    """Axioms of every kind over an invented harbour; names and literals hold what XML must escape."""
    data = spark.createDataFrame(
        [("callSign", "Vessel", "string"), ("berths", "Quay", "int"), ("odd", "Quay", "other")], "property string, domain string, datatype string"
    )
    classes = spark.createDataFrame([("Vessel", "floats & sails"), ("Tug", None)], "class string, note string")
    subs = spark.createDataFrame([("Vessel", "Tug")], "parent string, child string")
    inds = spark.createDataFrame([("Tug", "Oskar"), ("Quay", 'Pier <7> "north"')], "class string, individual string")
    props = spark.createDataFrame(
        [("moorsAt", "Vessel", "Quay", "InvOf:hosts"), ("ownedBy", "Vessel", "Firm", "Func")],
        "property string, domain string, range string, kind string",
    )
    facts = spark.createDataFrame(
        [
            ("Oskar", "moorsAt", 'Pier <7> "north"', "Obj"), ("Oskar", "callSign", ' O "S" \\\n    <k> & tab\t. ', "Data"),
            ("Pier", "berths", "12", "Data"), ("Oskar", "callSign", "", "Data"),
        ],
        "subject string, property string, object string, kind string",
    )
    parts = [
        ax.class_declarations(classes, F.col("note")), ax.subclass_axioms(subs), ax.individual_axioms(inds),
        ax.object_property_axioms(props), ax.data_property_axioms(data), ax.fact_axioms(facts, data),
        ax.property_declarations(props, data),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _sorted_axioms(df):
    return sorted(tuple("-" if x is None else x for x in r) for r in df.select("kind", "s", "p", "o", "lit_type", "annotation").collect())


def test_owl_xml_round_trip_of_every_kind(spark, tmp_path):
    axioms = _harbour(spark).repartition(3)
    assert {r.kind for r in axioms.select("kind").distinct().collect()} == set(of.LAYOUT)
    of.write_owl_xml(axioms, str(tmp_path / "owl"))
    assert _sorted_axioms(of.read_owl_xml(spark, str(tmp_path / "owl"))) == _sorted_axioms(axioms)


def test_owl_parts_are_one_document(spark, tmp_path):
    from xml.etree import ElementTree

    of.write_owl_xml(_harbour(spark).repartition(4), str(tmp_path / "owl"))
    whole = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "owl").glob("part-*")))
    root = ElementTree.fromstring(whole)
    assert len(root) == _harbour(spark).count()


def test_owl_xml_of_another_writer(spark, tmp_path):
    """Prefixes, comments, plain names without a hash and unknown axioms."""
    put(
        tmp_path,
        "a.owl",
        """<?xml version="1.0"?>
<Ontology xmlns="http://www.w3.org/2002/07/owl#"
     ontologyIRI="http://example.org/o">
    <Prefix name="xsd" IRI="http://www.w3.org/2001/XMLSchema#"/>
    <Declaration>
        <Class IRI="Boat"/>
    </Declaration>
    <EquivalentClasses>
        <Class IRI="Boat"/>
        <Class IRI="Ship"/>
    </EquivalentClasses>
    <DataPropertyRange>
        <DataProperty IRI="length"/>
        <Datatype abbreviatedIRI="xsd:integer"/>
    </DataPropertyRange>
    <DataPropertyAssertion>
        <DataProperty IRI="#length"/>
        <NamedIndividual IRI="#Ada"/>
        <Literal datatypeIRI="http://www.w3.org/2001/XMLSchema#integer">9</Literal>
    </DataPropertyAssertion>
</Ontology>

<!-- made by hand -->
""",
    )
    assert _sorted_axioms(of.read_owl_xml(spark, str(tmp_path))) == [
        ("DataPropertyAssertion", "Ada", "length", "9", "integer", "-"),
        ("DataPropertyRange", "length", "-", "integer", "integer", "-"),
        ("Declaration", "Boat", "-", "-", "-", "-"),
    ]


def test_functional_syntax(spark):
    lines = {r[0] for r in of.functional_syntax(_harbour(spark).where("o IS NULL OR NOT contains(o, '7')")).collect()}
    assert {
        "Declaration(Class(:Tug))", 'Declaration(Annotation(rdfs:comment "floats & sails") Class(:Vessel))', "SubClassOf(:Tug :Vessel)",
        "ClassAssertion(:Tug :Oskar)", "Declaration(NamedIndividual(:Oskar))", "FunctionalObjectProperty(:ownedBy)",
        "InverseObjectProperties(:moorsAt :hosts)", "Declaration(ObjectProperty(:hosts))", "Declaration(DataProperty(:berths))",
        "DataPropertyRange(:berths xsd:integer)", 'DataPropertyAssertion(:berths :Pier "12"^^xsd:integer)',
    } <= lines


def test_ontology_files(spark, tmp_path):
    put(tmp_path, "Triplets", "Oskar,callSign,O S,Data\nOskar,moorsAt,Pier,Obj\n")
    assert rows(of.read_ontology_file(spark, str(tmp_path), "Triplets"))[0] == ("Oskar", "callSign", "O S", "Data")


def test_quoted_rows_keep_their_columns(spark, tmp_path):
    values = [("a,b", 'say "x"', ""), ("plain", None, "\\"), ("é", "tab\t", " lead")]
    tf.write_rows(spark.createDataFrame(values, "a string, b string, c string"), str(tmp_path / "q"), quoted=True)
    back = tf.read_rows(spark, str(tmp_path / "q"), "a string, b string, c string").collect()
    assert sorted(map(str, map(tuple, back))) == sorted(str(tuple(x or None for x in v)) for v in values)


def test_cut_lineage_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, ["a"], None)], "i int, a array<string>, s string")
    cut = cut_lineage(df)
    assert cut.schema == df.schema and cut.collect() == df.collect()
    assert cut_lineage(df.where("i > 5")).count() == 0
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_broadcast_only_below_the_limit(spark):
    df = spark.range(1000)
    plan = lambda d: d._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(broadcast_if_small(df)).lower()
    assert "broadcast" not in plan(broadcast_if_small(df, 100)).lower()


@pytest.mark.parametrize("name", list(of.FILE_SCHEMAS))
def test_file_schemas_parse(spark, tmp_path, name):
    put(tmp_path, "f", "a,b,c,d\n")
    assert of.read_ontology_file(spark, str(tmp_path), name).count() == 1


def _session(master, named=None):
    context = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=context)


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(_session("spark://host", "s3a://bucket/shared")) == "s3a://bucket/shared"
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    local = _session("local[2]")
    local.conf.get = lambda key, *default: warehouse if key == "spark.sql.warehouse.dir" else None
    local._jvm, local.sparkContext._jsc = spark._jvm, spark.sparkContext._jsc
    assert f"{warehouse}/textkg-app-1" in shared_dir(local) and shared_dir(local) == shared_dir(local)
    with pytest.raises(RuntimeError):
        shared_dir(_session("spark://host"))
