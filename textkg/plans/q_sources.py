"""Sources and sinks: the tables are written in a stored-file format and read back with the readers.

Files go to fresh folders below the shared folder of the session.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from textkg.functions import offsets as off
from textkg.functions import text as tx
from textkg.operators import axioms as ax
from textkg.operators import counts as ct
from textkg.operators import ordinals as od
from textkg.operators.intervals import interval_join
from textkg.plans import sqltext as sq
from textkg.plans import views as v
from textkg.plans.catalog import query
from textkg.plans.q_graph import _EDGES, _FOLLOW, _KG, _TRIPLETS, _TYPES
from textkg.session import scratch_path, spread
from textkg.sources import annotations as an
from textkg.sources import articles as ar
from textkg.sources import ontology_files as of
from textkg.sources import text_files as tf

DOCS_PER_FILE = 100

# ---- text ---------------------------------------------------------------------------------------------------------


@query(
    "src_wholetext",
    f"""SELECT doc_id // {DOCS_PER_FILE} AS batch, 1::BIGINT AS n_files, sum(length(text) + 1)::BIGINT AS n_chars,
    md5(string_agg(text || chr(10), '' ORDER BY doc_id)) AS text_md5 FROM documents GROUP BY 1""",
)
def src_wholetext(spark, sf):
    path = scratch_path(spark, "wholetext")
    docs = v.table(spark, sf, "documents").select(
        F.floor(F.col("doc_id") / DOCS_PER_FILE).alias("batch"), "doc_id", "text"
    )
    # one file per batch of ids, so no file grows with the data
    ordered = docs.repartition("batch").sortWithinPartitions("batch", "doc_id").drop("doc_id")
    ordered.write.partitionBy("batch").text(path, lineSep="\n")
    files = tf.read_documents(spark, path)
    return files.groupBy(F.col("batch").cast("bigint").alias("batch")).agg(
        F.count_distinct("file").alias("n_files"),
        F.sum(F.length("text")).alias("n_chars"),
        F.max(F.md5(F.col("text").cast("binary"))).alias("text_md5"),
    )


@query(
    "src_lines",
    "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line",
)
def src_lines(spark, sf):
    path = scratch_path(spark, "lines")
    tf.write_lines(v.table(spark, sf, "documents"), "text", path)
    return ct.count_by(tf.read_lines(spark, path).withColumnRenamed("value", "line"), "line")


@query(
    "src_multi_path",
    """SELECT count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars FROM
    (SELECT unnest(string_split(text, chr(10))) AS line FROM documents
     UNION ALL SELECT unnest(string_split(text, chr(10))) FROM conversations)""",
)
def src_multi_path(spark, sf):
    paths = [scratch_path(spark, "multi") for _ in range(2)]
    for name, path in zip(("documents", "conversations"), paths):
        tf.write_lines(v.table(spark, sf, name), "text", path)
    return tf.read_lines(spark, paths).agg(F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


@query(
    "src_word_list",
    f"""SELECT w AS word, count(*) AS n FROM (SELECT unnest({sq.TOK_OF.format('text')}) AS w FROM benchmark) GROUP BY w""",
)
def src_word_list(spark, sf):
    path = scratch_path(spark, "words")
    lists = v.table(spark, sf, "benchmark").select(F.array_join(tx.tokens(F.col("text")), ",").alias("line"))
    tf.write_lines(lists, "line", path)
    return ct.count_by(tf.read_word_list(spark, path), "word")


@query(
    "src_line_places",
    """SELECT doc_id, len(string_split(coalesce(text, ''), chr(10))) AS n_lines, true AS in_order FROM documents""",
)
def src_line_places(spark, sf):
    """Every document's lines, written to files in order and read back in splits, stand one after the other at their numbers."""
    path = scratch_path(spark, "lines")
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    docs = v.table(spark, sf, "documents").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    told = docs.select("doc_id", F.posexplode(lines).alias("j", "text")).select(F.concat_ws("\t", "doc_id", "j", "text").alias("line"))
    tf.write_lines(told, "line", path)
    parts = F.split("value", "\t", 3)
    seen = tf.read_numbered_lines(spark, path).select(
        parts[0].cast("bigint").alias("doc_id"), (F.col("line") - parts[1].cast("bigint")).alias("begin"), "path"
    )
    # lines in their order all point to the same first line
    same = (F.min("begin") == F.max("begin")) & (F.min("path") == F.max("path"))
    return seen.groupBy("doc_id").agg(F.count("*").alias("n_lines"), same.alias("in_order"))


@query(
    "src_token_file",
    f"""WITH {sq.LEMMAS} SELECT w AS surface, lemma, pos, count(*) AS n FROM lem GROUP BY ALL""",
)
def src_token_file(spark, sf):
    from textkg.functions import tagging as tg

    path = scratch_path(spark, "tokens")
    surface = F.col("surface")
    rows = v.tokens(spark, sf).select(
        surface, tg.normalize_term(tg.lemma(surface)).alias("lemma"), tg.pos_tag(surface).alias("pos")
    )
    tf.write_rows(rows, path, sep=" ")
    return ct.count_by(tf.read_token_file(spark, path), "surface", "lemma", "pos")


@query("src_readback", f"WITH {_FOLLOW} SELECT s, p, o FROM fo")
def src_readback(spark, sf):
    path = scratch_path(spark, "stage")
    tf.write_rows(v.follow(spark, sf).withColumn("tag", F.lit("Obj")), path)
    return tf.read_rows(spark, path, "s string, p string, o string, tag string").drop("tag")


@query(
    "sink_text",
    f"WITH {sq.TOKENS} SELECT w || ',' || count(*) AS line FROM tok GROUP BY w",
)
def sink_text(spark, sf):
    path = scratch_path(spark, "counts")
    tf.write_rows(ct.count_by(v.tokens(spark, sf), "surface"), path)
    return tf.read_lines(spark, path).withColumnRenamed("value", "line")


@query(
    "sink_single_file",
    f"WITH {sq.LEMMAS} SELECT pos, count(*) AS n, 1::BIGINT AS n_files FROM lemt GROUP BY pos",
)
def sink_single_file(spark, sf):
    # a tag histogram: as many rows as there are tags, whatever the size of the corpus
    path = scratch_path(spark, "single")
    tf.write_rows(ct.count_by(ct.lemma_tokens(v.corpus(spark, sf)), "pos"), path, single_file=True)
    rows = tf.read_rows(spark, path, "pos string, n bigint")
    return rows.withColumn("n_files", F.lit(len(rows.inputFiles())).cast("bigint"))


# ---- annotations --------------------------------------------------------------------------------------------------


@query(
    "src_pubtator",
    f"""WITH {sq.TOKENS}, {sq.GAZETTEER} SELECT doc_id::VARCHAR AS pmid, pos_no::INTEGER AS start_off,
    (pos_no + length(w))::INTEGER AS end_off, w AS mention, type,
    CASE WHEN length(w) % 2 = 0 THEN 'C' || length(w) ELSE '' END AS concept_id FROM tok JOIN gaz ON w = term""",
)
def src_pubtator(spark, sf):
    path = scratch_path(spark, "pubtator")
    docs = v.table(spark, sf, "documents")
    flat = F.regexp_replace("text", r"[\r\n\t]+", " ")
    headers = docs.select(
        F.concat_ws(
            "\n",
            F.concat_ws("|", "doc_id", F.lit("t"), "source"),
            F.concat_ws("|", "doc_id", F.lit("a"), flat),
            F.lit(""),
        ).alias("line")
    )
    gazetteer = v.gazetteer(spark, sf).withColumnRenamed("term", "surface")
    concept = F.when(F.length("surface") % 2 == 0, F.concat(F.lit("C"), F.length("surface"))).otherwise("")
    rows = (
        v.tokens(spark, sf)
        .join(gazetteer, "surface")
        .select(
            F.concat_ws("\t", "doc_id", "pos_no", F.col("pos_no") + F.length("surface"), "surface", "type", concept).alias("line")
        )
    )
    tf.write_lines(headers.unionByName(rows), "line", path)
    return an.read_pubtator(spark, path)


_LINES = r"""ln AS (SELECT doc_id, source, lang, list_filter(list_transform(string_split(text, chr(10)),
  lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM documents)"""


def _doc_lines(spark, sf):
    """(doc_id, source, lang, l): trimmed non-blank lines."""
    lines = F.filter(
        F.transform(F.split("text", "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != ""
    )
    docs = spread(v.table(spark, sf, "documents").select("doc_id", "source", "lang", "text"))
    return docs.select("doc_id", "source", "lang", lines.alias("l"))


@query(
    "src_bioc_xml",
    f"""WITH {_LINES} SELECT doc_id::VARCHAR AS id, unnest(range(len(l)))::INTEGER AS passage_no, 'line' AS kind,
    unnest(range(len(l)))::INTEGER AS "offset", unnest(l) AS text FROM ln WHERE len(l) > 0""",
)
def src_bioc_xml(spark, sf):
    path = scratch_path(spark, "bioc")
    passages = F.transform(
        "l",
        lambda x, i: F.struct(
            F.array(F.struct(F.lit("type").alias("_key"), F.lit("line").alias("_VALUE"))).alias("infon"),
            i.alias("offset"),
            x.alias("text"),
        ),
    )
    docs = _doc_lines(spark, sf).select(F.col("doc_id").cast("string").alias("id"), passages.alias("passage"))
    docs.write.format("xml").option("rowTag", "document").option("rootTag", "collection").save(path)
    return an.read_bioc(spark, path)


@query("src_annotation_json", "SELECT source AS sourcedb, doc_id::VARCHAR AS sourceid, text FROM documents")
def src_annotation_json(spark, sf):
    path = scratch_path(spark, "annotation-json")
    v.table(spark, sf, "documents").select(
        F.col("source").alias("sourcedb"), F.col("doc_id").cast("string").alias("sourceid"), "text"
    ).write.json(path)
    return an.read_annotation_json(spark, path)


# Words with one of these endings are the mentions of the stored annotation files.
MENTION_ENDINGS = {"tion": "Process", "ment": "Result", "heit": "State", "eau": "Place", "ing": "Process"}
_MENTION_WORD = f"({'|'.join(MENTION_ENDINGS)})$"


def _mention_type(word):
    out = F.lit(None).cast("string")
    for ending, kind in MENTION_ENDINGS.items():
        out = F.when(word.endswith(ending), kind).otherwise(out)
    return out


def _mention_tokens(text, start):
    """Words of a text that are mentions, with their places in the document."""
    return F.filter(off.located_tokens(text, start), lambda w: F.lower(w["text"]).rlike(_MENTION_WORD))


def _type_sql(w: str) -> str:
    out = "NULL"
    for ending, kind in MENTION_ENDINGS.items():
        out = f"CASE WHEN {w} LIKE '%{ending}' THEN '{kind}' ELSE {out} END"
    return out


def _places_sql(source: str) -> str:
    """mt: the mentions of `source`(doc_id, passage_no, start, t), by the lengths of tokens and of what lies between them."""
    sums = "coalesce(list_sum(list_transform({0}, lambda x: length(x))), 0)"
    return rf"""pk AS (SELECT doc_id, passage_no, start, string_split_regex(t, '[\p{{L}}\p{{N}}]+') AS g,
    regexp_extract_all(t, '[\p{{L}}\p{{N}}]+') AS w FROM {source}),
  pw AS (SELECT doc_id, passage_no, unnest(list_transform(range(1, len(w) + 1), lambda i: struct_pack(w := w[i], a := CAST(start
    + {sums.format('g[1:i]')} + {sums.format('w[1:i - 1]')} AS INTEGER)))) AS m FROM pk),
  mt AS (SELECT doc_id, passage_no, m.w AS mention, m.a AS start, m.a + length(m.w) AS stop, {_type_sql('lower(m.w)')} AS type
    FROM pw WHERE regexp_matches(lower(m.w), '{_MENTION_WORD}'))"""


_PASSAGES = (
    _LINES
    + """, pa AS (SELECT doc_id, i - 1 AS passage_no, l[i] AS t,
    coalesce(list_sum(list_transform(l[1:i - 1], lambda x: length(x) + 1)), 0) AS start
  FROM ln, unnest(range(1, len(l) + 1)) u(i))"""
)


@query(
    "src_bioc_mentions",
    f"""WITH {_PASSAGES}, {_places_sql('pa')} SELECT doc_id::VARCHAR AS id, passage_no::INTEGER AS passage_no, type, start, stop,
    mention, 'T' || start AS annotation_id, 'C' || length(mention) AS identifier FROM mt""",
)
def src_bioc_mentions(spark, sf):
    path = scratch_path(spark, "bioc-mentions")
    pair = lambda key, value: F.struct(F.lit(key).alias("_key"), value.alias("_VALUE"))

    def annotation(w):
        place = F.struct(w["start"].alias("_offset"), F.length(w["text"]).alias("_length"))
        kinds = F.array(
            pair("type", _mention_type(F.lower(w["text"]))), pair("identifier", F.concat(F.lit("C"), F.length(w["text"])))
        )
        return F.struct(
            F.concat(F.lit("T"), w["start"]).alias("_id"), kinds.alias("infon"), F.array(place).alias("location"), w["text"].alias("text")
        )

    starts = off.running_sums(F.transform("l", lambda x: F.length(x) + 1))
    passages = F.zip_with(
        "l",
        starts,
        lambda x, at: F.struct(
            F.array(pair("type", F.lit("line"))).alias("infon"),
            at.alias("offset"),
            x.alias("text"),
            F.transform(_mention_tokens(x, at), annotation).alias("annotation"),
        ),
    )
    docs = _doc_lines(spark, sf).select(F.col("doc_id").cast("string").alias("id"), passages.alias("passage"))
    docs.write.format("xml").option("rowTag", "document").option("rootTag", "collection").save(path)
    return an.read_bioc_mentions(spark, path)


@query(
    "sentence_mentions",
    rf"""WITH txt AS (SELECT doc_id, 0 AS passage_no, 0 AS start, text AS t FROM documents WHERE text IS NOT NULL), {_places_sql('txt')},
  sp AS (SELECT doc_id, string_split_regex(t, '[.!?]+\s+|\n+') AS p, regexp_extract_all(t, '[.!?]+\s+|\n+') AS h FROM txt),
  su AS (SELECT doc_id, unnest(list_transform(range(1, len(p) + 1), lambda i: struct_pack(s := p[i], a := CAST(coalesce(list_sum(
    list_transform(p[1:i - 1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) AS INTEGER)))) AS q
    FROM sp),
  sn AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY q.a) - 1 AS sent_no, q.a AS a, q.a + length(q.s) AS b FROM su
    WHERE trim(q.s) <> '')
  SELECT mt.doc_id::VARCHAR AS sourceid, CAST(sent_no AS INTEGER) AS sent_no, type, mt.start, mt.stop, mention
  FROM mt JOIN sn ON mt.doc_id = sn.doc_id AND mt.start >= a AND mt.stop <= b""",
)
def sentence_mentions(spark, sf):
    path = scratch_path(spark, "denotations")
    text = F.col("text")
    span = lambda w: F.struct(w["start"].alias("begin"), (w["start"] + F.length(w["text"])).alias("end"))
    found = F.transform(
        _mention_tokens(text, F.lit(0)),
        lambda w, i: F.struct(
            F.concat(F.lit("T"), i).alias("id"), span(w).alias("span"), _mention_type(F.lower(w["text"])).alias("obj")
        ),
    )
    v.corpus(spark, sf).select(
        F.lit("documents").alias("sourcedb"), F.col("doc_id").cast("string").alias("sourceid"), "text", found.alias("denotations")
    ).write.json(path)
    stored = an.read_annotation_json(spark, path)
    sentences = stored.select("sourceid", F.posexplode(off.located_sentences(text)).alias("sent_no", "s")).select(
        "sourceid", "sent_no", F.col("s.start").alias("r_start"), (F.col("s.start") + F.length("s.text")).alias("r_stop")
    )
    met = interval_join(an.read_denotations(spark, path), sentences, ["sourceid"], test="inside")
    return met.select("sourceid", "sent_no", "type", "start", "stop", "mention")


@query(
    "json_annotations",
    """WITH t AS (SELECT 'http://x/' || conv_id || '/' || turn AS class_id, role AS label, 'O' || conv_id AS ontology,
      conv_id, turn FROM conversations)
    SELECT class_id, label, ontology, 'http://x/' || conv_id || '/' || (turn - 1) AS ancestor_id, 1 AS distance FROM t
      WHERE turn > 0 UNION ALL SELECT class_id, label, ontology, NULL, NULL FROM t WHERE turn = 0""",
)
def json_annotations(spark, sf):
    path = scratch_path(spark, "payload")

    def ref(turn):
        return F.concat(F.lit("http://x/"), "conv_id", F.lit("/"), turn)

    above = F.when(
        F.col("turn") > 0,
        F.array(
            F.struct(F.struct(ref(F.col("turn") - 1).alias("@id")).alias("annotatedClass"), F.lit(1).alias("distance"))
        ),
    )
    annotated = F.struct(
        ref(F.col("turn")).alias("@id"),
        F.col("role").alias("prefLabel"),
        F.struct(ref(F.col("turn")).alias("self"), F.concat(F.lit("O"), "conv_id").alias("ontology")).alias("links"),
    )
    payload = F.array(F.struct(annotated.alias("annotatedClass"), above.alias("hierarchy")))
    v.table(spark, sf, "conversations").select(payload.alias("annotations")).write.json(path)
    return an.read_payload(spark, path)


@query(
    "json_paged_labels",
    "SELECT 'c' || conv_id || '-' || turn AS id, role AS label FROM conversations WHERE turn > 0",
)
def json_paged_labels(spark, sf):
    path = scratch_path(spark, "pages")
    entry = F.struct(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("@id"),
        F.when(F.col("turn") > 0, F.col("role")).alias("prefLabel"),
    )
    page = F.floor(F.col("turn") / 50)
    pages = (
        v.table(spark, sf, "conversations")
        .groupBy("conv_id", page.cast("int").alias("page"))
        .agg(F.collect_list(entry).alias("collection"))
    )
    pages.select("page", "collection").write.json(path)
    return an.read_paged_labels(spark, path)


@query(
    "json_projection",
    "SELECT c_name AS name, 'http://c/' || c_custkey AS id FROM customer WHERE lower(c_mktsegment) = 'building'",
)
def json_projection(spark, sf):
    path = scratch_path(spark, "listing")
    v.table(spark, sf, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("acronym"),
        F.concat(F.lit("http://c/"), "c_custkey").alias("@id"),
    ).write.json(path)
    return an.read_listing(spark, path, "Building")


@query(
    "json_fields",
    """SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k, NULL::VARCHAR AS missing, NULL::INTEGER AS broken
    FROM events""",
)
def json_fields(spark, sf):
    events = v.table(spark, sf, "events").select("event_id", "props")
    good = F.from_json("props", "k int, name string")
    broken = F.from_json(F.substring("props", 2, 1 << 30), "k int")
    return events.select("event_id", good["k"].alias("k"), good["name"].alias("missing"), broken["k"].alias("broken"))


@query(
    "mapping_json",
    """SELECT c_custkey, '{"creator":"http://user/' || c_custkey || '","relation":"http://www.w3.org/2002/07/owl#sameAs",'
    || '"source":"' || c_mktsegment || '","comment":"' || c_name || '","terms":[{"ontology":"CUSTOMER","term":["customer:'
    || c_custkey || '"]},{"ontology":"NATION","term":["nation:' || c_nationkey || '"]}]}' AS mapping FROM customer""",
)
def mapping_json(spark, sf):
    def term(ontology: str, kind: str, key: str):
        ids = F.array(F.concat(F.lit(kind), key))
        return F.struct(F.lit(ontology).alias("ontology"), ids.alias("term"))

    return v.table(spark, sf, "customer").select(
        "c_custkey",
        an.mapping_json(
            F.concat(F.lit("http://user/"), "c_custkey"),
            F.col("c_mktsegment"),
            F.col("c_name"),
            F.array(term("CUSTOMER", "customer:", "c_custkey"), term("NATION", "nation:", "c_nationkey")),
        ).alias("mapping"),
    )


# ---- articles -----------------------------------------------------------------------------------------------------


def _articles(spark, sf):
    """The documents as article XML, read back; title = source and language, one section per line."""
    path = scratch_path(spark, "articles")
    sections = F.transform(
        "l", lambda x, i: F.struct(F.concat(F.lit("part "), i.cast("string")).alias("_Label"), x.alias("_VALUE"))
    )
    article = F.struct(
        F.concat_ws(" ", "source", "lang").alias("ArticleTitle"),
        F.when(F.size("l") > 0, F.struct(sections.alias("AbstractText"))).alias("Abstract"),
    )
    citation = F.struct(F.col("doc_id").cast("string").alias("PMID"), article.alias("Article"))
    rows = _doc_lines(spark, sf).select(citation.alias("MedlineCitation"))
    rows.write.format("xml").option("rowTag", "PubmedArticle").option("rootTag", "PubmedArticleSet").save(path)
    return ar.read_articles(spark, path)


@query(
    "xml_abstract_text",
    f"WITH {_LINES} SELECT doc_id::VARCHAR AS pmid, coalesce(list_aggregate(l, 'string_agg', ''), '') AS abstract FROM ln",
)
def xml_abstract_text(spark, sf):
    return ar.abstract_text(_articles(spark, sf))


@query(
    "xml_title_abstract",
    rf"""WITH {_LINES}, f AS (SELECT doc_id, source || ' ' || lang AS title, trim(regexp_replace(l[1], '\t+', ' ', 'g')) AS a
      FROM ln), m AS (SELECT title, max(doc_id) AS doc_id FROM f GROUP BY title)
    SELECT title, a AS abstract FROM f JOIN m USING (title, doc_id)""",
)
def xml_title_abstract(spark, sf):
    return ar.title_abstracts(_articles(spark, sf), F.col("pmid").cast("bigint"))


@query("xml_id_list", "SELECT doc_id::VARCHAR AS id FROM documents")
def xml_id_list(spark, sf):
    batches = od.batches(v.table(spark, sf, "documents"), "doc_id", 200)
    xml = F.concat(
        F.lit("<eSearchResult><IdList><Id>"),
        F.replace("ids", F.lit(","), F.lit("</Id><Id>")),
        F.lit("</Id></IdList></eSearchResult>"),
    )
    return batches.select(F.explode(ar.id_list(xml)).alias("id"))


@query(
    "src_search_results",
    """SELECT min(doc_id) OVER w || ' to ' || max(doc_id) OVER w AS term, count(*) OVER w AS total,
      (row_number() OVER (PARTITION BY b ORDER BY doc_id) - 1)::INTEGER AS ord, doc_id::VARCHAR AS id
    FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS b FROM documents) WINDOW w AS (PARTITION BY b)""",
)
def src_search_results(spark, sf):
    """Results of 200 ids stored as files, and read back."""
    path = scratch_path(spark, "search")
    ids = F.split("ids", ",")
    xml = F.concat(
        F.lit("<eSearchResult><Count>"), F.size(ids), F.lit("</Count><IdList><Id>"), F.array_join(ids, "</Id><Id>"),
        F.lit("</Id></IdList><QueryTranslation>"), ids[0], F.lit(" to "), F.element_at(ids, -1), F.lit("</QueryTranslation></eSearchResult>"),
    )
    batches = od.batches(v.table(spark, sf, "documents"), "doc_id", 200)
    batches.select("batch", xml.alias("value")).write.partitionBy("batch").text(path)  # a file for each result
    return ar.read_search_results(spark, path).select("term", "total", "ord", "id")


# ---- ontology files -----------------------------------------------------------------------------------------------


@query("src_ontology_csv", f"WITH {_TRIPLETS} SELECT subject, property, object, kind FROM trp")
def src_ontology_csv(spark, sf):
    path = scratch_path(spark, "triplets")
    tf.write_rows(v.triplets(spark, sf), path)
    return of.read_ontology_file(spark, path, "Triplets")


def _axioms_and_facts(spark, sf):
    """All axiom kinds: declarations, class tree, individuals, properties and facts."""
    parts = (
        ax.property_declarations(v.object_properties(spark, sf), v.data_properties(spark, sf)),
        ax.object_property_axioms(v.object_properties(spark, sf)),
        ax.data_property_axioms(v.data_properties(spark, sf)),
        ax.fact_axioms(v.triplets(spark, sf), v.data_properties(spark, sf)),
    )
    return reduce(lambda a, b: a.unionByName(b), parts, v.axioms(spark, sf))


_AXF = f"""{_TYPES}, {_TRIPLETS}, {_EDGES}, c AS (SELECT child AS class FROM ce UNION SELECT parent FROM ce),
  k AS (SELECT property, subject, upper(subject[1]) || split_part(subject, ':', 1)[2:] AS domain,
    upper(object[1]) || split_part(object, ':', 1)[2:] AS rng, object FROM trp WHERE kind = 'Obj'),
  op AS (SELECT property, domain, rng, max(n) AS n FROM (SELECT property, domain, rng, subject, count(DISTINCT object) AS n
    FROM k GROUP BY ALL) GROUP BY ALL),
  dt AS (SELECT property, domain, CASE datatype WHEN 'int' THEN 'integer' ELSE 'string' END AS lit FROM dp),
  ax(kind, s, p, o, lit_type, annotation) AS (
    SELECT 'Declaration', class, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR, 'class ' || class FROM c
    UNION ALL SELECT 'SubClassOf', child, NULL, parent, NULL, NULL FROM ce
    UNION ALL SELECT 'NamedIndividual', ind, NULL, NULL, NULL, NULL FROM types
    UNION ALL SELECT 'ClassAssertion', ind, NULL, class, NULL, NULL FROM types
    UNION ALL (SELECT 'ObjectProperty', property, NULL, NULL, NULL, NULL FROM op
      UNION SELECT 'ObjectProperty', 'placed', NULL, NULL, NULL, NULL FROM op WHERE property = 'placedBy')
    UNION ALL (SELECT DISTINCT 'DataProperty', property, NULL, NULL, NULL, NULL FROM dt)
    UNION ALL (SELECT 'ObjectPropertyDomain', property, NULL, domain, NULL, NULL FROM op
      UNION SELECT 'ObjectPropertyRange', property, NULL, rng, NULL, NULL FROM op
      UNION SELECT 'FunctionalObjectProperty', property, NULL, NULL, NULL, NULL FROM op WHERE n = 1 AND property <> 'placedBy'
      UNION SELECT 'ObjectPropertyDomain', 'placed', NULL, rng, NULL, NULL FROM op WHERE property = 'placedBy'
      UNION SELECT 'ObjectPropertyRange', 'placed', NULL, domain, NULL, NULL FROM op WHERE property = 'placedBy'
      UNION SELECT 'InverseObjectProperties', property, NULL, 'placed', NULL, NULL FROM op WHERE property = 'placedBy')
    UNION ALL (SELECT 'DataPropertyDomain', property, NULL, domain, NULL, NULL FROM dt
      UNION SELECT 'DataPropertyRange', property, NULL, lit, lit, NULL FROM dt)
    UNION ALL SELECT 'ObjectPropertyAssertion', subject, property, object, NULL, NULL FROM trp WHERE kind = 'Obj'
    UNION ALL SELECT 'DataPropertyAssertion', subject, property, object, CASE WHEN property IN
      (SELECT property FROM dp WHERE datatype = 'int') THEN 'integer' ELSE 'string' END, NULL FROM trp WHERE kind = 'Data')"""


@query("src_owl_xml", f"WITH {_AXF} SELECT kind, s, p, o, lit_type, annotation FROM ax")
def src_owl_xml(spark, sf):
    path = scratch_path(spark, "owl")
    of.write_owl_xml(_axioms_and_facts(spark, sf), path)
    return of.read_owl_xml(spark, path)


@query(
    "src_ontology_files",
    f"""WITH {_TYPES}, {_TRIPLETS}, {_EDGES}, c AS (SELECT child AS class FROM ce UNION SELECT parent FROM ce),
  k AS (SELECT property, subject, upper(subject[1]) || split_part(subject, ':', 1)[2:] AS domain,
    upper(object[1]) || split_part(object, ':', 1)[2:] AS rng, object FROM trp WHERE kind = 'Obj'),
  op AS (SELECT property, domain, rng, max(n) AS n FROM (SELECT property, domain, rng, subject, count(DISTINCT object) AS n
    FROM k GROUP BY ALL) GROUP BY ALL)
  SELECT 'Classes' AS file, class AS a, NULL::VARCHAR AS b, NULL::VARCHAR AS c, NULL::VARCHAR AS d FROM c
  UNION ALL SELECT 'SubClasses', parent, child, NULL, NULL FROM ce
  UNION ALL SELECT 'ObjectProperties', property, domain, rng,
    CASE WHEN property = 'placedBy' THEN 'InvOf:placed' WHEN n = 1 THEN 'Func' END FROM op
  UNION ALL SELECT 'DataProperties', property, domain, datatype, NULL FROM dp
  UNION ALL SELECT 'Individuals', class, ind, NULL, NULL FROM types
  UNION ALL SELECT 'Triplets', subject, property, object, kind FROM trp""",
)
def src_ontology_files(spark, sf):
    path = scratch_path(spark, "ontology")
    edges = v.class_edges(spark, sf)
    tables = {
        "Classes": edges.select(F.explode(F.array("child", "parent")).alias("class")).distinct(),
        "SubClasses": edges.select("parent", "child"),
        "ObjectProperties": v.object_properties(spark, sf).select("property", "domain", "range", "kind"),
        "DataProperties": v.data_properties(spark, sf).select("property", "domain", "datatype"),
        "Individuals": v.types(spark, sf).select("class", F.col("ind").alias("individual")),
        "Triplets": v.triplets(spark, sf),
    }
    read = []
    for name, rows in tables.items():
        tf.write_rows(rows, f"{path}/{name}", quoted=True)
        back = of.read_ontology_file(spark, f"{path}/{name}", name)
        fields = [F.col(c) for c in back.columns] + [F.lit(None).cast("string")] * (4 - len(back.columns))
        read.append(back.select(F.lit(name).alias("file"), *[f.alias(n) for f, n in zip(fields, "abcd")]))
    return reduce(lambda a, b: a.unionByName(b), read)


@query(
    "sink_owl_functional",
    f"""WITH {_AXF} SELECT CASE
      WHEN kind = 'Declaration' THEN 'Declaration(Annotation(rdfs:comment "' || annotation || '") Class(:' || s || '))'
      WHEN kind IN ('NamedIndividual', 'ObjectProperty', 'DataProperty') THEN 'Declaration(' || kind || '(:' || s || '))'
      WHEN kind = 'ClassAssertion' THEN 'ClassAssertion(:' || o || ' :' || s || ')'
      WHEN kind = 'ObjectPropertyAssertion' THEN 'ObjectPropertyAssertion(:' || p || ' :' || s || ' :' || o || ')'
      WHEN kind = 'DataPropertyAssertion' THEN
        'DataPropertyAssertion(:' || p || ' :' || s || ' "' || o || '"^^xsd:' || lit_type || ')'
      WHEN kind = 'DataPropertyRange' THEN 'DataPropertyRange(:' || s || ' xsd:' || o || ')'
      ELSE kind || '(:' || s || coalesce(' :' || o, '') || ')' END AS line FROM ax""",
)
def sink_owl_functional(spark, sf):
    path = scratch_path(spark, "functional")
    tf.write_lines(of.functional_syntax(_axioms_and_facts(spark, sf)), "value", path)
    return tf.read_lines(spark, path).withColumnRenamed("value", "line")
