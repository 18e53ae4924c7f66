"""Triple extraction, entity typing and ontology rows over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkg.functions import text as tx
from textkg.functions.chunking import candidates
from textkg.operators import counts as ct
from textkg.operators import triples as tr
from textkg.operators.matching import substring_pairs
from textkg.plans import sqltext as sq
from textkg.plans import views as v
from textkg.plans.catalog import query
from textkg.session import broadcast_if_small, cut_lineage, reclaim, release


def _phrase(x: str) -> str:
    return f"""CASE WHEN contains({x}, ' ') THEN coalesce(list_aggregate(list_filter(string_split({x}, ' '),
      lambda q: q NOT IN ({sq.STOP})), 'string_agg', ' '), '') ELSE {x} END"""


def _camel(x: str) -> str:
    return f"""CASE WHEN contains({x}, ' ') THEN replace(list_aggregate(list_transform(string_split({x}, ' '),
      lambda q, i: CASE WHEN i > 1 AND length(q) > 1 THEN replace(upper(q[1]), 'ẞ', 'ß') || q[2:] ELSE q END),
      'string_agg', '_'), '.', '') ELSE {x} END"""


_CLEAN = (
    sq.TRIPLES
    + f""", ph AS (SELECT doc_id, sent_no, {_phrase('subject')} AS s, predicate AS p, {_phrase('object')} AS o FROM raw),
cl AS (SELECT doc_id, sent_no, {_camel('s')} AS subject, {_camel('p')} AS predicate, {_camel('o')} AS object FROM ph),
tri AS (SELECT DISTINCT subject, predicate, object FROM cl WHERE subject <> '' OR predicate <> '' OR object <> '')"""
)


def _typed_sql(name: str, part: str) -> str:
    return f"""{name} AS (SELECT entity, arg_min(type, (-length(term), term, type)) AS type
  FROM (SELECT DISTINCT {part} AS entity FROM tri WHERE {part} <> '') e JOIN gaz ON contains(lower(entity), term)
  GROUP BY entity)"""


_TYPED = (
    _CLEAN
    + ", "
    + sq.GAZETTEER
    + ", "
    + _typed_sql("ts", "subject")
    + ", "
    + _typed_sql("tob", "object")
    + ", te AS (SELECT * FROM ts UNION SELECT * FROM tob)"
)


def _schema(x: str) -> str:
    whens = " ".join(f"WHEN contains(lower(replace({x}, '_', ' ')), '{w}') THEN '{w}'" for w in v.SCHEMA_WORDS)
    return f"CASE {whens} ELSE 'Other' END"


_TT = (
    _TYPED
    + f""", tt AS (SELECT CASE WHEN a.entity IS NULL THEN 'Other' ELSE {_schema('subject')} END AS subject_class, subject,
  predicate, object, CASE WHEN b.entity IS NULL THEN 'Other' ELSE {_schema('object')} END AS object_class
  FROM tri LEFT JOIN te a ON subject = a.entity LEFT JOIN te b ON object = b.entity
  WHERE a.entity IS NOT NULL OR b.entity IS NOT NULL)"""
)


def _contain_sql(name: str, part: str, typed: str) -> str:
    return f"""{name} AS (SELECT item, arg_min(type, (length(entity), entity, type)) AS type
  FROM (SELECT DISTINCT {part} AS item FROM mt WHERE {part} <> '') i JOIN {typed} ON contains(entity, item) GROUP BY item)"""


_TYPES = (
    _TYPED
    + """, mt AS (SELECT * FROM tri WHERE subject IN (SELECT entity FROM te) OR object IN (SELECT entity FROM te)), """
    + _contain_sql("cs", "subject", "ts")
    + ", "
    + _contain_sql("co", "object", "tob")
    + """, ty AS (SELECT subject, predicate, object, coalesce(cs.type, 'Other') AS subject_type,
  coalesce(co.type, 'Other') AS object_type FROM mt LEFT JOIN cs ON subject = cs.item LEFT JOIN co ON object = co.item)"""
)

_MENTIONS = f"""bt AS (SELECT item_id, {sq.TOK_OF.format('text')} AS w FROM benchmark),
  mw AS (SELECT unnest(w[1:len(w) - 1]) AS a, unnest(w[2:]) AS b FROM bt WHERE len(w) > 1),
  men AS (SELECT a || ''' ' || b AS mention, CASE length(b) % 3 WHEN 0 THEN 'DISEASE' WHEN 1 THEN 'gene' ELSE '' END
    AS type FROM mw WHERE length(a) >= 3 AND length(b) >= 3)"""


def _mentions(spark, sf):
    """(mention, type) of adjacent benchmark words; some mentions have no type."""
    words = F.transform(
        F.array(tx.tokens(F.col("text"))),
        lambda w: F.arrays_zip(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))),
            F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))),
        ),
    )
    pairs = v.table(spark, sf, "benchmark").select(F.inline(F.flatten(words)).alias("a", "b"))
    kind = F.when(F.length("b") % 3 == 0, "DISEASE").when(F.length("b") % 3 == 1, "gene").otherwise("")
    return pairs.where("length(a) >= 3 AND length(b) >= 3").select(
        F.concat("a", F.lit("' "), "b").alias("mention"), kind.alias("type")
    )


def _clean(spark, sf):
    return tr.clean_triples(v.raw_triples(spark, sf))


def _triples(spark, sf):
    """Distinct triples, written once: typing and look-up both read them, and extraction is the costly part."""
    return cut_lineage(tr.distinct_triples(_clean(spark, sf)))


def _entities(triples):
    """(entity): distinct non-empty subjects and objects."""
    sides = triples.select(F.explode(F.array("subject", "object")).alias("entity"))
    return sides.where("entity <> ''").distinct()


def _typed(spark, sf, entities):
    """(entity, type) of distinct entities."""
    return tr.type_entities(entities, v.gazetteer(spark, sf))


def _typed_side(spark, sf, part):
    return _typed(spark, sf, tr.part_set(_clean(spark, sf), part))


def _all_typed(spark, sf, triples):
    return _typed(spark, sf, _entities(triples))


def _typed_triples(spark, sf):
    t = _triples(spark, sf)
    return tr.typed_triples(t, cut_lineage(_all_typed(spark, sf, t)), v.SCHEMA_WORDS)


# ---- extraction ---------------------------------------------------------------------------------------------------


@query(
    "extract_triples",
    f"""WITH {sq.TRIPLES} SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, subject, predicate, object FROM raw""",
)
def extract_triples(spark, sf):
    return v.raw_triples(spark, sf)


# The ordered fold, step by step over the candidates of each sentence.
_LONGEST = (
    sq.TRIPLES
    + """, li AS (SELECT doc_id, sent_no, list(struct_pack(s := subject, p := predicate, o := object) ORDER BY c) AS l
  FROM raw GROUP BY ALL),
lo AS (SELECT doc_id, sent_no, len(l) AS n, list_reduce(l, lambda b, t: CASE WHEN length(b.s) <= length(t.s)
  AND length(b.o) < length(t.o) THEN t ELSE b END, struct_pack(s := '', p := '', o := '')) AS b FROM li)"""
)


@query(
    "longest_triple",
    f"""WITH {_LONGEST} SELECT doc_id, CAST(sent.sent_no AS INTEGER) AS sent_no, coalesce(b.s, '') AS subject,
    coalesce(b.p, '') AS predicate, coalesce(b.o, '') AS object, CAST(coalesce(n, 0) AS INTEGER) AS n_candidates
    FROM sent LEFT JOIN lo USING (doc_id, sent_no)""",
)
def longest_triple(spark, sf):
    return tr.sentence_triples(v.sentence_candidates(spark, sf))


@query(
    "triple_totals",
    f"""WITH {_LONGEST} SELECT (SELECT count(*) FROM sent) AS n_sentences, count(*) AS n_with_triple,
    sum(n)::BIGINT AS n_candidates FROM lo""",
)
def triple_totals(spark, sf):
    n = v.sentences(spark, sf).select(F.explode(F.array(F.size(candidates(tx.tokens(F.col("sentence")))))).alias("n"))
    return n.agg(
        F.count("*").alias("n_sentences"),
        F.count_if(F.col("n") > 0).alias("n_with_triple"),
        F.sum("n").alias("n_candidates"),
    )


@query("project_triple", f"WITH {_CLEAN} SELECT subject, predicate, object FROM cl")
def project_triple(spark, sf):
    return _clean(spark, sf).select("subject", "predicate", "object")


@query("distinct_spo", f"WITH {_CLEAN} SELECT subject, predicate, object FROM tri")
def distinct_spo(spark, sf):
    return tr.distinct_triples(_clean(spark, sf))


@query(
    "triple_report",
    f"""WITH {_TYPED}, m AS (SELECT (SELECT count(*) FROM raw) AS candidates, (SELECT count(*) FROM tri) AS triples,
      (SELECT count(DISTINCT subject) FROM tri WHERE subject <> '') AS subjects,
      (SELECT count(DISTINCT predicate) FROM tri WHERE predicate <> '') AS predicates,
      (SELECT count(DISTINCT object) FROM tri WHERE object <> '') AS objects,
      (SELECT count(*) FROM ts) AS typed_subjects, (SELECT count(*) FROM tob) AS typed_objects)
    UNPIVOT m ON COLUMNS(*) INTO NAME name VALUE value""",
)
def triple_report(spark, sf):
    counted = cut_lineage(
        _clean(spark, sf).groupBy("subject", "predicate", "object").agg(F.count("*").alias("copies"))
    )
    not_empty = "subject <> '' OR predicate <> '' OR object <> ''"
    # parts as rows: one grouping yields the distinct subjects, predicates and objects together
    parts = F.array(
        F.struct(F.lit("subjects").alias("part"), F.col("subject").alias("entity")),
        F.struct(F.lit("predicates").alias("part"), F.col("predicate").alias("entity")),
        F.struct(F.lit("objects").alias("part"), F.col("object").alias("entity")),
    )
    part_values = cut_lineage(counted.select(F.inline(parts)).where("entity <> ''").distinct())
    typed = _typed(spark, sf, part_values.where("part <> 'predicates'").select("entity").distinct())
    marked = part_values.join(typed.select("entity", F.lit(1).alias("hit")), "entity", "left")
    part_counts = marked.agg(
        *[F.count_if(F.col("part") == p).alias(p) for p in ("subjects", "predicates", "objects")],
        *[F.count_if((F.col("part") == p) & F.col("hit").isNotNull()).alias(f"typed_{p}") for p in ("subjects", "objects")],
    )
    totals = counted.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("candidates"), F.count_if(F.expr(not_empty)).alias("triples")
    )
    return ct.metric_rows(totals).unionByName(ct.metric_rows(part_counts))


# ---- mentions and typing ------------------------------------------------------------------------------------------


@query(
    "gazetteer_clean",
    f"""WITH {_MENTIONS} SELECT DISTINCT {_camel("replace(lower(mention), '''', '')")} AS term,
    CASE WHEN type = '' THEN 'Misc' ELSE upper(type[1]) || lower(type[2:]) END AS type FROM men""",
)
def gazetteer_clean(spark, sf):
    return tr.clean_gazetteer(_mentions(spark, sf))


_ANNOTATIONS = f"""{sq.TOKENS}, {sq.GAZETTEER},
  ann AS (SELECT doc_id, w AS mention, type FROM tok JOIN gaz ON w = term)"""


def _doc_mentions(spark, sf):
    """(doc_id, mention, type, n): counted before the join, so a word moves once per document."""
    words = v.doc_tokens(spark, sf).select("doc_id", F.inline(tx.counted(F.col("words"))).alias("mention", "n"))
    gazetteer = broadcast_if_small(v.gazetteer(spark, sf).withColumnRenamed("term", "mention"))
    return words.join(gazetteer, "mention")


@query("mention_count", f"WITH {_ANNOTATIONS} SELECT mention, count(*) AS n FROM ann GROUP BY mention")
def mention_count(spark, sf):
    return _doc_mentions(spark, sf).groupBy("mention").agg(F.sum("n").alias("n"))


@query(
    "mention_type_count",
    f"WITH {_ANNOTATIONS} SELECT type, count(*) AS n, count(DISTINCT mention) AS n_unique FROM ann GROUP BY type",
)
def mention_type_count(spark, sf):
    per_mention = _doc_mentions(spark, sf).groupBy("mention", "type").agg(F.sum("n").alias("n"))
    return per_mention.groupBy("type").agg(F.sum("n").alias("n"), F.count("*").alias("n_unique"))


@query("doc_mention_count", f"WITH {_ANNOTATIONS} SELECT doc_id, count(*) AS n FROM ann GROUP BY doc_id")
def doc_mention_count(spark, sf):
    return _doc_mentions(spark, sf).groupBy("doc_id").agg(F.sum("n").alias("n"))


@query(
    "ontology_label_count",
    f"""WITH {sq.TOKENS}, {sq.LEXICON} SELECT w AS label, lang AS ontology, count(*) AS n FROM tok
    JOIN lexicon ON w = word JOIN documents USING (doc_id) GROUP BY ALL""",
)
def ontology_label_count(spark, sf):
    words = v.corpus(spark, sf).select(
        F.col("lang").alias("ontology"), F.explode(tx.tokens(F.col("text"))).alias("label")
    )
    counted = ct.count_by(words, "label", "ontology")
    return counted.join(v.lexicon(spark, sf), F.col("label") == F.col("word"), "left_semi")


@query("entity_typing_subj", f"WITH {_TYPED} SELECT entity, type FROM ts")
def entity_typing_subj(spark, sf):
    return _typed_side(spark, sf, "subject")


@query("entity_typing_obj", f"WITH {_TYPED} SELECT entity, type FROM tob")
def entity_typing_obj(spark, sf):
    return _typed_side(spark, sf, "object")


@query("entity_union", f"WITH {_TYPED} SELECT * FROM ts UNION ALL SELECT * FROM tob")
def entity_union(spark, sf):
    # type each distinct entity once, then give one row per side it stands on
    sides = F.array(
        F.struct(F.lit("s").alias("side"), F.col("subject").alias("entity")),
        F.struct(F.lit("o").alias("side"), F.col("object").alias("entity")),
    )
    held = cut_lineage(_clean(spark, sf).select(F.inline(sides)).where("entity <> ''").distinct())
    typed = _typed(spark, sf, held.select("entity").distinct())
    return held.join(typed, "entity").select("entity", "type")


@query("entity_set", f"WITH {_TYPED} SELECT entity, type FROM te")
def entity_set(spark, sf):
    return _all_typed(spark, sf, _clean(spark, sf))


@query(
    "triple_semi",
    f"""WITH {_TYPED} SELECT subject, predicate, object FROM tri
    WHERE subject IN (SELECT entity FROM te) OR object IN (SELECT entity FROM te)""",
)
def triple_semi(spark, sf):
    t = _triples(spark, sf)
    return tr.triples_with_terms(t, cut_lineage(_all_typed(spark, sf, t)))


def _triple_types(spark, sf):
    t = _triples(spark, sf)
    typed = cut_lineage(_all_typed(spark, sf, t))
    kept = cut_lineage(tr.triples_with_terms(t, typed))
    sides = [cut_lineage(typed.join(tr.part_set(t, side), "entity", "left_semi")) for side in ("subject", "object")]
    release(t, typed)
    reclaim(spark)
    types = tr.triple_types(kept, *sides)
    release(*sides)
    return types


@query("triple_types", f"WITH {_TYPES} SELECT * FROM ty")
def triple_types(spark, sf):
    return _triple_types(spark, sf)


@query(
    "typed_filter",
    f"WITH {_TYPES} SELECT DISTINCT * FROM ty WHERE NOT (subject_type = 'Other' AND object_type = 'Other')",
)
def typed_filter(spark, sf):
    return tr.keep_typed(_triple_types(spark, sf))


@query(
    "untyped_entities",
    f"""WITH {_TYPES}, u AS (SELECT CASE WHEN subject_type = 'Other' THEN subject WHEN object_type = 'Other' THEN object END
    AS entity FROM ty) SELECT DISTINCT entity FROM u WHERE entity IS NOT NULL""",
)
def untyped_entities(spark, sf):
    return tr.untyped_entities(_triple_types(spark, sf))


# ---- classes and ontology rows ------------------------------------------------------------------------------------


@query("schema_class", f"WITH {_TYPED} SELECT entity, {_schema('entity')} AS class FROM te")
def schema_class(spark, sf):
    words = spark.createDataFrame(list(enumerate(v.SCHEMA_WORDS)), "ord int, word string")
    entities = cut_lineage(_all_typed(spark, sf, _clean(spark, sf)).select("entity"))
    return tr.schema_class_by_table(entities, words)


@query("schema_class_count", f"WITH {_TYPED} SELECT {_schema('entity')} AS class, count(*) AS n FROM te GROUP BY ALL")
def schema_class_count(spark, sf):
    entities = _all_typed(spark, sf, _clean(spark, sf))
    return ct.count_by(entities.select(tr.schema_class(F.col("entity"), v.SCHEMA_WORDS).alias("class")), "class")


@query("typed_triples", f"WITH {_TT} SELECT * FROM tt")
def typed_triples(spark, sf):
    return _typed_triples(spark, sf)


@query(
    "ont_individuals",
    f"""WITH {_TT} SELECT subject_class AS class, subject AS individual FROM tt
    UNION SELECT object_class, object FROM tt""",
)
def ont_individuals(spark, sf):
    return tr.individuals(_typed_triples(spark, sf))


@query("ont_facts", f"WITH {_TT} SELECT DISTINCT subject, predicate AS property, object, 'Obj' AS kind FROM tt")
def ont_facts(spark, sf):
    return tr.facts(_typed_triples(spark, sf))


@query(
    "ont_props",
    f"""WITH {_TT} SELECT DISTINCT predicate AS property, subject_class AS domain, object_class AS "range", 'Func' AS kind
    FROM tt""",
)
def ont_props(spark, sf):
    return tr.object_properties(_typed_triples(spark, sf))


@query(
    "render_triples",
    f"""WITH {_TT} SELECT subject || ',' || predicate || ',' || object || ',Obj' AS fact,
    subject || ';' || predicate || ';' || object AS line FROM tt""",
)
def render_triples(spark, sf):
    return _typed_triples(spark, sf).select(
        F.concat_ws(",", "subject", "predicate", "object", F.lit("Obj")).alias("fact"),
        F.concat_ws(";", "subject", "predicate", "object").alias("line"),
    )


@query(
    "top_distinct",
    f"""WITH {_CLEAN}, e AS (SELECT subject AS x FROM tri UNION SELECT object FROM tri),
    t AS (SELECT x FROM e WHERE x <> '' ORDER BY x DESC LIMIT 100)
    SELECT string_agg(x, ' ' ORDER BY x DESC) AS top_terms FROM t""",
)
def top_distinct(spark, sf):
    top = _entities(_clean(spark, sf)).orderBy(F.desc("entity")).limit(100)
    return top.agg(F.array_join(F.sort_array(F.collect_list("entity"), asc=False), " ").alias("top_terms"))


@query(
    "term_search",
    f"""WITH {sq.LEXICON}, lab AS (SELECT DISTINCT p_name AS label FROM part
      UNION SELECT DISTINCT lower(url) FROM pages)
    SELECT word AS term, label FROM lab JOIN lexicon ON contains(label, word) WHERE length(word) >= 4""",
)
def term_search(spark, sf):
    labels = (
        v.table(spark, sf, "part")
        .select(F.col("p_name").alias("label"))
        .union(v.table(spark, sf, "pages").select(F.lower("url")))
        .distinct()
    )
    return substring_pairs(labels, "label", v.lexicon(spark, sf), "word", 4).select(F.col("word").alias("term"), "label")
