"""Knowledge-graph build and query, rules, reasoning patterns, questions and lexicon lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkg.functions import text as tx
from textkg.operators import axioms as ax
from textkg.operators import closure as cl
from textkg.operators import graph as gr
from textkg.operators import lexicon as lx
from textkg.operators import questions as qn
from textkg.operators import reasoning as rs
from textkg.operators import phrases as ph
from textkg.operators.rules import Rule, derive_all, fixpoint, proof_text, proof_trees, proofs, rule_list
from textkg.plans import sqltext as sq
from textkg.plans import views as v
from textkg.plans.catalog import query
from textkg.session import broadcast_if_small, cut_lineage

_KG = """kg AS (SELECT 'customer:' || c_custkey AS s, 'inNation' AS p, 'nation:' || c_nationkey AS o FROM customer
  UNION ALL SELECT 'supplier:' || s_suppkey, 'inNation', 'nation:' || s_nationkey FROM supplier
  UNION ALL SELECT 'nation:' || n_nationkey, 'inRegion', 'region:' || n_regionkey FROM nation
  UNION ALL SELECT 'order:' || o_orderkey, 'placedBy', 'customer:' || o_custkey FROM orders)"""

_TYPES = """types AS (SELECT 'customer:' || c_custkey AS ind, c_mktsegment AS class FROM customer
  UNION ALL SELECT 'part:' || p_partkey, p_brand FROM part
  UNION ALL SELECT 'supplier:' || s_suppkey, 'Supplier' FROM supplier
  UNION ALL SELECT 'nation:' || n_nationkey, 'Nation' FROM nation
  UNION ALL SELECT 'region:' || r_regionkey, 'Region' FROM region)"""

_EDGES = f"""ce AS (SELECT c_mktsegment AS child, 'Customer' AS parent FROM customer
  UNION SELECT p_brand, p_type FROM part UNION SELECT p_type, 'Product' FROM part
  UNION SELECT * FROM (VALUES {', '.join(str(e) for e in v.UPPER_CLASSES)}))"""

# UNION drops pairs already found, so the cycle ends
_CLOSURE = (
    _EDGES
    + """, cc AS (SELECT child AS class, parent AS ancestor FROM ce
  UNION SELECT cc.class, ce.parent FROM cc JOIN ce ON cc.ancestor = ce.child)"""
)

_PROPER = """pr AS (SELECT class, ancestor FROM cc WHERE class <> ancestor
  AND (ancestor, class) NOT IN (SELECT (class, ancestor) FROM cc)),
  di AS (SELECT class, ancestor FROM pr WHERE (class, ancestor) NOT IN
    (SELECT (a.class, b.ancestor) FROM pr a JOIN pr b ON a.ancestor = b.class))"""

_ALL_TYPES = (
    _TYPES
    + ", "
    + _CLOSURE
    + """, aty AS (SELECT ind, class, bool_or(asserted) AS asserted FROM (SELECT ind, class, true AS asserted FROM types
  UNION ALL SELECT ind, ancestor, false FROM types JOIN cc USING (class) WHERE class <> ancestor) GROUP BY ind, class)"""
)

_FOLLOW = """fo AS (SELECT DISTINCT user_id::VARCHAR AS s, event_type AS p, json_extract_string(props, '$.k') AS o FROM events)"""

_TRIPLETS = (
    _KG
    + """, trp AS (SELECT s AS subject, p AS property, o AS object, 'Obj' AS kind FROM kg
  UNION ALL SELECT 'customer:' || c_custkey, 'fullName', c_name, 'Data' FROM customer
  UNION ALL SELECT 'part:' || p_partkey, 'fullName', p_name, 'Data' FROM part
  UNION ALL SELECT 'part:' || p_partkey, 'size', p_size::VARCHAR, 'Data' FROM part),
  dp AS (SELECT property, dom AS domain, CASE WHEN bool_and(regexp_matches(object, '^[0-9]+$')) THEN 'int' ELSE 'string'
    END AS datatype FROM (SELECT *, upper(subject[1]) || split_part(subject, ':', 1)[2:] AS dom FROM trp WHERE kind = 'Data')
    GROUP BY property, dom)"""
)


# ---- axioms -------------------------------------------------------------------------------------------------------


@query(
    "kg_axioms",
    f"""WITH {_TYPES}, {_EDGES}, c AS (SELECT child AS class FROM ce UNION SELECT parent FROM ce)
    SELECT 'Declaration' AS kind, class AS s, NULL::VARCHAR AS p, NULL::VARCHAR AS o, NULL::VARCHAR AS lit_type,
      'class ' || class AS annotation FROM c
    UNION ALL SELECT 'SubClassOf', child, NULL, parent, NULL, NULL FROM ce
    UNION ALL SELECT 'NamedIndividual', ind, NULL, NULL, NULL, NULL FROM types
    UNION ALL SELECT 'ClassAssertion', ind, NULL, class, NULL, NULL FROM types""",
)
def kg_axioms(spark, sf):
    return v.axioms(spark, sf)


@query(
    "kg_object_props",
    f"""WITH {_TRIPLETS}, k AS (SELECT property, subject, upper(subject[1]) || split_part(subject, ':', 1)[2:] AS domain,
      upper(object[1]) || split_part(object, ':', 1)[2:] AS rng, object FROM trp WHERE kind = 'Obj'),
    n AS (SELECT property, domain, rng, subject, count(DISTINCT object) AS n FROM k GROUP BY ALL),
    op AS (SELECT property, domain, rng, max(n) AS n FROM n GROUP BY ALL)
    SELECT 'ObjectPropertyDomain' AS kind, property AS s, domain AS o FROM op
    UNION SELECT 'ObjectPropertyRange', property, rng FROM op
    UNION SELECT 'FunctionalObjectProperty', property, NULL FROM op WHERE n = 1 AND property <> 'placedBy'
    UNION SELECT 'ObjectPropertyDomain', 'placed', rng FROM op WHERE property = 'placedBy'
    UNION SELECT 'ObjectPropertyRange', 'placed', domain FROM op WHERE property = 'placedBy'
    UNION SELECT 'InverseObjectProperties', property, 'placed' FROM op WHERE property = 'placedBy'""",
)
def kg_object_props(spark, sf):
    return ax.object_property_axioms(v.object_properties(spark, sf)).select("kind", "s", "o")


@query(
    "kg_data_props",
    f"""WITH {_TRIPLETS} SELECT 'DataPropertyDomain' AS kind, property AS s, domain AS o FROM dp
    UNION SELECT 'DataPropertyRange', property, CASE datatype WHEN 'int' THEN 'integer' ELSE 'string' END FROM dp""",
)
def kg_data_props(spark, sf):
    return ax.data_property_axioms(v.data_properties(spark, sf)).select("kind", "s", "o")


@query(
    "kg_facts",
    f"""WITH {_TRIPLETS} SELECT CASE kind WHEN 'Obj' THEN 'ObjectPropertyAssertion' ELSE 'DataPropertyAssertion' END AS kind,
    subject AS s, property AS p, object AS o, CASE WHEN kind = 'Data' THEN (CASE WHEN property IN
      (SELECT property FROM dp WHERE datatype = 'int') THEN 'integer' ELSE 'string' END) END AS lit_type FROM trp""",
)
def kg_facts(spark, sf):
    facts = ax.fact_axioms(v.triplets(spark, sf), v.data_properties(spark, sf))
    return facts.select("kind", "s", "p", "o", "lit_type")


@query(
    "ontology_stats",
    f"""WITH {_TYPES}, {_TRIPLETS}, {_EDGES}
    SELECT 'class' AS entity_kind, count(*) AS n FROM (SELECT child FROM ce UNION SELECT parent FROM ce
      UNION SELECT class FROM types)
    UNION ALL SELECT 'individual', count(*) FROM (SELECT ind FROM types UNION SELECT subject FROM trp
      UNION SELECT object FROM trp WHERE kind = 'Obj')
    UNION ALL SELECT 'object property', count(DISTINCT property) FROM trp WHERE kind = 'Obj'
    UNION ALL SELECT 'data property', count(DISTINCT property) FROM trp WHERE kind = 'Data'""",
)
def ontology_stats(spark, sf):
    facts = ax.fact_axioms(v.triplets(spark, sf), v.data_properties(spark, sf))
    return ax.signature_counts(v.axioms(spark, sf).unionByName(facts))


# ---- class tree ---------------------------------------------------------------------------------------------------


@query("subclasses_all", f"WITH RECURSIVE {_CLOSURE} SELECT ancestor AS class, class AS subclass FROM cc")
def subclasses_all(spark, sf):
    return v.class_closure(spark, sf).select(F.col("ancestor").alias("class"), F.col("class").alias("subclass"))


@query("subclasses_direct", f"WITH RECURSIVE {_CLOSURE}, {_PROPER} SELECT ancestor AS class, class AS subclass FROM di")
def subclasses_direct(spark, sf):
    direct = cl.direct_pairs(v.class_closure(spark, sf), "class")
    return direct.select(F.col("ancestor").alias("class"), F.col("class").alias("subclass"))


@query(
    "superclasses",
    f"""WITH RECURSIVE {_CLOSURE}, {_PROPER} SELECT cc.class, cc.ancestor AS superclass, di.class IS NOT NULL AS direct
    FROM cc LEFT JOIN di ON cc.class = di.class AND cc.ancestor = di.ancestor""",
)
def superclasses(spark, sf):
    above = v.class_closure(spark, sf).select("class", "ancestor")
    direct = cl.direct_pairs(above, "class").withColumn("__d", F.lit(True))
    return above.join(direct, ["class", "ancestor"], "left").select(
        "class", F.col("ancestor").alias("superclass"), F.coalesce("__d", F.lit(False)).alias("direct")
    )


@query(
    "equivalent_classes",
    f"""WITH RECURSIVE {_CLOSURE} SELECT a.class, a.ancestor AS equivalent FROM cc a JOIN cc b ON a.class = b.ancestor
    AND a.ancestor = b.class WHERE a.class <> a.ancestor""",
)
def equivalent_classes(spark, sf):
    return gr.equivalent_classes(v.class_closure(spark, sf))


def _all_types(spark, sf):
    return gr.instances(v.types(spark, sf), v.class_closure(spark, sf))


@query("instances_of", f"WITH RECURSIVE {_ALL_TYPES} SELECT class, ind FROM aty")
def instances_of(spark, sf):
    return _all_types(spark, sf).select("class", "ind")


@query("asserted_vs_inferred", f"WITH RECURSIVE {_ALL_TYPES} SELECT ind, class, asserted FROM aty")
def asserted_vs_inferred(spark, sf):
    return _all_types(spark, sf)


@query(
    "is_entailed",
    f"""WITH RECURSIVE {_ALL_TYPES}, cand AS (SELECT DISTINCT ind, unnest(['Party', 'Place']) AS class FROM types)
    SELECT ind, class, (ind, class) IN (SELECT (ind, class) FROM aty) AS entailed FROM cand""",
)
def is_entailed(spark, sf):
    candidates = v.types(spark, sf).select(
        "ind", F.explode(F.array(F.lit("Party"), F.lit("Place"))).alias("class")
    ).distinct()
    return gr.entailed(candidates, _all_types(spark, sf), ["ind", "class"])


@query(
    "property_domains",
    f"""WITH RECURSIVE {_CLOSURE}, {_TRIPLETS}
    SELECT property, class, bool_or(a) AS asserted FROM (SELECT property, domain AS class, true AS a FROM dp
      UNION ALL SELECT property, ancestor, false FROM dp JOIN cc ON domain = class WHERE domain <> ancestor)
    GROUP BY property, class""",
)
def property_domains(spark, sf):
    axioms = ax.data_property_axioms(v.data_properties(spark, sf))
    return gr.property_domains(axioms, v.class_closure(spark, sf))


# ---- facts --------------------------------------------------------------------------------------------------------


@query(
    "property_values",
    f"""WITH {_TRIPLETS} SELECT subject AS s, property AS p, object AS o FROM trp
    WHERE subject IN (SELECT 'customer:' || c_custkey FROM customer WHERE c_acctbal > 5000)""",
)
def property_values(spark, sf):
    facts = v.triplets(spark, sf).select(
        F.col("subject").alias("s"), F.col("property").alias("p"), F.col("object").alias("o")
    )
    rich = v.table(spark, sf, "customer").where("c_acctbal > 5000")
    return gr.property_values(facts, rich.select(F.concat(F.lit("customer:"), "c_custkey").alias("ind")))


@query(
    "inverse_values",
    f"""WITH {_KG} SELECT o AS s, CASE p WHEN 'placedBy' THEN 'placed' ELSE 'hasNation' END AS p, s AS o FROM kg
    WHERE p IN ('placedBy', 'inRegion')""",
)
def inverse_values(spark, sf):
    inverses = spark.createDataFrame([("placedBy", "placed"), ("inRegion", "hasNation")], "p string, inverse string")
    return gr.inverse_values(v.kg(spark, sf), inverses)


@query("has_value", f"WITH {_KG} SELECT DISTINCT s AS ind FROM kg WHERE p = 'inNation' AND o = 'nation:3'")
def has_value(spark, sf):
    return gr.has_value(v.kg(spark, sf), "inNation", "nation:3")


@query(
    "class_intersection",
    f"""WITH RECURSIVE {_ALL_TYPES}, {_KG} SELECT ind FROM aty WHERE class = 'Customer'
    AND ind IN (SELECT s FROM kg WHERE p = 'inNation' AND o = 'nation:3')""",
)
def class_intersection(spark, sf):
    return gr.class_intersection(_all_types(spark, sf), v.kg(spark, sf), "Customer", [("inNation", "nation:3")])


@query("bgp_one", f"WITH {_KG} SELECT s, o FROM kg WHERE p = 'placedBy'")
def bgp_one(spark, sf):
    return gr.bgp(v.kg(spark, sf), [("?s", "placedBy", "?o")])


@query(
    "bgp_join",
    f"""WITH {_KG} SELECT a.s AS q, a.o AS c, b.o AS n FROM kg a JOIN kg b ON a.o = b.s JOIN kg d ON b.o = d.s
    WHERE a.p = 'placedBy' AND b.p = 'inNation' AND d.p = 'inRegion' AND d.o = 'region:1'""",
)
def bgp_join(spark, sf):
    patterns = [("?q", "placedBy", "?c"), ("?c", "inNation", "?n"), ("?n", "inRegion", "region:1")]
    return gr.bgp(v.kg(spark, sf), patterns)


@query(
    "same_as",
    """WITH RECURSIVE e AS (SELECT doc_id AS a, min(doc_id) OVER (PARTITION BY lang, n_chars) AS b FROM documents
      UNION SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(lower(text))) FROM documents),
    sy AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
    re AS (SELECT a, b FROM sy UNION SELECT re.a, sy.b FROM re JOIN sy ON re.b = sy.a)
    SELECT a AS node, min(b) AS component FROM re GROUP BY a""",
)
def same_as(spark, sf):
    docs = v.table(spark, sf, "documents")
    keys = F.array(
        F.concat_ws("/", "lang", F.col("n_chars").cast("string")), F.md5(F.lower("text").cast("binary"))
    )
    members = docs.select("doc_id", F.explode(keys).alias("k"))
    return cl.connected_components(cl.star_edges(members, "k", "doc_id"))


# ---- rules --------------------------------------------------------------------------------------------------------

RULES = (
    Rule("region", (("?x", "inNation", "?n"), ("?n", "inRegion", "?r")), ("?x", "inRegion", "?r")),
    Rule("origin", (("?q", "placedBy", "?c"), ("?c", "inNation", "?n")), ("?q", "fromNation", "?n")),
)

_EXPLAINED = f"""{_KG}, ex AS (SELECT a.s, 'inRegion' AS p, b.o, 'region' AS rule,
  a.s || ' inNation ' || a.o || '; ' || b.s || ' inRegion ' || b.o AS premises
  FROM kg a JOIN kg b ON a.o = b.s WHERE a.p = 'inNation' AND b.p = 'inRegion'
  UNION ALL SELECT a.s, 'fromNation', b.o, 'origin', a.s || ' placedBy ' || a.o || '; ' || b.s || ' inNation ' || b.o
  FROM kg a JOIN kg b ON a.o = b.s WHERE a.p = 'placedBy' AND b.p = 'inNation')"""


@query("explain", f"WITH {_EXPLAINED} SELECT * FROM ex")
def explain(spark, sf):
    shown = F.array_join(F.transform("premises", lambda t: F.concat_ws(" ", t["s"], t["p"], t["o"])), "; ")
    return derive_all(v.kg(spark, sf), RULES).withColumn("premises", shown)


@query(
    "list_rules",
    f"""WITH {_EXPLAINED} SELECT rule, CASE rule WHEN 'region' THEN '?x inNation ?n, ?n inRegion ?r -> ?x inRegion ?r'
    ELSE '?q placedBy ?c, ?c inNation ?n -> ?q fromNation ?n' END AS text, count(*) AS n_derived FROM ex GROUP BY rule""",
)
def list_rules(spark, sf):
    return rule_list(RULES, derive_all(v.kg(spark, sf), RULES))


@query(
    "rule_class",
    f"""WITH {_KG}, {_TYPES}, r AS (SELECT DISTINCT a.s, b.o FROM kg a JOIN kg b ON a.o = b.s
      WHERE a.p = 'inNation' AND b.p = 'inRegion')
    SELECT s, 'inRegion' AS p, o, 1 AS round FROM r
    UNION ALL SELECT DISTINCT s, 'a', 'LocalBuilder', 2 FROM r JOIN types ON s = ind
    WHERE o = 'region:1' AND class = 'BUILDING'""",
)
def rule_class(spark, sf):
    builder = Rule(
        "builder", (("?x", "inRegion", "region:1"), ("?x", "a", "BUILDING")), ("?x", "a", "LocalBuilder")
    )
    typed = v.types(spark, sf).select(F.col("ind").alias("s"), F.lit("a").alias("p"), F.col("class").alias("o"))
    return fixpoint(v.kg(spark, sf).unionByName(typed), [RULES[0], builder]).where("round > 0")


CHAINED = (*RULES, Rule("from_region", (("?q", "fromNation", "?n"), ("?n", "inRegion", "?r")), ("?q", "fromRegion", "?r")))

# Three levels: an order's region follows from its nation, which follows from its customer's.
_PROOF = f"""{_KG}, g AS (SELECT a.s AS q, a.o AS c, b.o AS n, d.o AS r FROM kg a JOIN kg b ON a.o = b.s JOIN kg d ON b.o = d.s
  WHERE a.p = 'placedBy' AND b.p = 'inNation' AND d.p = 'inRegion'),
tree AS (
  SELECT q AS goal, r AS goal_o, '' AS path, q AS s, 'fromRegion' AS p, r AS o, 2 AS round, 'from_region' AS rule FROM g
  UNION ALL SELECT q, r, '1', q, 'fromNation', n, 1, 'origin' FROM g
  UNION ALL SELECT q, r, '1.1', q, 'placedBy', c, 0, NULL FROM g
  UNION ALL SELECT q, r, '1.2', c, 'inNation', n, 0, NULL FROM g
  UNION ALL SELECT q, r, '2', n, 'inRegion', r, 0, NULL FROM g)"""


def _proof_trees(spark, sf):
    known = cut_lineage(proofs(v.kg(spark, sf), CHAINED))
    return proof_trees(known.where("p = 'fromRegion'").select("s", "p", "o"), known)


@query(
    "explain_tree",
    f"WITH {_PROOF} SELECT goal, goal_o, path, s, p, o, round, rule FROM tree",
)
def explain_tree(spark, sf):
    return _proof_trees(spark, sf).select(
        F.col("goal_s").alias("goal"), "goal_o", F.array_join(F.col("path").cast("array<string>"), ".").alias("path"),
        "s", "p", "o", "round", "rule",
    )


@query(
    "explain_text",
    f"""WITH {_PROOF} SELECT goal, string_agg(repeat('    ', CASE path WHEN '' THEN 0 ELSE len(string_split(path, '.')) END)
      || s || ' ' || p || ' ' || o || coalesce(' [' || rule || ']', ''), chr(10) ORDER BY path) AS lines
    FROM tree GROUP BY goal""",
)
def explain_text(spark, sf):
    return proof_text(_proof_trees(spark, sf)).select(F.col("goal_s").alias("goal"), "lines")


# ---- reasoning patterns -------------------------------------------------------------------------------------------


@query(
    "reason_sym",
    f"WITH {_FOLLOW} SELECT a.s, a.p, a.o FROM fo a JOIN fo b ON a.s = b.o AND a.o = b.s AND a.p = b.p",
)
def reason_sym(spark, sf):
    return rs.symmetric(v.follow(spark, sf))


@query(
    "reason_inv",
    f"WITH {_FOLLOW} SELECT a.s, a.p, a.o, b.p AS p2 FROM fo a JOIN fo b ON a.s = b.o AND a.o = b.s AND a.p <> b.p",
)
def reason_inv(spark, sf):
    return rs.inverse(v.follow(spark, sf))


@query(
    "reason_tra",
    f"WITH {_FOLLOW} SELECT a.p, count(*) AS n FROM fo a JOIN fo b ON a.o = b.s AND a.p = b.p AND a.s <> b.o GROUP BY a.p",
)
def reason_tra(spark, sf):
    return rs.transitive_counts(v.follow(spark, sf))


@query(
    "reason_cha",
    f"""WITH {_FOLLOW} SELECT a.p, b.p AS p2, count(*) AS n FROM fo a JOIN fo b ON a.o = b.s AND a.p <> b.p AND a.s <> b.o
    GROUP BY ALL""",
)
def reason_cha(spark, sf):
    return rs.property_chain_counts(v.follow(spark, sf))


@query(
    "reason_asy",
    f"""WITH {_FOLLOW} SELECT a.s, a.p, a.o, b.p AS p2 FROM fo a JOIN fo b ON a.s = b.o AND a.o = b.s
    WHERE a.p = 'purchase'""",
)
def reason_asy(spark, sf):
    return rs.asymmetry_violations(v.follow(spark, sf), ["purchase"])


@query("reason_irr", f"WITH {_FOLLOW} SELECT s, p, o FROM fo WHERE s = o")
def reason_irr(spark, sf):
    return rs.irreflexive_violations(v.follow(spark, sf))


@query(
    "kg_violations",
    f"""WITH {_FOLLOW} SELECT 'functional' AS violation, s, p, count(*) AS n FROM fo WHERE p = 'signup' GROUP BY s, p
      HAVING count(*) > 1
    UNION ALL SELECT 'asymmetric', a.s, a.p, count(*) FROM fo a JOIN fo b ON a.s = b.o AND a.o = b.s AND a.p = b.p
      WHERE a.p = 'purchase' GROUP BY a.s, a.p
    UNION ALL SELECT 'irreflexive', s, p, 1 FROM fo WHERE s = o AND p = 'click'""",
)
def kg_violations(spark, sf):
    return rs.consistency_violations(v.follow(spark, sf), ["signup"], ["purchase"], ["click"])


# ---- questions ----------------------------------------------------------------------------------------------------

_QUESTIONS = f"""{_KG}, qs AS (SELECT 'who inNation nation:' || n_nationkey AS question FROM nation
  UNION SELECT 'what placed customer:' || c_custkey FROM customer
  UNION SELECT 'which inRegion region:' || r_regionkey FROM region UNION SELECT 'who eats region:' || r_regionkey FROM region),
  qw AS (SELECT question, unnest(string_split(question, ' ')) AS w, unnest(range(len(string_split(question, ' ')))) AS i FROM qs),
  qp AS (SELECT question, arg_max(p, (i, p)) AS predicate FROM qw JOIN (SELECT DISTINCT p FROM kg) ON contains(p, w)
    GROUP BY question),
  qa AS (SELECT question, predicate, string_split(question, ' ')[-1] AS value FROM qs LEFT JOIN qp USING (question))"""


def _questions(spark, sf):
    def ask(name: str, text: str, key: str):
        return v.table(spark, sf, name).select(F.concat(F.lit(text), key).alias("question"))

    return (
        ask("nation", "who inNation nation:", "n_nationkey")
        .union(ask("customer", "what placed customer:", "c_custkey"))
        .union(ask("region", "which inRegion region:", "r_regionkey"))
        .union(ask("region", "who eats region:", "r_regionkey"))
    )


def _predicates(kg):
    return kg.select(F.col("p").alias("predicate")).distinct()


@query("question_to_predicate", f"WITH {_QUESTIONS} SELECT * FROM qa")
def question_to_predicate(spark, sf):
    return qn.question_predicates(_questions(spark, sf), _predicates(v.kg(spark, sf)))


@query(
    "answer_question",
    f"""WITH {_QUESTIONS} SELECT question, CASE WHEN s IS NULL THEN 'Answer not found'
    ELSE s || substr(question, strpos(question, ' ')) END AS answer
    FROM qa LEFT JOIN kg ON predicate = p AND value = o""",
)
def answer_question(spark, sf):
    kg = v.kg(spark, sf)
    return qn.answers(_questions(spark, sf), kg, _predicates(kg))


# ---- lexicon ------------------------------------------------------------------------------------------------------

# In the prefix tree a word's ancestors are all its prefixes that are words, nearest first.
_LEX_UP = (
    sq.LEXICON
    + """, up AS (SELECT w.word, p.word AS ancestor,
  row_number() OVER (PARTITION BY w.word ORDER BY length(p.word) DESC) AS depth
  FROM lexicon w JOIN lexicon p ON starts_with(w.word, p.word) AND length(p.word) < length(w.word))"""
)

_PAIRS = f"""bw AS (SELECT {sq.TOK_OF.format('text')} AS w FROM benchmark),
  wp AS (SELECT DISTINCT a AS w1, b AS w2 FROM (SELECT unnest(w[1:len(w) - 1]) AS a, unnest(w[2:]) AS b FROM bw
    WHERE len(w) > 1) WHERE a <> b)"""

_COMMON = (
    _LEX_UP
    + ", "
    + _PAIRS
    + """, up0 AS (SELECT word, ancestor, depth FROM up UNION ALL SELECT word, word, 0 FROM lexicon),
  co AS (SELECT w1, w2, a.ancestor, min(a.depth + b.depth) AS distance FROM wp JOIN up0 a ON w1 = a.word
    JOIN up0 b ON w2 = b.word AND a.ancestor = b.ancestor GROUP BY ALL)"""
)


def _lex_closure(spark, sf):
    return cl.transitive_closure(v.lex_hyper(spark, sf), "child", "parent").withColumnRenamed("child", "word")


@query("hypernyms", f"WITH {_LEX_UP} SELECT word, ancestor, depth::INTEGER AS depth FROM up")
def hypernyms(spark, sf):
    return _lex_closure(spark, sf)


@query("hyponyms", f"WITH {_LEX_UP} SELECT ancestor AS word, count(*) AS n, max(depth)::INTEGER AS depth FROM up GROUP BY ancestor")
def hyponyms(spark, sf):
    return (
        _lex_closure(spark, sf)
        .groupBy(F.col("ancestor").alias("word"))
        .agg(F.count("*").alias("n"), F.max("depth").alias("depth"))
    )


@query("common_parents", f"WITH {_COMMON} SELECT w1, w2, ancestor, distance::INTEGER AS distance FROM co")
def common_parents(spark, sf):
    return lx.common_ancestors(v.word_pairs(spark, sf), _lex_closure(spark, sf))


@query(
    "lex_distance",
    f"""WITH {_COMMON} SELECT wp.w1, wp.w2, min(distance)::INTEGER AS distance FROM wp LEFT JOIN co
    ON wp.w1 = co.w1 AND wp.w2 = co.w2 GROUP BY ALL""",
)
def lex_distance(spark, sf):
    return lx.word_distance(v.word_pairs(spark, sf), _lex_closure(spark, sf))


_SYN = (
    sq.LEXICON
    + """, ss AS (SELECT left(word, 4) || '/' || length(word) AS synset, word FROM lexicon),
  sl AS (SELECT synset, list(word ORDER BY word) AS m FROM ss GROUP BY synset),
  sy AS (SELECT word, array_to_string(list_filter(m, lambda x: x <> word)[1:10], ',') AS synonyms FROM ss JOIN sl USING (synset))"""
)


@query("lex_synonyms", f"WITH {_SYN} SELECT word, coalesce(synonyms, '') AS synonyms FROM sy")
def lex_synonyms(spark, sf):
    found = lx.synonyms(v.lexicon(spark, sf), v.synsets(spark, sf))
    return found.withColumn("synonyms", F.array_join("synonyms", ","))


@query(
    "dict_synonyms",
    f"""WITH {sq.TOKENS}, {_SYN}, voc AS (SELECT DISTINCT w AS word FROM tok)
    SELECT voc.word, CASE WHEN sy.word IS NULL THEN NULL ELSE coalesce(synonyms, '') END AS synonyms
    FROM voc LEFT JOIN sy USING (word)""",
)
def dict_synonyms(spark, sf):
    vocabulary = v.tokens(spark, sf).select(F.col("surface").alias("word")).distinct()
    return lx.synonyms(vocabulary, v.synsets(spark, sf)).withColumn("synonyms", F.array_join("synonyms", ","))


_SENSES = f"""bw0 AS (SELECT item_id, unnest(list_distinct({sq.TOK_OF.format('text')})) AS word FROM benchmark),
  se AS (SELECT word, CASE WHEN item_id % 2 = 0 THEN {sq.pos_case('word')} ELSE 'nn' END AS pos,
    'item ' || item_id AS gloss FROM bw0)"""


@query(
    "lex_pos",
    f"""WITH {_SENSES}, pp AS (SELECT word, pos, count(*) AS n FROM se GROUP BY ALL)
    SELECT word, string_agg(pos, ',' ORDER BY pos) AS all_pos, arg_min(pos, (-n, pos)) AS best_pos,
    sum(n)::BIGINT AS n_senses FROM pp GROUP BY word""",
)
def lex_pos(spark, sf):
    return lx.pos_list(v.senses(spark, sf))


@query(
    "lex_glosses",
    f"""WITH {_SENSES} SELECT DISTINCT word, pos, gloss FROM se
    WHERE word IN (SELECT unnest({sq.TOK_OF.format('p_name')}) FROM part) OR word IN
      (SELECT unnest({sq.TOK_OF.format('text')}) FROM conversations)""",
)
def lex_glosses(spark, sf):
    asked = (
        v.table(spark, sf, "part")
        .select(F.explode(tx.tokens(F.col("p_name"))).alias("word"))
        .union(v.table(spark, sf, "conversations").select(F.explode(tx.tokens(F.col("text")))))
    )
    return lx.glosses(v.senses(spark, sf), asked)


def _doc_terms(spark, sf):
    return v.doc_tokens(spark, sf).select(
        "doc_id", F.inline(tx.counted(F.col("words"))).alias("word", "n")
    )


_ANN = f"""{sq.TOKENS}, an AS (SELECT doc_id, w AS word, count(*) AS n FROM tok
  WHERE w IN (SELECT word FROM lexicon) GROUP BY ALL)"""


@query("annotate_text", f"WITH {_LEX_UP}, {_ANN} SELECT doc_id, word, CAST(n AS INTEGER) AS n FROM an")
def annotate_text(spark, sf):
    return lx.annotate(_doc_terms(spark, sf), broadcast_if_small(v.lexicon(spark, sf)))


@query(
    "annotate_hierarchy",
    f"""WITH {_LEX_UP}, {_ANN} SELECT doc_id, word, word AS ancestor, 0 AS depth FROM an
    UNION ALL SELECT doc_id, word, ancestor, depth::INTEGER FROM an JOIN up USING (word) WHERE depth <= 3""",
)
def annotate_hierarchy(spark, sf):
    closure = cl.transitive_closure(v.lex_hyper(spark, sf), "child", "parent", max_depth=3)
    annotated = lx.annotate(_doc_terms(spark, sf), broadcast_if_small(v.lexicon(spark, sf)))
    return lx.annotate_ancestors(annotated, closure.withColumnRenamed("child", "word"), 3)


# Windows of one to four words of the benchmark texts, a window's size following from its place.
_PHRASES = f"""bt AS (SELECT {sq.TOK_OF.format('text')} AS w FROM benchmark),
  bp AS (SELECT DISTINCT unnest(list_transform(range(len(w)), lambda i: w[i + 1:i + 1 + i % 4])) AS words FROM bt),
  phr AS (SELECT array_to_string(words, ' ') AS term, len(words) AS n FROM bp)"""

# All windows that are terms, the longest per place, then the chain of those that don't overlap.
_ANNOTATED = f"""{sq.DOC_TOKENS}, {_PHRASES},
  win AS (SELECT doc_id, i AS place, z AS n, array_to_string(words[i + 1:i + z], ' ') AS term
    FROM dt, unnest(range(len(words))) u(i), range(1, 5) r(z) WHERE i + z <= len(words)),
  hit AS (SELECT doc_id, place, max(win.n) AS n, arg_max(win.term, win.n) AS term FROM win JOIN phr USING (term) GROUP BY ALL),
  nxt AS (SELECT a.*, b.place AS nplace FROM hit a ASOF LEFT JOIN hit b ON a.doc_id = b.doc_id AND a.place + a.n <= b.place),
  chain AS (SELECT * FROM nxt WHERE (doc_id, place) IN (SELECT (doc_id, min(place)) FROM hit GROUP BY doc_id)
    UNION ALL SELECT x.* FROM chain c JOIN nxt x ON x.doc_id = c.doc_id AND x.place = c.nplace)"""


def _phrases(spark, sf):
    """(words): distinct windows of the benchmark texts, of one to four words."""
    words = v.table(spark, sf, "benchmark").select(tx.tokens(F.col("text")).alias("w"))
    return words.select(
        F.explode(F.transform("w", lambda x, i: F.slice("w", i + 1, i % 4 + 1))).alias("words")
    ).distinct()


def _annotated_phrases(spark, sf):
    return ph.annotate_phrases(v.doc_tokens(spark, sf), _phrases(spark, sf))


@query(
    "annotate_phrases",
    f"WITH RECURSIVE {_ANNOTATED} SELECT doc_id, CAST(place AS INTEGER) AS place, CAST(n AS INTEGER) AS length, term FROM chain",
)
def annotate_phrases(spark, sf):
    return _annotated_phrases(spark, sf)


@query(
    "annotate_phrase_hierarchy",
    f"""WITH RECURSIVE {_ANNOTATED}, {_LEX_UP}, cnt AS (SELECT doc_id, term, string_split(term, ' ')[-1] AS head, count(*) AS n
      FROM chain GROUP BY ALL)
    SELECT doc_id, term, head AS ancestor, 0 AS depth, n FROM cnt
    UNION ALL SELECT doc_id, term, ancestor, depth::INTEGER, n FROM cnt JOIN up ON head = word WHERE depth <= 3""",
)
def annotate_phrase_hierarchy(spark, sf):
    """A term's class is its last word; the classes above it follow up to three levels."""
    closure = cl.transitive_closure(v.lex_hyper(spark, sf), "child", "parent", max_depth=3)
    head = F.substring_index("term", " ", -1)
    counts = _annotated_phrases(spark, sf).groupBy("doc_id", "term", head.alias("head")).agg(F.count("*").alias("n"))
    counts = cut_lineage(counts)
    own = counts.select("doc_id", "term", F.col("head").alias("ancestor"), F.lit(0).alias("depth"), "n")
    above = counts.join(closure.withColumnRenamed("child", "head"), "head").select("doc_id", "term", "ancestor", "depth", "n")
    return own.unionByName(above)
