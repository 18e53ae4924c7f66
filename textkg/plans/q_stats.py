"""Counts, reports, rankings and the basic keyed operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkg.functions import tagging as tg
from textkg.functions import text as tx
from textkg.operators import counts as ct
from textkg.operators import lists as ls
from textkg.operators import ordinals as od
from textkg.operators import tfidf as ti
from textkg.plans import sqltext as sq
from textkg.plans import views as v
from textkg.plans.catalog import query
from textkg.session import once

# ---- counts over documents ----------------------------------------------------------------------------------------


def _n_docs(spark, sf):
    return ti.n_documents(v.table(spark, sf, "documents"))


def _kept_lemmas(spark, sf):
    return ct.lemma_tokens(v.corpus(spark, sf)).where(~F.col("lemma").isin(*tx.STOPWORDS))


@query(
    "word_count",
    f"WITH {sq.TOKENS} SELECT w AS word, count(*) AS n FROM tok WHERE w NOT IN ({sq.STOP}) GROUP BY w",
)
def word_count(spark, sf):
    kept = v.tokens(spark, sf).select(F.col("surface").alias("word")).where(~F.col("word").isin(*tx.STOPWORDS))
    return ct.count_by(kept, "word").orderBy(F.desc("n"), "word")


@query(
    "lemma_pos_count",
    f"WITH {sq.LEMMAS} SELECT lemma, pos, count(*) AS n FROM lemt WHERE lemma NOT IN ({sq.STOP}) GROUP BY ALL",
)
def lemma_pos_count(spark, sf):
    return ct.count_by(_kept_lemmas(spark, sf), "lemma", "pos")


@query("pos_count", f"WITH {sq.LEMMAS} SELECT pos, count(*) AS n FROM lemt GROUP BY pos")
def pos_count(spark, sf):
    return ct.count_by(ct.lemma_tokens(v.corpus(spark, sf)), "pos")


@query(
    "dict_count",
    f"""WITH {sq.LEMMAS}, {sq.LEXICON}, c AS (SELECT lemma, pos, count(*) AS n FROM lemt GROUP BY ALL)
    SELECT lemma, pos, n, CASE WHEN l.word IS NULL THEN 0 ELSE n END AS hits FROM c
    LEFT JOIN lexicon l ON c.lemma = l.word""",
)
def dict_count(spark, sf):
    counted = ct.count_by(ct.lemma_tokens(v.corpus(spark, sf)), "lemma", "pos")
    return ct.dictionary_hits(counted, "lemma", v.lexicon(spark, sf)).select("lemma", "pos", "n", "hits")


@query(
    "dict_flag",
    f"""WITH {sq.TOKENS}, {sq.LEXICON} SELECT w AS surface, count(*) AS n,
    CASE WHEN max(l.word) IS NULL THEN 0 ELSE 1 END AS known FROM tok LEFT JOIN lexicon l ON tok.w = l.word GROUP BY w""",
)
def dict_flag(spark, sf):
    counted = ct.count_by(v.tokens(spark, sf), "surface")
    return ct.dictionary_hits(counted, "surface", v.lexicon(spark, sf)).select("surface", "n", "known")


@query(
    "dict_semi",
    f"""WITH {sq.TOKENS}, {sq.LEXICON} SELECT count(DISTINCT w) AS n_words, count(*) AS n_tokens FROM tok
    WHERE w IN (SELECT word FROM lexicon)""",
)
def dict_semi(spark, sf):
    counted = ct.count_by(v.tokens(spark, sf), "surface")
    known = counted.join(v.lexicon(spark, sf), F.col("surface") == F.col("word"), "left_semi")
    return known.agg(F.count("*").alias("n_words"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_tokens"))


@query(
    "grand_totals",
    f"""WITH {sq.LEMMAS} SELECT (SELECT count(*) FROM documents) AS n_docs,
    count(*) AS n_lemmas, count(DISTINCT lemma) AS n_distinct, sum(length(lemma))::BIGINT AS n_chars FROM lemt""",
)
def grand_totals(spark, sf):
    per_lemma = ct.lemma_tokens(v.corpus(spark, sf)).groupBy("lemma").agg(F.count("*").alias("n"))
    return per_lemma.agg(
        _n_docs(spark, sf).alias("n_docs"),
        F.sum("n").alias("n_lemmas"),
        F.count("*").alias("n_distinct"),
        F.sum(F.length("lemma") * F.col("n")).alias("n_chars"),
    )


@query(
    "doc_token_count",
    f"WITH {sq.DOC_TOKENS} SELECT doc_id, len(words)::BIGINT AS n_tokens FROM dt",
)
def doc_token_count(spark, sf):
    return v.corpus(spark, sf).select("doc_id", F.size(tx.tokens(F.col("text"))).cast("bigint").alias("n_tokens"))


@query(
    "noun_verb_counts",
    f"""WITH {sq.LEMMAS}, g AS (SELECT doc_id, count(*) FILTER (WHERE pos = 'nn') AS n_nouns,
      count(*) FILTER (WHERE pos = 'vb') AS n_verbs,
      count(DISTINCT lemma) FILTER (WHERE pos = 'nn') AS u_nouns,
      count(DISTINCT lemma) FILTER (WHERE pos = 'vb') AS u_verbs FROM lemt GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_nouns, 0) AS n_nouns, coalesce(n_verbs, 0) AS n_verbs, coalesce(u_nouns, 0) AS u_nouns,
      coalesce(u_verbs, 0) AS u_verbs FROM documents d LEFT JOIN g USING (doc_id)""",
)
def noun_verb_counts(spark, sf):
    return ct.noun_verb_sets(v.corpus(spark, sf)).select(
        "doc_id",
        "n_nouns",
        "n_verbs",
        F.size("nouns").cast("bigint").alias("u_nouns"),
        F.size("verbs").cast("bigint").alias("u_verbs"),
    )


@query(
    "noun_verb_report",
    f"""WITH {sq.LEMMAS} SELECT doc_id, count(*) FILTER (WHERE pos = 'nn') || chr(10)
      || string_agg(DISTINCT lemma, chr(10) ORDER BY lemma) FILTER (WHERE pos = 'nn') || chr(10) || chr(10)
      || count(*) FILTER (WHERE pos = 'vb') || chr(10)
      || string_agg(DISTINCT lemma, chr(10) ORDER BY lemma) FILTER (WHERE pos = 'vb') AS report
    FROM lemt WHERE doc_id <> 10 GROUP BY doc_id
    HAVING count(*) FILTER (WHERE pos = 'nn') > 0 AND count(*) FILTER (WHERE pos = 'vb') > 0""",
)
def noun_verb_report(spark, sf):
    # leaving out document 10 is part of the report's definition
    return ct.noun_verb_report(v.corpus(spark, sf), F.col("doc_id") == 10)


@query(
    "pos_class",
    f"""WITH {sq.LEMMAS} SELECT CASE WHEN regexp_matches(pos, '^nn') THEN 'noun' WHEN regexp_matches(pos, '^vb')
    THEN 'verb' ELSE 'other' END AS word_class, count(*) AS n FROM lemt GROUP BY ALL""",
)
def pos_class(spark, sf):
    word_class = F.when(F.col("pos").rlike("^nn"), "noun").when(F.col("pos").rlike("^vb"), "verb").otherwise("other")
    return ct.count_by(ct.lemma_tokens(v.corpus(spark, sf)).select(word_class.alias("word_class")), "word_class")


@query(
    "corpus_report",
    f"""WITH {sq.LEMMAS}, {sq.LEXICON},
    m AS (SELECT (SELECT count(*) FROM documents) AS documents, count(*) AS lemmas,
      count(DISTINCT (lemma, pos)) AS distinct_lemmas,
      count(*) FILTER (WHERE lemma IN (SELECT word FROM lexicon)) AS dictionary_hits,
      count(DISTINCT (lemma, pos)) FILTER (WHERE lemma IN (SELECT word FROM lexicon)) AS dictionary_words,
      count(*) FILTER (WHERE pos = 'nn') AS nouns, count(*) FILTER (WHERE pos = 'vb') AS verbs FROM lemt)
    UNPIVOT m ON COLUMNS(*) INTO NAME name VALUE value""",
)
def corpus_report(spark, sf):
    counted = ct.count_by(ct.lemma_tokens(v.corpus(spark, sf)), "lemma", "pos")
    flagged = ct.dictionary_hits(counted, "lemma", v.lexicon(spark, sf))
    return ct.metric_rows(
        flagged.agg(
            _n_docs(spark, sf).alias("documents"),
            F.sum("n").alias("lemmas"),
            F.count("*").alias("distinct_lemmas"),
            F.sum("hits").alias("dictionary_hits"),
            F.sum("known").alias("dictionary_words"),
            F.sum(F.when(F.col("pos") == "nn", F.col("n")).otherwise(0)).alias("nouns"),
            F.sum(F.when(F.col("pos") == "vb", F.col("n")).otherwise(0)).alias("verbs"),
        )
    )


# ---- term weights -------------------------------------------------------------------------------------------------

_TF = f"WITH {sq.TOKENS}, tf AS (SELECT doc_id, w AS term, count(*) AS tf FROM tok GROUP BY ALL)"
_TFN = _TF + ", nd AS (SELECT count(*) AS nd FROM documents), idf AS (SELECT term, count(*) AS df FROM tf GROUP BY term)"


@query("tf_exact", f"{_TF} SELECT doc_id, term, tf FROM tf")
def tf_exact(spark, sf):
    return ti.term_frequency(v.doc_tokens(spark, sf)).select("doc_id", "term", F.col("tf").cast("bigint").alias("tf"))


@query("idf", f"{_TFN} SELECT term, df, round(ln((nd + 1) / (df + 1)), 6) AS idf FROM idf, nd")
def idf(spark, sf):
    return ti.inverse_document_frequency(v.doc_tokens(spark, sf), n_docs=_n_docs(spark, sf)).withColumn("idf", F.round("idf", 6))


@query(
    "tfidf_doc_term",
    f"{_TFN} SELECT doc_id, term, round(tf * ln((nd + 1) / (df + 1)), 6) AS score FROM tf JOIN idf USING (term), nd",
)
def tfidf_doc_term(spark, sf):
    return ti.tfidf(v.doc_tokens(spark, sf), n_docs=_n_docs(spark, sf)).select("doc_id", "term", F.round("score", 6).alias("score"))


@query(
    "tfidf_last_doc",
    f"""{_TFN}, l AS (SELECT term, arg_max(tf, doc_id) AS tf FROM tf GROUP BY term)
    SELECT term, round(tf * ln((nd + 1) / (df + 1)), 6) AS score FROM l JOIN idf USING (term), nd""",
)
def tfidf_last_doc(spark, sf):
    scores = ti.term_scores(v.doc_tokens(spark, sf), keep="last", n_docs=_n_docs(spark, sf))
    return scores.select("term", F.round("score", 6).alias("score"))


@query(
    "tfidf_ranked",
    f"""{_TFN}, l AS (SELECT term, max(tf) AS tf FROM tf GROUP BY term)
    SELECT term, round(tf * ln((nd + 1) / (df + 1)), 6) AS score FROM l JOIN idf USING (term), nd""",
)
def tfidf_ranked(spark, sf):
    scores = ti.term_scores(v.doc_tokens(spark, sf), n_docs=_n_docs(spark, sf))
    scores = scores.select("term", F.round("score", 6).alias("score"))
    return scores.orderBy(F.desc("score"), "term")


@query(
    "token_rarity",
    f"""WITH {sq.TOKENS}, c AS (SELECT w AS word, count(*) AS n FROM tok GROUP BY w)
    SELECT word, n, round(ln(((SELECT sum(n) FROM c) + 1) / (n + 1)), 6) AS score FROM c""",
)
def token_rarity(spark, sf):
    words = v.tokens(spark, sf).select(F.col("surface").alias("word"))
    return ti.token_rarity(words).withColumn("score", F.round("score", 6))


def _gram_list(n: str) -> str:
    return f"""list_transform(range(1, greatest(len(w) - {n} + 1, 1) + 1),
      lambda i: array_to_string(w[i:i + {n} - 1], ' '))"""


def _gram_scores_sql(grams: str) -> str:
    return f"""WITH {sq.DOC_TOKENS}, k AS (SELECT doc_id, list_filter(words, lambda x: x NOT IN ({sq.STOP})) AS w FROM dt),
    g AS (SELECT doc_id, unnest({grams}) AS term FROM k WHERE len(w) > 0),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL),
    l AS (SELECT term, max(tf) AS tf, count(*) AS df FROM tf GROUP BY term)
    SELECT term, df, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS score FROM l"""


def _gram_scores(spark, sf, grams):
    docs = v.doc_tokens(spark, sf)
    grams_of = docs.select("doc_id", grams(tx.drop_words(F.col("words"))).alias("words"))
    scored = ti.term_scores(grams_of, n_docs=_n_docs(spark, sf))
    return scored.withColumn("score", F.round("score", 6)).orderBy(F.desc("score"), "term")


@query("tfidf_bigrams", _gram_scores_sql(_gram_list("2")))
def tfidf_bigrams(spark, sf):
    return _gram_scores(spark, sf, lambda w: tx.ngrams(w, 2))


@query("tfidf_trigrams", _gram_scores_sql(_gram_list("3")))
def tfidf_trigrams(spark, sf):
    return _gram_scores(spark, sf, lambda w: tx.ngrams(w, 3))


@query("tfidf_ngrams", _gram_scores_sql(" || ".join(_gram_list(n) for n in "123")))
def tfidf_ngrams(spark, sf):
    return _gram_scores(spark, sf, lambda w: tx.ngrams_up_to(w, 3))


@query(
    "tfidf_hashed",
    f"""{_TF}, hb AS (SELECT *, ('0x' || left(md5(term), 5))::BIGINT AS bucket FROM tf),
    pd AS (SELECT doc_id, bucket, sum(tf) AS tf FROM hb GROUP BY ALL),
    pb AS (SELECT bucket, count(*) AS df, arg_max(tf, doc_id) AS tf FROM pd GROUP BY bucket)
    SELECT DISTINCT term, bucket, round(pb.tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS score
    FROM hb JOIN pb USING (bucket)""",
)
def tfidf_hashed(spark, sf):
    return ti.hashed_scores(v.doc_tokens(spark, sf), n_docs=_n_docs(spark, sf)).withColumn("score", F.round("score", 6))


# ---- keyed operators ----------------------------------------------------------------------------------------------


@query(
    "map_square",
    "SELECT l_orderkey, l_linenumber, l_quantity * l_quantity AS squared FROM lineitem",
)
def map_square(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("l_quantity")).alias("squared")
    )


@query("filter_even", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity % 2 = 0")
def filter_even(spark, sf):
    # keeping the even values is the operator itself
    return (
        v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").where("l_quantity % 2 = 0")
    )


@query(
    "flatmap_range",
    "SELECT CAST(x AS INTEGER) AS x, count(*) AS n FROM (SELECT unnest(range(l_linenumber)) AS x FROM lineitem) GROUP BY x",
)
def flatmap_range(spark, sf):
    # sequence(0, -1) counts down, so lines below one are left out first
    lines = v.table(spark, sf, "lineitem").select("l_linenumber").where("l_linenumber > 0")
    return ct.count_by(lines.select(F.explode(F.sequence(F.lit(0), F.col("l_linenumber") - 1)).alias("x")), "x")


@query(
    "basic_actions",
    """SELECT count(*) AS n, sum(l_linenumber)::BIGINT AS total, min(l_linenumber) AS lowest, max(l_linenumber) AS highest
    FROM lineitem""",
)
def basic_actions(spark, sf):
    x = F.col("l_linenumber")
    return v.table(spark, sf, "lineitem").agg(
        F.count("*").alias("n"), F.sum(x).alias("total"), F.min(x).alias("lowest"), F.max(x).alias("highest")
    )


@query(
    "reduce_by_key",
    "SELECT l_suppkey, sum(l_linenumber)::BIGINT AS total FROM lineitem GROUP BY l_suppkey",
)
def reduce_by_key(spark, sf):
    return v.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum("l_linenumber").alias("total"))


@query(
    "group_by_key",
    f"""WITH p AS (SELECT o_custkey, o_orderkey,
      (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // {ls.MAX_LIST} AS part FROM orders)
    SELECT o_custkey, part, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS order_keys FROM p GROUP BY o_custkey, part""",
)
def group_by_key(spark, sf):
    lists = ls.key_lists(v.table(spark, sf, "orders"), "o_custkey", "o_orderkey")
    return lists.select(
        "o_custkey", "part", F.array_join(F.col("values").cast("array<string>"), ",").alias("order_keys")
    )


@query("sort_by_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def sort_by_key(spark, sf):
    return v.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice").orderBy("o_custkey", "o_orderkey")


@query(
    "take_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def take_k(spark, sf):
    return (
        v.table(spark, sf, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(5)
    )


@query(
    "inner_join",
    "SELECT o_orderkey, o_orderstatus, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def inner_join(spark, sf):
    orders = v.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    names = v.table(spark, sf, "customer").select("c_custkey", "c_name")
    return orders.join(names, orders.o_custkey == names.c_custkey).select("o_orderkey", "o_orderstatus", "c_name")


@query(
    "cogroup",
    f"""WITH po AS (SELECT o_custkey AS k, o_orderkey AS x,
      (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // {ls.MAX_LIST} AS part FROM orders),
    pc AS (SELECT c_custkey AS k, c_name AS x,
      (row_number() OVER (PARTITION BY c_custkey ORDER BY c_name) - 1) // {ls.MAX_LIST} AS part FROM customer),
    o AS (SELECT k, part, string_agg(x, ',' ORDER BY x) AS a FROM po GROUP BY 1, 2),
    c AS (SELECT k, part, string_agg(x, ',' ORDER BY x) AS b FROM pc GROUP BY 1, 2)
    SELECT k AS cust, part, coalesce(a, '') AS order_keys, coalesce(b, '') AS names FROM o FULL JOIN c USING (k, part)""",
)
def cogroup(spark, sf):
    orders = v.table(spark, sf, "orders").select(F.col("o_custkey").alias("cust"), "o_orderkey")
    names = v.table(spark, sf, "customer").select(F.col("c_custkey").alias("cust"), "c_name")
    return ls.cogroup_lists(orders, names, "cust", "o_orderkey", "c_name").select(
        "cust",
        "part",
        F.array_join(F.col("left_values").cast("array<string>"), ",").alias("order_keys"),
        F.array_join("right_values", ",").alias("names"),
    )


@query(
    "src_inline",
    """WITH w(priority, weight) AS (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 2),
      ('5-LOW', 1))
    SELECT o_orderpriority AS priority, sum(weight)::BIGINT AS weight FROM orders JOIN w ON o_orderpriority = priority
    GROUP BY ALL""",
)
def src_inline(spark, sf):
    rows = [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 2), ("5-LOW", 1)]
    weights = spark.createDataFrame(rows, "priority string, weight int")
    per_priority = ct.count_by(v.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("priority")), "priority")
    return per_priority.join(weights, "priority").select("priority", (F.col("n") * F.col("weight")).alias("weight"))


@query(
    "last_wins",
    """SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus FROM orders GROUP BY o_custkey""",
)
def last_wins(spark, sf):
    return ct.last_value(v.table(spark, sf, "orders"), "o_custkey", "o_orderstatus", ["o_orderdate", "o_orderkey"])


@query(
    "row_ordinal",
    "SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) - 1 AS ordinal FROM documents",
)
def row_ordinal(spark, sf):
    return od.with_ordinal(v.table(spark, sf, "documents").select("doc_id", "source"), ["source", "doc_id"])


@query(
    "id_batches",
    """SELECT b AS batch, count(*) AS n_ids, string_agg(doc_id, ',' ORDER BY doc_id) AS ids
    FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS b FROM documents) GROUP BY b""",
)
def id_batches(spark, sf):
    return od.batches(v.table(spark, sf, "documents"), "doc_id", 200)


@query(
    "zip_arrays",
    f"""WITH {sq.DOC_TOKENS} SELECT doc_id, unnest(words[1:len(words) - 1]) AS word, unnest(words[2:]) AS next_word
    FROM dt WHERE len(words) > 1""",
)
def zip_arrays(spark, sf):
    docs = v.doc_tokens(spark, sf)
    pairs = once(
        docs,
        "z",
        tx.let(
            F.col("words"),
            lambda w: F.arrays_zip(
                F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))).alias("word"),
                F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))).alias("next_word"),
            ),
        ),
    )
    return pairs.select("doc_id", F.inline("z").alias("word", "next_word"))


@query(
    "lookup_split",
    f"""WITH {sq.TOKENS}, {sq.LEXICON}, c AS (SELECT w, count(*) AS n FROM tok GROUP BY w)
    SELECT CASE WHEN l.word IS NULL THEN 'unknown' ELSE 'known' END AS side, count(*) AS n_words, sum(n)::BIGINT AS n_tokens
    FROM c LEFT JOIN lexicon l ON c.w = l.word GROUP BY 1""",
)
def lookup_split(spark, sf):
    counted = ct.count_by(v.tokens(spark, sf), "surface")
    flagged = ct.dictionary_hits(counted, "surface", v.lexicon(spark, sf))
    return flagged.groupBy(F.when(F.col("known") == 1, "known").otherwise("unknown").alias("side")).agg(
        F.count("*").alias("n_words"), F.sum("n").alias("n_tokens")
    )


@query(
    "this_year",
    "SELECT o_orderkey, year(o_orderdate)::INTEGER AS y FROM orders WHERE year(o_orderdate) = 1998",
)
def this_year(spark, sf):
    from textkg.operators.rules import BUILTINS, Builtin

    orders = v.table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    # `y` is bound, so the built-in filters; the year is given to keep the result stable
    return Builtin("thisYear", ("y",), {"year": 1998}).apply(orders, BUILTINS)


@query(
    "iri_parts",
    """SELECT page_id, left(url, strpos(url, '://') - 1) AS prefix, substr(url, strpos(url, '://') + 3) AS id FROM pages
    WHERE strpos(url, '://') > 0""",
)
def iri_parts(spark, sf):
    from textkg.operators.rules import BUILTINS, Builtin

    pages = v.table(spark, sf, "pages").select("page_id", F.col("url").alias("iri"))
    return Builtin("IRIparts", ("iri", "prefix", "id"), {"separator": "://"}).apply(pages, BUILTINS).drop("iri")


@query(
    "label_by_lang",
    """WITH p AS (SELECT source, lang, text, doc_id, CASE lang WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END AS r
      FROM documents WHERE lang IN ('de', 'fr', 'en'))
    SELECT source, arg_min(md5(text), (r, doc_id)) AS label_md5, arg_min(lang, (r, doc_id)) AS lang FROM p GROUP BY source""",
)
def label_by_lang(spark, sf):
    from textkg.operators.graph import label_by_language

    labels = v.table(spark, sf, "documents").select(
        "source", F.md5(F.col("text").cast("binary")).alias("label_md5"), "doc_id",
        F.when(F.col("lang") != "en", F.col("lang")).alias("lang"),
    )
    # English texts stand for untagged labels, Spanish is a language nobody asked for
    picked = label_by_language(labels, "source", "label_md5", "lang", "doc_id", ["de", "fr"])
    return picked.withColumn("lang", F.coalesce("lang", F.lit("en")))
