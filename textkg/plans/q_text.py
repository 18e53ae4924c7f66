"""Queries over document texts: cleanup, sentences, tokens, lemmas, n-grams and scalar helpers."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from textkg.functions import tagging as tg
from textkg.functions import text as tx
from textkg.operators import counts as ct
from textkg.plans import sqltext as sq
from textkg.plans import views as v
from textkg.plans.catalog import query
from textkg.session import broadcast_if_small, once

# The punctuation entries a token list is filtered by.
PUNCTUATION = (",", ".", ":", ";", "'", "%", "=", "''", "``")


@query(
    "clean_text",
    r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
    '\(.*?\)', '', 'g'), '/', ' ', 'g'), '['',%]', '', 'g'), '\s[0-9]+\s', ' ', 'g'),
    '\s[0-9]+[.][0-9]+\s', ' ', 'g') AS cleaned
    FROM documents""",
)
def clean_text(spark, sf):
    return v.corpus(spark, sf).select("doc_id", tx.clean_text(F.col("text")).alias("cleaned"))


@query(
    "sentence_tokens",
    f"""WITH {sq.SENTENCES} SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no,
    CAST(len(ws) AS INTEGER) AS n_tokens, list_aggregate(ws, 'string_agg', ' ') AS words
    FROM (SELECT doc_id, sent_no, {sq.TOK_OF.format('sentence')} AS ws FROM sent) WHERE len(ws) > 0""",
)
def sentence_tokens(spark, sf):
    words = once(v.sentences(spark, sf), "ws", tx.tokens(F.col("sentence")))
    return words.where(F.size("ws") > 0).select(
        "doc_id", "sent_no", F.size("ws").alias("n_tokens"), F.array_join("ws", " ").alias("words")
    )


@query(
    "explode_tokens",
    f"WITH {sq.TOKENS} SELECT doc_id, CAST(pos_no AS INTEGER) AS pos_no, w AS surface FROM tok",
)
def explode_tokens(spark, sf):
    return v.tokens(spark, sf)


@query(
    "split_tokens",
    """SELECT doc_id, CAST(len(p) AS INTEGER) AS n_parts, p[1] AS first_part, p[len(p)] AS last_part
    FROM (SELECT doc_id, string_split(rtrim(text, ' '), ' ') AS p FROM documents)""",
)
def split_tokens(spark, sf):
    parts = once(v.corpus(spark, sf), "p", tx.space_tokens(F.col("text")))
    return parts.select(
        "doc_id",
        F.size("p").alias("n_parts"),
        F.element_at("p", 1).alias("first_part"),
        F.element_at("p", -1).alias("last_part"),
    )


def _regex_words(spark, sf, *more):
    stages = [RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\s+", toLowercase=True), *more]
    docs = v.corpus(spark, sf)
    return Pipeline(stages=stages).fit(docs).transform(docs)


@query(
    "regex_tokens",
    r"""SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, coalesce(list_aggregate(w, 'string_agg', ' '), '') AS words
    FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '') AS w FROM documents)""",
)
def regex_tokens(spark, sf):
    return _regex_words(spark, sf).select(
        "doc_id", F.size("words").alias("n_words"), F.array_join("words", " ").alias("words")
    )


@query(
    "ml_stopwords",
    rf"""SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, coalesce(list_aggregate(w, 'string_agg', ' '), '') AS words
    FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'),
          lambda x: x <> '' AND x NOT IN ({sq.STOP}, 'le', 'la')) AS w FROM documents)""",
)
def ml_stopwords(spark, sf):
    remover = StopWordsRemover(inputCol="words", outputCol="kept", stopWords=[*tx.STOPWORDS, "le", "la"])
    return _regex_words(spark, sf, remover).select(
        "doc_id", F.size("kept").alias("n_words"), F.array_join("kept", " ").alias("words")
    )


@query(
    "lemmatize",
    f"""WITH {sq.TOKENS}, {sq.LEXICON},
    dict AS (SELECT word AS surface, left(word, 5) AS lemma, 'nn' AS pos FROM lexicon WHERE length(word) > 6),
    l AS (SELECT doc_id, coalesce(d.lemma, {sq.lemma_case('w')}) AS lemma, coalesce(d.pos, {sq.pos_case('w')}) AS pos
          FROM tok LEFT JOIN dict d ON tok.w = d.surface)
    SELECT doc_id, lemma, pos, count(*) AS n FROM l WHERE length(lemma) > 1 GROUP BY ALL""",
)
def lemmatize(spark, sf):
    dictionary = (
        v.lexicon(spark, sf)
        .where(F.length("word") > 6)
        .select(F.col("word").alias("surface"), F.left("word", F.lit(5)).alias("lemma"), F.lit("nn").alias("pos"))
    )
    dictionary = broadcast_if_small(dictionary)
    # one row per document and distinct surface, so the dictionary join sees each word of a document once
    words = v.doc_tokens(spark, sf).select("doc_id", F.inline(tx.counted(F.col("words"))).alias("surface", "n"))
    tagged = tg.with_dictionary(words, dictionary).where(F.length("lemma") > 1)
    return tagged.groupBy("doc_id", "lemma", "pos").agg(F.sum("n").alias("n"))


@query(
    "lemma_sentence",
    f"""WITH {sq.LEMMAS} SELECT d.doc_id, coalesce(g.lemma_text, '') AS lemma_text FROM documents d
    LEFT JOIN (SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos_no) AS lemma_text FROM lemt GROUP BY doc_id) g
    USING (doc_id)""",
)
def lemma_sentence(spark, sf):
    return v.doc_tokens(spark, sf).select(
        "doc_id", F.array_join(F.transform(tg.lemmas(F.col("words")), lambda p: p["lemma"]), " ").alias("lemma_text")
    )


@query(
    "term_normalize",
    f"""WITH {sq.LEMMAS} SELECT doc_id, count(*) AS n_lemmas,
    count(*) FILTER (WHERE lemma = 'alzheimers_disease') AS n_replaced FROM lemt GROUP BY doc_id""",
)
def term_normalize(spark, sf):
    found = once(v.doc_tokens(spark, sf), "l", tg.lemmas(F.col("words"))).where(F.size("l") > 0)
    return found.select(
        "doc_id",
        F.size("l").cast("bigint").alias("n_lemmas"),
        F.size(F.filter("l", lambda p: p["lemma"] == "alzheimers_disease")).cast("bigint").alias("n_replaced"),
    )


@query(
    "punct_filter",
    f"""SELECT doc_id, len(p) AS n_parts, len(list_filter(p, lambda x: x NOT IN ({sq.quoted(PUNCTUATION)}))) AS n_kept
    FROM (SELECT doc_id, string_split(rtrim(text, ' '), ' ') AS p FROM documents)""",
)
def punct_filter(spark, sf):
    parts = once(v.corpus(spark, sf), "p", tx.space_tokens(F.col("text")))
    return parts.select(
        "doc_id",
        F.size("p").cast("bigint").alias("n_parts"),
        F.size(F.filter("p", lambda x: ~x.isin(*PUNCTUATION))).cast("bigint").alias("n_kept"),
    )


@query(
    "length_filter",
    f"WITH {sq.TOKENS} SELECT w AS term, count(*) AS n FROM tok WHERE length(w) > 2 GROUP BY w",
)
def length_filter(spark, sf):
    return (
        v.tokens(spark, sf)
        .where(F.length("surface") > 2)
        .groupBy(F.col("surface").alias("term"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "drop_empty",
    r"""SELECT doc_id, CAST(unnest(range(len(p))) AS INTEGER) AS line_no, unnest(p) AS line
    FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS p FROM documents)""",
)
def drop_empty(spark, sf):
    lines = F.filter(F.split("text", "\n"), lambda x: x != "")
    return v.corpus(spark, sf).select("doc_id", F.posexplode(lines).alias("line_no", "line"))


@query(
    "stopword_filter",
    f"WITH {sq.TOKENS} SELECT doc_id, count(*) AS n_kept, count(DISTINCT w) AS n_distinct FROM tok "
    f"WHERE w NOT IN ({sq.STOP}) GROUP BY doc_id",
)
def stopword_filter(spark, sf):
    kept = once(v.doc_tokens(spark, sf), "k", tx.drop_words(F.col("words"))).where(F.size("k") > 0)
    return kept.select(
        "doc_id",
        F.size("k").cast("bigint").alias("n_kept"),
        F.size(F.array_distinct("k")).cast("bigint").alias("n_distinct"),
    )


@query(
    "phrase_stopwords",
    f"""WITH {sq.SENTENCES} SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no,
    CASE WHEN contains(sentence, ' ') THEN coalesce(list_aggregate(list_filter(string_split(sentence, ' '),
      lambda x: x NOT IN ({sq.STOP})), 'string_agg', ' '), '') ELSE sentence END AS phrase FROM sent""",
)
def phrase_stopwords(spark, sf):
    return v.sentences(spark, sf).select(
        "doc_id", "sent_no", tx.phrase_without(F.col("sentence")).alias("phrase")
    )


@query(
    "to_camel_case",
    f"""WITH {sq.SENTENCES} SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, CASE WHEN contains(sentence, ' ') THEN
    replace(list_aggregate(list_transform(string_split(sentence, ' '), lambda x, i: CASE WHEN i > 1 AND length(x) > 1
      THEN replace(upper(x[1]), 'ẞ', 'ß') || x[2:] ELSE x END), 'string_agg', '_'), '.', '') ELSE sentence END AS identifier
    FROM sent""",
)
def to_camel_case(spark, sf):
    return v.sentences(spark, sf).select(
        "doc_id", "sent_no", tx.to_camel_case(F.col("sentence")).alias("identifier")
    )


@query(
    "squeeze_ws",
    r"""SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\r?\n', ' ', 'g'), '\t+', ' ', 'g')) AS one_line,
    trim(regexp_replace(regexp_replace(text, '\r?\n', '', 'g'), '\t+', ' ', 'g')) AS joined FROM documents""",
)
def squeeze_ws(spark, sf):
    return v.corpus(spark, sf).select(
        "doc_id", tx.squeeze(F.col("text")).alias("one_line"), tx.squeeze(F.col("text"), "").alias("joined")
    )


@query(
    "url_encode",
    "SELECT page_id, replace(url_encode(url), '%20', '+') AS encoded FROM pages",
)
def url_encode(spark, sf):
    return v.table(spark, sf, "pages").select("page_id", F.url_encode("url").alias("encoded"))


@query(
    "split_pick",
    """SELECT page_id, p[1] AS head, p[len(p)] AS last, array_to_string(p[2:], '/') AS rest
    FROM (SELECT page_id, string_split(url, '/') AS p FROM pages)""",
)
def split_pick(spark, sf):
    parts = v.table(spark, sf, "pages").select("page_id", F.split("url", "/").alias("p"))
    return parts.select(
        "page_id",
        F.element_at("p", 1).alias("head"),
        F.element_at("p", -1).alias("last"),
        F.array_join(F.slice("p", 2, 1 << 30), "/").alias("rest"),
    )


def _gram_sql(n: int) -> str:
    return f"""WITH {sq.DOC_TOKENS}, k AS (SELECT doc_id, list_filter(words, lambda x: x NOT IN ({sq.STOP})) AS w FROM dt),
    g AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - {n - 1}, 1) + 1),
      lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS gram FROM k WHERE len(w) > 0)
    SELECT gram, count(*) AS n FROM g GROUP BY gram"""


def _gram_rows(spark, sf, *sizes):
    return ct.gram_rows(once(v.doc_tokens(spark, sf), "w", tx.drop_words(F.col("words"))), "w", *sizes)


@query("bigrams", _gram_sql(2))
def bigrams(spark, sf):
    return ct.count_by(_gram_rows(spark, sf, 2), "gram")


@query("trigrams", _gram_sql(3))
def trigrams(spark, sf):
    return ct.count_by(_gram_rows(spark, sf, 3), "gram")


@query(
    "ngrams_1_to_n",
    f"""WITH {sq.DOC_TOKENS}, k AS (SELECT doc_id, list_filter(words, lambda x: x NOT IN ({sq.STOP})) AS w FROM dt)
    , g AS (SELECT CAST(z AS INTEGER) AS size, unnest(list_transform(range(1, greatest(len(w) - z + 1, 1) + 1),
      lambda i: array_to_string(w[i:i + z - 1], ' '))) AS gram FROM k, range(1, 4) r(z) WHERE len(w) > 0)
    SELECT size, gram, count(*) AS n FROM g GROUP BY ALL""",
)
def ngrams_1_to_n(spark, sf):
    return ct.count_by(_gram_rows(spark, sf, 1, 2, 3), "size", "gram")
