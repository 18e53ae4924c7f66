"""Queries of the chain cleanup, sentences, lemmas, triples with places in the source text."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkg.functions import offsets as of
from textkg.functions.text import CLEANUP_RULES
from textkg.plans import sqltext as sq
from textkg.plans import views as v
from textkg.plans.catalog import query
from textkg.session import once


def _starts(p: str, h: str) -> str:
    size = "coalesce(list_sum(list_transform({0}[1:i - 1], lambda x: length(x))), 0)"
    return f"list_transform(range(1, len({p}) + 1), lambda i: CAST({size.format(p)} + {size.format(h)} AS BIGINT))"


def _rule_sql(step: int, pattern: str, replacement: str) -> str:
    """One rule on (text, list of the source place of each of its characters)."""
    pattern = pattern.replace("'", "''")
    blank = "CASE WHEN i <= len(h) THEN [q[st[i] + length(p[i]) + 1]] ELSE [] END" if replacement else "[]"
    return f"""r{step}a AS (SELECT doc_id, q, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS h
  FROM r{step - 1}),
r{step}b AS (SELECT *, {_starts('p', 'h')} AS st FROM r{step}a),
r{step} AS (SELECT doc_id, array_to_string(p, '{replacement}') AS t, flatten(list_transform(range(1, len(p) + 1),
  lambda i: q[st[i] + 1:st[i] + length(p[i])] || {blank})) AS q FROM r{step}b)"""


# Source places are carried along as lists here, not by masking.
CHAIN = (
    "r0 AS (SELECT doc_id, text AS t, range(0, length(text)) AS q FROM documents WHERE text IS NOT NULL),\n"
    + ",\n".join(_rule_sql(i, p, r) for i, (p, r) in enumerate(CLEANUP_RULES, 1))
    + rf""",
sa AS (SELECT doc_id, q, string_split_regex(t, '[.!?]+\s+|\n+') AS p, regexp_extract_all(t, '[.!?]+\s+|\n+') AS h FROM r5),
sb AS (SELECT doc_id, q, p, {_starts('p', 'h')} AS st FROM sa),
sc AS (SELECT doc_id, q, unnest(p) AS sentence, unnest(st) AS sent_start FROM sb),
sd AS (SELECT doc_id, q, sentence, sent_start, row_number() OVER (PARTITION BY doc_id ORDER BY sent_start) - 1 AS sent_no
  FROM sc WHERE trim(sentence) <> ''),
ta AS (SELECT *, string_split_regex(sentence, '[\p{{L}}\p{{N}}]+') AS p, regexp_extract_all(sentence, '[\p{{L}}\p{{N}}]+') AS h FROM sd),
tb AS (SELECT *, {_starts('p', 'h')} AS st FROM ta),
tc AS (SELECT doc_id, sent_no, q, sent_start, unnest(range(1, len(h) + 1)) AS i, p, h, st FROM tb),
td AS (SELECT doc_id, sent_no, q, i, lower(h[i]) AS w, sent_start + st[i] + length(p[i]) AS a, length(h[i]) AS n FROM tc),
te AS (SELECT doc_id, sent_no, i, {sq.lemma_case('w')} AS lemma, {sq.pos_case('w')} AS pos, q[a + 1] AS start,
  q[a + n] - q[a + 1] + 1 AS length FROM td),
lemmas AS (SELECT * FROM te WHERE length(lemma) > 1),
kd AS (SELECT *, CASE pos WHEN 'nn' THEN 'N' WHEN 'vb' THEN 'V' ELSE 'X' END AS k FROM lemmas WHERE pos <> 'dt'),
ch AS (SELECT *, CASE WHEN k = lag(k) OVER s THEN 0 ELSE 1 END AS fresh FROM kd WINDOW s AS (PARTITION BY doc_id, sent_no ORDER BY i)),
cn AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, sent_no ORDER BY i) AS c FROM ch),
cx AS (SELECT doc_id, sent_no, c, min(k) AS k, string_agg(lemma, ' ' ORDER BY i) AS t, min(start) AS a, max(start + length) AS b
  FROM cn GROUP BY ALL),
nx AS (SELECT doc_id, sent_no, c, k, t, a, b, lead(k, 1) OVER s AS k1, lead(t, 1) OVER s AS t1, lead(a, 1) OVER s AS a1,
  lead(b, 1) OVER s AS b1, lead(k, 2) OVER s AS k2, lead(t, 2) OVER s AS t2, lead(a, 2) OVER s AS a2, lead(b, 2) OVER s AS b2
  FROM cx WINDOW s AS (PARTITION BY doc_id, sent_no ORDER BY c)),
triples AS (SELECT * FROM nx WHERE k = 'N' AND k1 = 'V' AND k2 = 'N')"""
)


def placed_sentences(spark, sf):
    """(doc_id, source, sent_no, sentence, start) of the cleaned texts, still masked; `source` is the sentence before cleanup."""
    masked = once(v.corpus(spark, sf).select("doc_id", "text"), "masked", of.mask_clean(F.col("text")))
    placed = of.with_sources(F.col("text"), F.col("masked"))
    return masked.select("doc_id", F.posexplode(placed).alias("sent_no", "s")).select(
        "doc_id", F.col("s.source").alias("source"), "sent_no", F.col("s.text").alias("sentence"), F.col("s.start").alias("start")
    )


def _mention(start: str, length: str):
    """The mention, looked up in the source of its sentence: in the whole text each look-up would walk all that comes before."""
    return F.substring("source", F.col(start) - F.col("sent_start") + 1, F.col(length))


@query(
    "chain_lemmas",
    f"""WITH {CHAIN} SELECT l.doc_id, CAST(sent_no AS INTEGER) AS sent_no, lemma, pos, CAST(start AS INTEGER) AS start,
    CAST(length AS INTEGER) AS length, d.text[start + 1:start + length] AS mention
    FROM lemmas l JOIN documents d USING (doc_id)""",
)
def chain_lemmas(spark, sf):
    return (
        placed_sentences(spark, sf)
        .select(
            "doc_id", "source", "sent_no", F.col("start").alias("sent_start"),
            F.inline(of.located_lemmas(F.col("sentence"), F.col("start"), mark=False)),
        )
        .select("doc_id", "sent_no", "lemma", "pos", "start", "length", _mention("start", "length").alias("mention"))
    )


@query(
    "chain_lemma_text",
    f"""WITH {CHAIN}, s AS (SELECT doc_id, sent_no, string_agg(lemma, ' ' ORDER BY i) AS t FROM lemmas GROUP BY ALL),
    m AS (SELECT sd.doc_id, string_agg(coalesce(s.t || ' ', '') || '.', ' ' ORDER BY sd.sent_no) AS t
      FROM sd LEFT JOIN s USING (doc_id, sent_no) GROUP BY sd.doc_id)
    SELECT d.doc_id, coalesce(m.t, '') AS lemma_text FROM documents d LEFT JOIN m USING (doc_id)""",
)
def chain_lemma_text(spark, sf):
    masked = once(v.corpus(spark, sf).select("doc_id", "text"), "masked", of.mask_clean(F.col("text")))
    marked = F.transform(
        of.located_sentences(F.col("masked")), lambda s: of.located_lemmas(s["text"], s["start"])["lemma"]
    )
    return masked.select("doc_id", F.coalesce(F.array_join(F.flatten(marked), " "), F.lit("")).alias("lemma_text"))


_TRIPLE_SQL = ", ".join(
    f"{t} AS {n}, CAST({a} AS INTEGER) AS {n}_start, CAST({b} - {a} AS INTEGER) AS {n}_length, d.text[{a} + 1:{b}] AS {n}_mention"
    for n, t, a, b in (("subject", "t", "a", "b"), ("predicate", "t1", "a1", "b1"), ("object", "t2", "a2", "b2"))
)


@query(
    "chain_triples",
    f"""WITH {CHAIN} SELECT x.doc_id, CAST(sent_no AS INTEGER) AS sent_no, {_TRIPLE_SQL}
    FROM triples x JOIN documents d USING (doc_id)""",
)
def chain_triples(spark, sf):
    found = placed_sentences(spark, sf).select(
        "doc_id", "source", "sent_no", F.col("start").alias("sent_start"),
        F.inline(of.located_triples(of.located_lemmas(F.col("sentence"), F.col("start"), mark=False))),
    )
    parts = ("subject", "predicate", "object")
    return found.select(
        "doc_id", "sent_no",
        *[F.col(c) for p in parts for c in (p, f"{p}_start", f"{p}_length")],
        *[_mention(f"{p}_start", f"{p}_length").alias(f"{p}_mention") for p in parts],
    )
