"""Shared pieces of the DuckDB statements: each is a list of common table expressions."""

from textkg.functions.tagging import AUXILIARIES, DETERMINERS, SYNONYMS
from textkg.functions.text import STOPWORDS
from textkg.plans.views import MENTION_TYPES


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOP = quoted(STOPWORDS)

TOK_OF = r"list_filter(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"

DOC_TOKENS = f"dt AS (SELECT doc_id, {TOK_OF.format('text')} AS words FROM documents)"

TOKENS = (
    DOC_TOKENS
    + ", tok AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS pos_no FROM dt WHERE len(words) > 0)"
)

SENTENCES = r"""sent AS (
  SELECT doc_id, unnest(s) AS sentence, unnest(range(len(s))) AS sent_no
  FROM (SELECT doc_id, list_filter(string_split_regex(text, '[.!?]+\s+|\n+'), lambda x: trim(x) <> '') AS s
        FROM documents) WHERE len(s) > 0)"""


def pos_case(w: str) -> str:
    return (
        f"CASE WHEN {w} IN ({quoted(DETERMINERS)}) THEN 'dt' WHEN {w} IN ({quoted(AUXILIARIES)}) THEN 'vb'"
        f" WHEN {w} LIKE '%ing' OR {w} LIKE '%ed' THEN 'vb' WHEN {w} LIKE '%ly' THEN 'rb' ELSE 'nn' END"
    )


def lemma_case(w: str) -> str:
    base = (
        f"CASE WHEN length({w}) > 4 AND {w} LIKE '%ies' THEN left({w}, length({w}) - 3) || 'y'"
        f" WHEN length({w}) > 5 AND {w} LIKE '%ing' THEN left({w}, length({w}) - 3)"
        f" WHEN length({w}) > 4 AND {w} LIKE '%ed' THEN left({w}, length({w}) - 2)"
        f" WHEN length({w}) > 3 AND {w} LIKE '%s' AND {w} NOT LIKE '%ss' THEN left({w}, length({w}) - 1)"
        f" ELSE {w} END"
    )
    for source, target in SYNONYMS.items():
        base = f"CASE WHEN ({base}) = '{source}' THEN '{target}' ELSE ({base}) END"
    return base


# Lemma tokens, one-letter lemmas removed.
LEMMAS = (
    TOKENS
    + f""", lem AS (SELECT doc_id, pos_no, w, {lemma_case('w')} AS lemma, {pos_case('w')} AS pos FROM tok),
  lemt AS (SELECT * FROM lem WHERE length(lemma) > 1)"""
)

# Candidate triples by window functions over sentence tokens.
TRIPLES = (
    SENTENCES
    + f""", st AS (
  SELECT doc_id, sent_no, unnest(ws) AS w, unnest(range(len(ws))) AS pos_no
  FROM (SELECT doc_id, sent_no, {TOK_OF.format('sentence')} AS ws FROM sent) WHERE len(ws) > 0),
tg AS (SELECT *, {pos_case('w')} AS tag FROM st),
kd AS (SELECT doc_id, sent_no, pos_no, w, CASE tag WHEN 'nn' THEN 'N' WHEN 'vb' THEN 'V' ELSE 'X' END AS k
       FROM tg WHERE tag <> 'dt'),
ch AS (SELECT *, CASE WHEN k = lag(k) OVER s THEN 0 ELSE 1 END AS fresh FROM kd
       WINDOW s AS (PARTITION BY doc_id, sent_no ORDER BY pos_no)),
cn AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, sent_no ORDER BY pos_no) AS c FROM ch),
cx AS (SELECT doc_id, sent_no, c, min(k) AS k, string_agg(w, ' ' ORDER BY pos_no) AS t FROM cn GROUP BY ALL),
nx AS (SELECT doc_id, sent_no, c, k, t, lead(k, 1) OVER s AS k1, lead(t, 1) OVER s AS t1,
              lead(k, 2) OVER s AS k2, lead(t, 2) OVER s AS t2
       FROM cx WINDOW s AS (PARTITION BY doc_id, sent_no ORDER BY c)),
raw AS (SELECT doc_id, sent_no, c, t AS subject, t1 AS predicate, t2 AS object FROM nx
        WHERE k = 'N' AND k1 = 'V' AND k2 = 'N')"""
)

LEXICON = f"lexicon AS (SELECT DISTINCT unnest({TOK_OF.format('text')}) AS word FROM benchmark)"

GAZETTEER = (
    LEXICON
    + f""", gaz AS (SELECT word AS term, ([{quoted(MENTION_TYPES)}])[length(word) % 5 + 1] AS type
  FROM lexicon WHERE length(word) >= 5)"""
)
