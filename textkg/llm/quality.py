"""Quality rules: a table of thresholds compiled into one projection.

`quality_measures` adds the measured columns and `apply_rules` turns a table of rules into boolean columns of the same
projection. Only DataFrame functions are used and nothing is shuffled: every figure comes from the document's own row.

Cases: a null or empty text has no words, all its counts are 0 and every ratio is 0, so it fails the base rule. Repeated rows are
judged one by one. Other columns are ignored. A ratio whose denominator is 0 is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkg.llm.common import BLANKS
from textkg.session import once

SYMBOLS = "#*$%&|<>"

# Function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that for with on as at by from this was are it or an be "
    "le la les de des du et en un une que qui dans pour sur par avec au est pas "
    "der die das und zu den von mit sich dem ein eine ist im für auf nicht als auch "
    "el los las y del una con para se no al lo su más"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes when low <= measure <= high; a missing bound doesn't bind."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("long_enough", "n_words", low=50),
    Rule("word_length", "mean_word_chars", low=2.0, high=20.0),
    Rule("few_symbols", "symbol_ratio", high=0.20),
    Rule("few_exclamations", "exclamation_ratio", high=0.50),
    Rule("has_stop_words", "stop_word_ratio", low=0.02),
    Rule("few_copied_lines", "dup_line_ratio", high=0.50),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def quality_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, the counts and the ratios that rules refer to."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col), text.alias("__t"))
    base = once(base, "__w", F.array_remove(F.split("__t", BLANKS), ""))
    n = F.size("__w")
    # 3-word windows with their place, in word order: equal windows become neighbours
    windows = F.when(
        n >= 3,
        F.sort_array(
            F.arrays_zip(
                F.slice("__w", F.lit(1), n - 2).alias("a"), F.slice("__w", F.lit(2), n - 2).alias("b"),
                F.slice("__w", F.lit(3), n - 2).alias("c"), F.sequence(F.lit(1), n - 2).alias("p"),
            )
        ),
    )
    base = once(base, "__s", windows)
    m = F.size("__s")
    pairs = F.arrays_zip(F.slice("__s", F.lit(1), m - 1).alias("x"), F.slice("__s", F.lit(2), m - 1).alias("y"))
    same = F.filter(
        pairs, lambda z: (z["x"]["a"] == z["y"]["a"]) & (z["x"]["b"] == z["y"]["b"]) & (z["x"]["c"] == z["y"]["c"])
    )
    covered = F.flatten(F.transform(same, lambda z: F.array(*[z[s]["p"] + k for s in "xy" for k in range(3)])))
    repeated = F.when(m >= 2, F.size(F.array_distinct(covered))).otherwise(0)
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = base.select(id_col, "__t", "__w", F.explode(F.array(F.coalesce(repeated, F.lit(0)))).alias("__r"))
    base = once(base, "__l", lines)
    stop = [F.lit(w) for w in STOP_WORDS]
    counts = base.select(
        F.col(id_col),
        n.cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("__t", BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint").alias("n_dup_lines"),
        F.col("__r").cast("bigint").alias("n_repeat_words"),
        F.size("__l").cast("bigint").alias("n_lines"),
        (F.length("__t") - F.length(F.translate("__t", "!", ""))).cast("bigint").alias("n_exclamations"),
        F.size(F.filter("__w", lambda x: F.lower(x).isin(stop))).cast("bigint").alias("n_stop_words"),
    )
    return counts.select(
        "*",
        _ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), F.col("n_words")).alias("symbol_ratio"),
        _ratio(F.col("n_exclamations"), F.col("n_words")).alias("exclamation_ratio"),
        _ratio(F.col("n_stop_words"), F.col("n_words")).alias("stop_word_ratio"),
        _ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
    )


def compile_rules(rules: tuple[Rule, ...]) -> list[Column]:
    """One boolean column `pass_<rule>` per row of the threshold table."""
    out = []
    for rule in rules:
        test = F.lit(True)
        if rule.low is not None:
            test = test & (F.col(rule.measure) >= F.lit(rule.low))
        if rule.high is not None:
            test = test & (F.col(rule.measure) <= F.lit(rule.high))
        out.append(test.alias(f"pass_{rule.name}"))
    return out


def apply_rules(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Measures, a column per rule, `base_failed` and `kept`: the base rule holds and so does every row of the table."""
    measured = quality_measures(docs, id_col, text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept = ~F.col("base_failed")
    for rule in rules:
        kept = kept & F.col(f"pass_{rule.name}")
    return measured.select("*", failed.alias("base_failed"), *compile_rules(rules)).withColumn("kept", kept)


def _sql_rule(rule: Rule) -> str:
    parts = [f"{rule.measure} >= {rule.low}"] * (rule.low is not None) + [f"{rule.measure} <= {rule.high}"] * (rule.high is not None)
    return " AND ".join(parts)


def rules_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for the contract columns of `apply_rules` over `documents`."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
p AS (SELECT rid, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d WHERE len(w) >= 3),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM p),
r AS (SELECT rid, count(DISTINCT i + k) AS n FROM g, (SELECT unnest([0, 1, 2]) AS k) WHERE c >= 2 GROUP BY rid),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
lc AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
       FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
u AS (SELECT rid, unnest(w) AS word FROM d),
s AS (SELECT rid, count(*) AS n FROM u WHERE lower(word) IN ({stop}) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lc.n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(lc.n_lines, 0) AS n_lines, length(t) - length(replace(t, '!', '')) AS n_exclamations,
         coalesce(s.n, 0) AS n_stop_words
  FROM d LEFT JOIN r USING (rid) LEFT JOIN lc USING (rid) LEFT JOIN s USING (rid)),
q AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
         CASE WHEN n_words > 0 THEN n_exclamations / n_words ELSE 0 END AS exclamation_ratio,
         CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_word_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(_sql_rule(r) for r in rules)} AS kept
FROM q"""
