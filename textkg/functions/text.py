"""Column builders for text: cleanup, sentences, tokens, n-grams, phrases, identifiers.

Everything here is a JVM-side expression on one row; nothing shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_BREAK = r"[^\p{L}\p{N}]+"
SENTENCE_BREAK = r"[.!?]+\s+|\n+"

# The cleanup rules for abstracts, applied in this order (pattern, replacement).
CLEANUP_RULES = (
    (r"\(.*?\)", ""),
    (r"/", " "),
    (r"[',%]", ""),
    (r"\s[0-9]+\s", " "),
    (r"\s[0-9]+[.][0-9]+\s", " "),
)

# A short default; callers pass their own list for anything else.
STOPWORDS = (
    "a an the and or but not no nor of in on at by for with from to as is are was were be been being it its this that"
    " these those he she they them his her their we our you your i me my do does did have has had will would can could"
    " may might shall should there here then than so such if into over under between about after before during which"
    " who whom what when where why how all any both each few more most other some only own same too very"
).split()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` once for `body`; without it each use inside a lambda would evaluate the expression again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def clean_text(text: Column) -> Column:
    for pattern, replacement in CLEANUP_RULES:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def tokens(text: Column) -> Column:
    """Lower-case letter and digit runs, in order."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda w: w != "")


def space_tokens(text: Column) -> Column:
    """Split at single blanks; trailing blanks give no empty pieces."""
    return F.split(F.rtrim(text), " ")


def sentences(text: Column) -> Column:
    """Non-blank sentences: split after end punctuation and at line breaks."""
    return F.filter(F.split(text, SENTENCE_BREAK), lambda s: F.trim(s) != "")


def drop_words(words: Column, stop: Sequence[str] = STOPWORDS) -> Column:
    """Remove listed words from an array, keeping order and duplicates."""
    return F.filter(words, lambda w: ~w.isin(*stop))


def ngrams(words: Column, n: int, strict: bool = False) -> Column:
    """All windows of exactly `n` words joined by a blank.

    A text shorter than `n` yields itself as one short gram, and an empty one yields none; `strict` yields none for both.
    """
    floor = n if strict else 1
    return let(
        words,
        lambda w: F.when(
            F.size(w) >= floor,
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))),
                lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def ngrams_up_to(words: Column, n: int) -> Column:
    """The windows of sizes 1..n, size after size."""
    return let(words, lambda w: F.concat(*[ngrams(w, size) for size in range(1, n + 1)]))


def counted(items: Column) -> Column:
    """array<struct<item,n>> of an array: run lengths of the sorted array, inside the row."""
    return let(
        F.sort_array(items),
        lambda s: let(
            F.filter(
                F.transform(s, lambda x, i: F.when((i == 0) | (x != F.get(s, i - 1)), i)), lambda i: i.isNotNull()
            ),
            lambda starts: F.transform(
                starts,
                lambda at, j: F.struct(
                    F.get(s, at).alias("item"),
                    (F.coalesce(F.get(starts, j + 1), F.size(s)) - at).alias("n"),
                ),
            ),
        ),
    )


def phrase_without(phrase: Column, stop: Sequence[str] = STOPWORDS) -> Column:
    """Remove listed words from a phrase, but only when it has more than one word."""
    kept = F.array_join(F.filter(F.split(phrase, " "), lambda w: ~w.isin(*stop)), " ")
    return F.when(F.contains(phrase, F.lit(" ")), kept).otherwise(phrase)


def capitalize(word: Column) -> Column:
    """Upper-case the first letter and leave the rest; a letter whose upper case is two letters stays."""
    first = F.left(word, F.lit(1))
    big = F.when(F.length(F.upper(first)) == 1, F.upper(first)).otherwise(first)
    return F.concat(big, F.substring(word, 2, 1 << 30))


def to_camel_case(phrase: Column) -> Column:
    """`risk of disease` to `risk_Of_Disease`: words after the first longer than one letter are capitalized; dots go."""
    words = F.transform(
        F.split(phrase, " "),
        lambda w, i: F.when((i > 0) & (F.length(w) > 1), capitalize(w)).otherwise(w),
    )
    joined = F.replace(F.array_join(words, "_"), F.lit("."), F.lit(""))
    return F.when(F.contains(phrase, F.lit(" ")), joined).otherwise(phrase)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def squeeze(text: Column, newline: str = " ") -> Column:
    """Newlines become `newline`, runs of tabs one blank, ends trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\r?\n", newline), r"\t+", " "))


def local_part(identifier: Column, separator: str) -> tuple[Column, Column, Column]:
    """(applies, prefix, id) of an identifier cut at the first separator."""
    at = F.instr(identifier, separator)
    return (
        at > 0,
        F.substr(identifier, F.lit(1), at - 1),
        F.substr(identifier, at + len(separator)),
    )
