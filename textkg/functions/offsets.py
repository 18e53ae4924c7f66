"""Cleanup, sentences, lemmas and triples that know their places in the source text.

Cleanup here masks instead of deleting: a removed code point becomes `REMOVED` and a replaced match a blank followed by `REMOVED`, so
the masked text is as long as its source and a place in one is the same place in the other. The later patterns look through masked code
points; without them the masked text is exactly `clean_text` of the source. Every token, and every subject, predicate and object built
from tokens, carries the source range from its first to its last code point: `substring(text, start + 1, length)` is the mention.

All of it is expressions on the document's own row. Places are running sums of piece lengths, in time n times the square root of n at worst.
A noncharacter U+FFFF in a source counts as removed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textkg.functions.tagging import lemma, normalize_term, pos_tag
from textkg.functions.text import let

REMOVED = "\uffff"
_G = f"{REMOVED}*"

# The cleanup rules of `text.CLEANUP_RULES` in the same order, looking through masked code points.
MASK_RULES = (
    (r"\(.*?\)", ""),
    (r"/", " "),
    (r"[',%]", ""),
    (rf"\s{_G}[0-9](?:{_G}[0-9])*{_G}\s", " "),
    (rf"\s{_G}[0-9](?:{_G}[0-9])*{_G}[.](?:{_G}[0-9])+{_G}\s", " "),
)
SENTENCE_BREAK = rf"[.!?](?:{_G}[.!?])*{_G}\s(?:{_G}\s)*|\n(?:{_G}\n)*"
TOKEN = rf"[\p{{L}}\p{{N}}](?:{_G}[\p{{L}}\p{{N}}])*"
MARK = "."

_SUM_BLOCK = 256  # a power of two
_PLACED = "array<struct<text:string,start:int>>"
_LEMMAS = "array<struct<lemma:string,pos:string,start:int,length:int>>"
_TRIPLES = (
    "array<struct<subject:string,predicate:string,object:string,subject_start:int,subject_length:int,"
    "predicate_start:int,predicate_length:int,object_start:int,object_length:int>>"
)


def _pieces(text: Column, pattern: str) -> tuple[Column, Column]:
    """What lies between the matches of a pattern, and the matches; the first array is one longer."""
    return F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _blank(text: Column, pattern: str, replacement: str) -> Column:
    """Matches become the replacement and `REMOVED` up to their length."""
    between, matches = _pieces(text, pattern)
    fill = F.zip_with(
        between,
        matches,
        lambda p, m: F.concat(
            p, F.coalesce(F.concat(F.lit(replacement), F.repeat(F.lit(REMOVED), F.length(m) - len(replacement))), F.lit(""))
        ),
    )
    return F.array_join(fill, "")


def mask_clean(text: Column) -> Column:
    """The cleaned text in the length of its source."""
    for pattern, replacement in MASK_RULES:
        # each rule reads the text twice, so the rule before must not be evaluated twice for it
        text = _rule(text, pattern, replacement)
    return text


def _rule(text: Column, pattern: str, replacement: str) -> Column:
    def apply(t: Column) -> Column:
        return _blank(t, pattern, replacement)

    return let(text, apply)


def unmask(text: Column) -> Column:
    return F.replace(text, F.lit(REMOVED), F.lit(""))


def running_sums(numbers: Column) -> Column:
    """For every place of an array the sum of what comes before it."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def block(i: Column) -> Column:
        return F.call_function("shiftright", i, F.lit(_SUM_BLOCK.bit_length() - 1))

    def of(n: Column) -> Column:
        # sums before each block of _SUM_BLOCK numbers, then the rest inside the block
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor(F.size(n) / _SUM_BLOCK).cast("int")),
            lambda b: total(F.slice(n, b * _SUM_BLOCK + 1, F.lit(_SUM_BLOCK))),
        )
        return let(
            let(blocks, lambda s: F.transform(s, lambda x, b: total(F.slice(s, F.lit(1), b)))),
            lambda before: F.transform(
                n,
                lambda x, i: F.get(before, block(i)) + total(F.slice(n, block(i) * _SUM_BLOCK + 1, i % _SUM_BLOCK)),
            ),
        )

    return let(numbers, of)


def _lengths(between: Column, matches: Column) -> Column:
    return F.zip_with(between, matches, lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0)))


def located_sentences(masked: Column) -> Column:
    """array<struct<text,start>>: the non-blank sentences of a masked text and their places in it, counted from 0."""

    def of(t: Column) -> Column:
        between, matches = _pieces(t, SENTENCE_BREAK)
        placed = F.arrays_zip(between.alias("text"), running_sums(_lengths(between, matches)).alias("start"))
        return F.filter(placed, lambda s: F.trim(unmask(s["text"])) != "")

    return let(masked, of).cast(_PLACED)


def with_sources(text: Column, masked: Column) -> Column:
    """array<struct<text,start,source>>: `located_sentences` of a masked text, each with what stands there in its source.

    Places inside a sentence are then looked up in a short string; a look-up in the text would walk all that comes before it.
    """
    return F.transform(
        located_sentences(masked),
        lambda s: F.struct(
            s["text"].alias("text"), s["start"].alias("start"),
            F.substring(text, s["start"] + 1, F.length(s["text"])).alias("source"),
        ),
    )


def located_tokens(masked: Column, start: Column) -> Column:
    """array<struct<text,start>>: letter and digit runs of a masked sentence that stands at `start`, still masked."""

    def of(t: Column) -> Column:
        between, matches = _pieces(t, TOKEN)
        places = let(
            running_sums(_lengths(between, matches)),
            lambda before: F.zip_with(before, between, lambda b, p: b + F.length(p) + start),
        )
        # the last piece has no token behind it
        return F.filter(F.arrays_zip(matches.alias("text"), places.alias("start")), lambda s: s["text"].isNotNull())

    return let(masked, of).cast(_PLACED)


def located_lemmas(masked: Column, start: Column, mark: bool = True) -> Column:
    """array<struct<lemma,pos,start,length>> of a masked sentence.

    Lemmas of one letter are dropped. With `mark` the sentence ends with (".", "") of length 0 at its end.
    """

    # step by step, so that no word is folded and no lemma formed again for each of its uses
    def folded(token: Column) -> Column:
        return F.struct(
            F.lower(unmask(token["text"])).alias("word"), token["start"].alias("start"), F.length(token["text"]).alias("length")
        )

    def tagged(token: Column) -> Column:
        return F.struct(
            lemma(token["word"]).alias("lemma"), pos_tag(token["word"]).alias("pos"), token["start"].alias("start"), token["length"].alias("length")
        )

    def of(token: Column) -> Column:
        return F.struct(
            normalize_term(token["lemma"]).alias("lemma"), token["pos"].alias("pos"), token["start"].alias("start"), token["length"].alias("length")
        )

    words = F.transform(F.transform(located_tokens(masked, start), folded), tagged)
    found = F.filter(F.transform(words, of), lambda p: F.length(p["lemma"]) > 1)
    if not mark:
        return found.cast(_LEMMAS)
    end = F.struct(
        F.lit(MARK).alias("lemma"), F.lit("").alias("pos"), (start + F.length(masked)).alias("start"), F.lit(0).alias("length")
    )
    return F.concat(found.cast(_LEMMAS), F.array(end).cast(_LEMMAS))


def _chunks(lemmas: Column) -> Column:
    """Runs of noun-like, verb-like and other lemmas with the source range from the first to the last; function words are left out."""
    kind = lambda p: F.when(p == "nn", "N").when(p == "vb", "V").otherwise("X")

    def of(t: Column) -> Column:
        starts = F.filter(
            F.transform(t, lambda x, i: F.when((i == 0) | (kind(x["pos"]) != kind(F.get(t, i - 1)["pos"])), i)),
            lambda i: i.isNotNull(),
        )

        def chunk(begins: Column) -> Column:
            def one(at: Column, j: Column) -> Column:
                after = F.coalesce(F.get(begins, j + 1), F.size(t))
                first, last = F.get(t, at), F.get(t, after - 1)
                return F.struct(
                    kind(first["pos"]).alias("kind"),
                    F.array_join(F.slice(t["lemma"], at + 1, after - at), " ").alias("words"),
                    first["start"].alias("start"),
                    (last["start"] + last["length"] - first["start"]).alias("length"),
                )

            return F.transform(begins, one)

        return let(starts, chunk)

    return let(F.filter(lemmas, lambda p: ~p["pos"].isin("dt", "")), of)


def located_triples(lemmas: Column) -> Column:
    """Every noun run, verb run, noun run in a row as subject, predicate and object with their source ranges."""

    def of(c: Column) -> Column:
        def three(x: Column, i: Column) -> Column:
            parts = {"subject": x, "predicate": F.get(c, i + 1), "object": F.get(c, i + 2)}
            row = F.struct(
                *[p["words"].alias(n) for n, p in parts.items()],
                *[p[f].alias(f"{n}_{f}") for n, p in parts.items() for f in ("start", "length")],
            )
            kinds = [p["kind"] == k for p, k in zip(parts.values(), "NVN")]
            return F.when(kinds[0] & kinds[1] & kinds[2], row)

        return F.filter(F.transform(c, three), lambda t: t.isNotNull())

    return let(_chunks(lemmas), of).cast(_TRIPLES)
