"""Substring matching between two tables as an equi-join.

`text contains term` has no join key of its own. Every term gets one: the hash of its prefix of the largest power-of-two
length that fits, at least half of the term. Every text gets the hashes of its pieces of those lengths, about
length * log2(length) rows. The join on the hash then meets every pair that can match, and the test that the term first
occurs at the piece's place removes the rest and all repeats, so the result is exact and no text is paired with terms it
shares nothing with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkg.session import BROADCAST_BYTES, deal, row_bytes


def _top_power(length: Column) -> Column:
    """The exponent of the largest power of two not above a length."""
    return F.floor(F.log2(length.cast("double")) + 1e-9).cast("int")


def _size(power: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), power)


# Words of 64 bits that mark keys in use; as a table they take BROADCAST_BYTES at most.
MARK_WORDS = 1 << 20


def _with_marked_keys(pieces: DataFrame, keyed: DataFrame) -> DataFrame:
    """The pieces whose key may be one of `keyed`, so that most others are not shuffled.

    One bit per key, in a table that is bounded however many keys there are; a bit that several keys share lets a few pieces more through.
    """
    word = F.pmod(F.call_function("shiftright", F.col("__key"), F.lit(6)), F.lit(MARK_WORDS)).alias("__word")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__key").bitwiseAND(63).cast("int"))
    marks = keyed.select(word, bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    met = pieces.withColumn("__word", word).join(F.broadcast(marks), "__word")
    return met.where(F.col("__bits").bitwiseAND(bit) != 0).drop("__word", "__bits")


def substring_pairs(
    texts: DataFrame, text: str, terms: DataFrame, term: str, min_length: int = 1
) -> DataFrame:
    """Every row of `texts` joined with every row of `terms` whose term its text contains, each pair once.

    Terms shorter than `min_length` match nothing. Compare is exact; fold case before. Keep `texts` distinct, as equal
    texts are cut into pieces once each.

    One aggregate over the terms finds the prefix lengths in use and whether they are small enough to broadcast, so pass
    terms that are cheap to compute or materialized.
    """
    usable = terms.where(F.length(term) >= min_length)
    shortest, longest, size = usable.agg(
        F.min(F.length(term)), F.max(F.length(term)), F.sum(row_bytes(usable))
    ).first()
    lowest, highest = ((shortest or 1).bit_length() - 1, (longest or 1).bit_length() - 1)
    keyed = usable.withColumn("__key", F.xxhash64(F.left(term, _size(_top_power(F.length(term))))))
    small = (size or 0) <= BROADCAST_BYTES
    if small:
        keyed = F.broadcast(keyed)
    length = F.length(text)
    places = deal(texts.where(length >= 1 << lowest)).select(
        "*", F.explode(F.sequence(F.lit(1), length - ((1 << lowest) - 1))).alias("__at")
    )
    powers = F.sequence(F.lit(lowest), F.least(F.lit(highest), _top_power(length - F.col("__at") + 1)))
    pieces = places.select("*", F.explode(powers).alias("__power")).withColumn(
        "__key", F.xxhash64(F.substr(text, F.col("__at"), _size(F.col("__power"))))
    )
    if not small:
        pieces = _with_marked_keys(pieces, keyed)
    return (
        pieces.join(keyed, "__key")
        .where(F.call_function("instr", F.col(text), F.col(term)) == F.col("__at"))
        .drop("__key", "__at", "__power")
    )


def first_match(
    texts: DataFrame,
    text: str,
    terms: DataFrame,
    term: str,
    value: str,
    order: list[Column],
    min_length: int = 1,
) -> DataFrame:
    """(text, value): for each matched text the value of the term lowest in `order`; unmatched texts are absent."""
    return (
        substring_pairs(texts, text, terms, term, min_length)
        .groupBy(text)
        .agg(F.min_by(value, F.struct(*order)).alias(value))
    )
