"""Joins of intervals inside a document, as equi-joins on bins of positions.

An interval [start, stop) is dealt to every bin of `width` positions from start to stop. Two intervals that meet share at least one bin; a pair
is formed only in the first bin they share, so it comes once, and the exact test is made there. Rows whose bounds are null, negative or out of order meet nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_WIDTH = 512


def _binned(df: DataFrame, start: str, stop: str, width: int, prefix: str) -> DataFrame:
    first = F.expr(f"cast({start} AS bigint) div {width}")
    # the bin of `stop` itself counts too, for an empty interval that lies there
    last = F.expr(f"cast({stop} AS bigint) div {width}")
    return (
        df.where(F.col(start).isNotNull() & F.col(stop).isNotNull() & (F.col(start) >= 0) & (F.col(stop) >= F.col(start)))
        .withColumn(f"{prefix}first", first)
        .withColumn("__bin", F.explode(F.sequence(first, last)))
    )


def interval_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], test: str = "overlap", width: int = BIN_WIDTH,
    left_bounds: tuple[str, str] = ("start", "stop"), right_bounds: tuple[str, str] = ("r_start", "r_stop"),
) -> DataFrame:
    """Rows of both sides whose intervals meet, for equal `keys`; apart from the keys the two sides name their columns differently.

    `test` is `overlap` (they share a position; an empty interval counts as its start) or `inside` (the left one lies in the right one).
    """
    (a, b), (c, d) = left_bounds, right_bounds
    pairs = _binned(left, a, b, width, "__l").join(_binned(right, c, d, width, "__r"), [*keys, "__bin"])
    tests: dict[str, Column] = {
        "overlap": (F.col(a) < F.greatest(F.col(d), F.col(c) + 1)) & (F.col(c) < F.greatest(F.col(b), F.col(a) + 1)),
        "inside": (F.col(a) >= F.col(c)) & (F.col(b) <= F.col(d)),
    }
    once = F.col("__bin") == F.greatest("__lfirst", "__rfirst")
    return pairs.where(once & tests[test]).drop("__bin", "__lfirst", "__rfirst")
