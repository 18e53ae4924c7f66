"""Interval joins against all pairs."""

from __future__ import annotations

import random

import pytest
from conftest import rows

from textkg.operators.intervals import interval_join

LEFT = "doc string, start int, stop int, a int"
RIGHT = "doc string, r_start int, r_stop int, b int"


def side(rng, n):
    out = []
    for i in range(n):
        start = rng.randrange(0, 200)
        out.append((rng.choice(["x", "y"]), start, start + rng.choice([0, 1, 3, 10, 150]), i))
    return out + [("x", None, 5, n), ("x", 5, None, n + 1), (None, 1, 2, n + 2), ("y", -3, 4, n + 3), ("y", 9, 4, n + 4)]


def fits(r):
    return None not in r[:3] and 0 <= r[1] <= r[2]


@pytest.mark.parametrize("width", [1, 7, 64, 1000])
@pytest.mark.parametrize("test", ["overlap", "inside"])
def test_against_all_pairs(spark, width, test):
    rng = random.Random(width)
    left, right = side(rng, 80), side(rng, 60)
    tests = {
        "overlap": lambda x, y: x[1] < max(y[2], y[1] + 1) and y[1] < max(x[2], x[1] + 1),
        "inside": lambda x, y: y[1] <= x[1] and x[2] <= y[2],
    }
    want = sorted((x[3], y[3]) for x in left for y in right if fits(x) and fits(y) and x[0] == y[0] and tests[test](x, y))
    found = interval_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["doc"], test, width)
    assert rows(found.select("a", "b")) == want and len(want) > 50


def test_no_rows(spark):
    none = spark.createDataFrame([], LEFT)
    assert interval_join(none, spark.createDataFrame([("x", 0, 9, 1)], RIGHT), ["doc"]).count() == 0
