"""Nearest neighbours with pruned cells, against all cosines."""

from __future__ import annotations

import numpy as np
import pandas as pd
from conftest import rows
from pyspark.sql import functions as F

from textkg.operators.pivots import Cells, _above_bound, met_blocks, pruned_top_k

SCHEMA = "id long, vector array<double>"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if x is None else [float(y) for y in x]) for i, x in enumerate(vectors)], SCHEMA)


def brute(vectors, k):
    known = [(i, np.array(x, float)) for i, x in enumerate(vectors) if x is not None]
    unit = {i: x / (np.linalg.norm(x) or 1.0) for i, x in known}
    out = []
    for i in unit:
        near = sorted((-round(float(unit[i] @ unit[j]), 6), j) for j in unit if j != i)[:k]
        out += [(i, j, -s + 0.0, rank) for rank, (s, j) in enumerate(near, 1)]
    return out


def same(got, want):
    assert [(a, b, r) for a, b, _, r in got] == [(a, b, r) for a, b, _, r in want]
    assert np.allclose([s for _, _, s, _ in got], [s for _, _, s, _ in want], atol=2e-6)


def test_ties_zeros_nulls_and_small_cells(spark):
    rng = np.random.default_rng(3)
    vectors = [*rng.normal(size=(50, 6)).round(1), *np.eye(6), *np.eye(6), np.zeros(6), np.zeros(6), None]
    df = frame(spark, vectors)
    got = rows(pruned_top_k(df, df, 3, pivots=9, block_rows=8).select("id", "neighbour", "similarity", "rank"))
    same(sorted(got, key=lambda r: (r[0], r[3])), sorted(brute(vectors, 3), key=lambda r: (r[0], r[3])))


def test_clusters_are_pruned_and_exact(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    vectors = list(np.repeat(centres, 40, axis=0) + rng.normal(size=(480, 16)) * 0.05)
    df = frame(spark, vectors)
    cells = Cells(df, pivots=24, block_rows=16)
    sizes = cells.rows.groupBy("cell", "block").count()
    products = met_blocks(df, cells, 4).join(sizes, ["cell", "block"]).agg({"count": "sum"}).first()[0]
    assert products < 0.3 * 480 * 480
    got = rows(pruned_top_k(df, df, 4, pivots=24, block_rows=16).select("id", "neighbour", "similarity", "rank"))
    same(sorted(got, key=lambda r: (r[0], r[3])), sorted(brute(vectors, 4), key=lambda r: (r[0], r[3])))


def test_empty_and_single(spark):
    empty = frame(spark, [])
    assert rows(pruned_top_k(empty, empty, 2)) == []
    one = frame(spark, [[1, 2]])
    assert rows(pruned_top_k(one, one, 2)) == []
    assert rows(pruned_top_k(one, empty, 2)) == []


def test_single_precision_vectors_stay_so_until_they_meet(spark):
    rng = np.random.default_rng(5)
    vectors = [x.astype(np.float32) for x in rng.normal(size=(60, 8))]
    df = frame(spark, vectors).select("id", F.col("vector").cast("array<float>").alias("vector"))
    cells = Cells(df, pivots=7, block_rows=8)
    assert cells.rows.schema["vector"].dataType.simpleString() == "array<float>"
    assert met_blocks(df, cells, 3).schema["vector"].dataType.simpleString() == "array<float>"
    for queries in (df, frame(spark, vectors)):
        got = rows(pruned_top_k(queries, df, 3, pivots=7, block_rows=8).select("id", "neighbour", "similarity", "rank"))
        same(sorted(got, key=lambda r: (r[0], r[3])), sorted(brute(vectors, 3), key=lambda r: (r[0], r[3])))


def test_blocks_hand_on_only_what_reaches_the_bound(spark):
    left = pd.DataFrame({"id": [1, 2, 3], "vector": [[1.0, 0.0]] * 3, "bound": [0.9, -1.0, None]})
    right = pd.DataFrame({"id": [7, 8, 9], "vector": [[1.0, 0.0], [9.0, 4.3588989], [0.0, 1.0]]})
    found = _above_bound(2)(left, right)
    assert list(zip(found["id"], found["neighbour"])) == [(1, 7), (1, 8), (2, 7), (2, 8), (3, 7), (3, 8)]
    found = _above_bound(2)(left.assign(bound=[0.9001, 0.95, 1.0]), right)
    assert list(zip(found["id"], found["neighbour"])) == [(1, 7), (2, 7), (3, 7)]
