"""Nearest neighbours in blocks: large tables are cut by the size of their vectors, and ids of any kind leave themselves out."""

import numpy as np
import pytest

from textkg.operators import nearest


@pytest.mark.parametrize("numbers", [200, 1 << 21])
def test_blocks_by_size_of_vectors(spark, monkeypatch, numbers):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 8)).astype(np.float32)
    df = spark.createDataFrame([(f"w{i:02}", [float(a) for a in r]) for i, r in enumerate(x)], "id string, vector array<float>")
    monkeypatch.setattr(nearest, "BLOCK_NUMBERS", numbers)
    got = nearest.cosine_top_k(df, df, 3)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 6)
    np.fill_diagonal(sims, -2)
    want = {(f"w{i:02}", f"w{j:02}") for i in range(60) for j in np.lexsort((np.arange(60), -sims[i]))[:3]}
    assert {(r.id, r.neighbour) for r in got.collect()} == want


def test_ids_are_compared_as_numbers():
    left, right = np.array(["b", None, "a"], dtype=object), np.array(["a", "b", None], dtype=object)
    q, c = nearest._comparable(left, right)
    assert q.dtype == np.int32
    assert (q[:, None] == c[None, :]).tolist() == (left[:, None] == right[None, :]).tolist()


@pytest.mark.parametrize("k", [1, 5, 40])
def test_most_products_are_only_compared_with_a_bound(monkeypatch, k):
    monkeypatch.setattr(nearest, "_FIRST_COLUMNS", 30)
    rng = np.random.default_rng(7)
    rough = np.round(rng.normal(size=(50, 400)), 2).astype(np.float32)  # with ties
    rough[3] = -np.inf
    rough[4, 10:] = -np.inf
    rows, cols = nearest._near_bound(rough, k)
    found = set(zip(rows.tolist(), cols.tolist()))
    kth = np.sort(rough, axis=1)[:, -k]
    want = {(i, int(j)) for i in range(50) for j in np.flatnonzero(np.isfinite(rough[i]) & (rough[i] >= kth[i] - 1e-6))}
    assert {x for x in found if np.isfinite(rough[x])} == want  # all that may be among the k best, and no more


def test_ranking_is_left_to_few_products(monkeypatch):
    ranked, partition = [], np.partition
    monkeypatch.setattr(nearest.np, "partition", lambda a, *b, **c: ranked.append(a.size) or partition(a, *b, **c))
    rough = np.random.default_rng(8).normal(size=(4, 50_000)).astype(np.float32)
    rows, _ = nearest._near_bound(rough, 5)
    assert len(rows) == 20 and sum(ranked) <= rough.size // 10


def test_repeated_ids_are_left_out_with_their_like():
    left, right = np.array([5, 2, 9]), np.array([2, 5, 5, 7])
    rows, cols = nearest._same_pairs(left, right, np.argsort(right, kind="stable"))
    assert sorted(zip(rows.tolist(), cols.tolist())) == [(0, 1), (0, 2), (1, 0)]
