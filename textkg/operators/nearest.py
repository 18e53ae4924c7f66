"""Exact nearest neighbours by cosine, block against block.

Vectors are dealt into blocks of bounded size and every query block meets every candidate block once, in a task that
multiplies two matrices and keeps k rows per query. What is shuffled after that is k rows per query and block, never all
pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
# Numbers of the vectors in a block of a large table.
BLOCK_NUMBERS = 1 << 21


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    m = np.stack(vectors.to_numpy()).astype(np.float64, copy=False)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    norms[norms == 0] = 1.0
    return m / norms


# Above the error of single-precision products of unit vectors plus the rounding step.
_MARGIN = 2e-5
_CHUNK_ROWS = 512


# Columns that give a row its first bound.
_FIRST_COLUMNS = 4096


def _near_bound(rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the products that may be among the k best of their row.

    The k-th best of a few columns bounds a row from below, so most products are only compared with it; what is left is ranked.
    """
    some = rough[:, : max(_FIRST_COLUMNS, 8 * k)]
    if some.shape[1] <= k:
        return np.nonzero(np.isfinite(rough))
    kth = np.partition(some, some.shape[1] - k, axis=1)[:, -k]
    rows, cols = np.divmod(np.flatnonzero(rough >= (kth - _MARGIN)[:, None]), rough.shape[1])
    if some.shape[1] == rough.shape[1]:
        return rows, cols
    values = rough[rows, cols]
    order = np.lexsort((-values, rows))
    starts = np.searchsorted(rows, np.arange(len(rough)))
    last = np.minimum(starts + k - 1, np.append(starts[1:], len(rows)) - 1)  # a row has k at least, unless none of its products is a number
    kth = np.where(last >= starts, values[order[np.maximum(last, 0)]], np.nan) if len(rows) else np.full(len(rough), np.nan)
    kept = values >= kth[rows] - _MARGIN
    return rows[kept], cols[kept]


def _chunk_top(
    q: np.ndarray, c: np.ndarray, c_rough: np.ndarray, same: tuple[np.ndarray, np.ndarray], k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, similarity) of the k best columns per row; of equal values the lower columns. `same` has the pairs left out."""
    rough = q.astype(np.float32) @ c_rough.T
    rough[same] = -np.inf
    rows, cols = _near_bound(rough, k)
    finite = np.isfinite(rough[rows, cols])
    rows, cols = rows[finite], cols[finite]
    exact = np.empty(len(rows))
    for at in range(0, len(rows), 1 << 18):
        part = slice(at, at + (1 << 18))
        exact[part] = np.einsum("ij,ij->i", q[rows[part]], c[cols[part]])
    exact = np.round(exact, 6)
    order = np.lexsort((cols, -exact, rows))
    rows, cols, exact = rows[order], cols[order], exact[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    kept = place < k
    return rows[kept], cols[kept], exact[kept]


def _same_pairs(left: np.ndarray, right: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of equal ids; `order` sorts the right ones."""
    first, end = (np.searchsorted(right, left, side, sorter=order) for side in ("left", "right"))
    n = end - first
    if left.dtype.kind == "f":
        n[np.isnan(left)] = 0  # ids that are missing equal none
    rows = np.repeat(np.arange(len(left)), n)
    return rows, order[np.repeat(first, n) + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)]


def _comparable(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids as numbers that are equal where the ids are; strings are too slow to compare for every pair."""
    if left.dtype != object:
        return left, right
    codes = pd.factorize(np.concatenate([left, right]))[0].astype(np.int32)
    return codes[: len(left)], codes[len(left) :]


def _block_top(k: int):
    def top(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"id": left["id"].iloc[:0], "neighbour": right["id"].iloc[:0], "similarity": []})
        # sorted candidates make the lower column the lower id
        right = right.sort_values("id", kind="stable")
        q_ids, c_ids = left["id"].to_numpy(), right["id"].to_numpy()
        q_same, c_same = _comparable(q_ids, c_ids)
        q, c = _unit_rows(left["vector"]), _unit_rows(right["vector"])
        c_rough, order = c.astype(np.float32), np.argsort(c_same, kind="stable")
        found = []
        for at in range(0, len(q_ids), _CHUNK_ROWS):
            part = slice(at, at + _CHUNK_ROWS)
            rows, cols, sims = _chunk_top(q[part], c, c_rough, _same_pairs(q_same[part], c_same, order), k)
            found.append(pd.DataFrame({"id": q_ids[part][rows], "neighbour": c_ids[cols], "similarity": sims}))
        return pd.concat(found)

    return top


def _measure(vectors: DataFrame) -> tuple[int, int]:
    """(rows, numbers in the longest vector)."""
    rows, size = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    return rows, max(size or 1, 1)


def cosine_top_k(queries: DataFrame, candidates: DataFrame, k: int, block_rows: int | None = None) -> DataFrame:
    """(id, neighbour, similarity, rank) of the k most similar candidates of each query, itself left out.

    Both inputs have (id, vector ARRAY) with unique ids of one type. Similarity is rounded to six digits; ties go to the
    lower id.

    A row is sent to as many tasks as the other side has blocks, in its own precision. So blocks are as large as a task holds well, and only
    small tables are cut finer, down to BLOCK_ROWS, to give every core some.
    """
    spark = queries.sparkSession
    cores = spark.sparkContext.defaultParallelism
    (n_queries, q_size), (n_candidates, c_size) = _measure(queries), _measure(candidates)

    def blocks(n: int) -> int:
        if block_rows is not None:
            return max(1, math.ceil(n / block_rows))
        large = math.ceil(n * max(q_size, c_size) / BLOCK_NUMBERS)
        return max(1, large, min(math.ceil(n / BLOCK_ROWS), math.ceil(math.sqrt(8 * cores))))

    q_blocks, c_blocks = blocks(n_queries), blocks(n_candidates)
    # a fixed number of tasks, as their work is large for their bytes
    tasks = min(q_blocks * c_blocks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * cores))
    key = queries.schema["id"].dataType.simpleString()

    def side(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        dealt = df.select(
            F.col("id").alias("id"),
            F.col("vector").alias("vector"),
            F.pmod(F.xxhash64("id"), F.lit(n_own)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_other - 1).cast("bigint"))).alias(other),
        )
        return dealt.repartition(tasks, "qb", "cb")

    left = side(queries, "qb", q_blocks, "cb", c_blocks).groupBy("qb", "cb")
    right = side(candidates, "cb", c_blocks, "qb", q_blocks).groupBy("qb", "cb")
    best = left.cogroup(right).applyInPandas(_block_top(k), f"id {key}, neighbour {key}, similarity double")
    order = Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
