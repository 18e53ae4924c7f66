"""Exact nearest neighbours by cosine that leave out cells of vectors which can't hold one.

Candidates belong to the nearest of a bounded number of pivots, and each cell knows its radius. On unit vectors the distance follows from
the cosine, so by the triangle inequality no member of a cell is nearer to a query than its pivot's distance less the radius.

1. Each query meets blocks of the cells next to it that hold more than k vectors, which gives a lower bound on its k-th similarity.
2. It then meets only the cells that this bound doesn't rule out, block by block, in tasks of two bounded blocks, which hand on what reaches the bound.

Work falls with the structure in the vectors; without any, all cells are met, as `cosine_top_k` does. Cells are cut into blocks by hash, and
queries of a block into parts, so neither a large cell nor many queries of one make a large task.

Cases: null ids and vectors take no part. Vectors of zeros have no angle: they form a cell of their own that every query meets, and as
queries meet all cells. All vectors are of one length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkg.operators.nearest import BLOCK_ROWS, _block_top, _unit_rows
from textkg.session import broadcast_if_small, cut_lineage

PIVOTS = 256
ZEROS = -1  # the cell of vectors without an angle
# Similarities are rounded to six digits, so a tie may lie this far below the bound; above the error of distances too.
_SLACK = 2e-6


def _distances(vectors: pd.Series, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of unit vectors to all pivots, and which vectors are zero."""
    unit = _unit_rows(vectors)
    return np.sqrt(np.maximum(2 - 2 * unit @ pivots.T, 0)), ~unit.any(axis=1)


def _plain(df: DataFrame) -> DataFrame:
    """Single-precision vectors are written and shuffled as they are, and widened where they meet."""
    kind = df.schema["vector"].dataType.simpleString()
    vector = F.col("vector") if kind == "array<float>" else F.col("vector").cast("array<double>")
    return df.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).select("id", vector.alias("vector"))


class Cells:
    """Candidates in cells: (id, vector, cell, block), with the pivots, radii and numbers of blocks."""

    def __init__(self, candidates: DataFrame, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS):
        plain = _plain(candidates)
        self.id_type = plain.schema["id"].dataType.simpleString()
        self.block_rows = block_rows
        angled = plain.where(F.exists("vector", lambda x: x != 0))
        chosen = [r.vector for r in angled.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()]  # at most `pivots` rows
        self.pivots = _unit_rows(pd.Series(chosen)) if chosen else np.zeros((0, 0))
        own = self.pivots

        def place(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                if not len(own):
                    yield part.assign(cell=ZEROS, distance=0.0)
                    continue
                d, zero = _distances(part["vector"], own)
                nearest = d.argmin(axis=1)
                yield part.assign(cell=np.where(zero, ZEROS, nearest), distance=np.where(zero, 0.0, d[np.arange(len(d)), nearest]))

        kind = plain.schema["vector"].dataType.simpleString()
        placed = cut_lineage(plain.mapInPandas(place, f"id {self.id_type}, vector {kind}, cell int, distance double"))
        self.known = {r[0]: (r[1], r[2]) for r in placed.groupBy("cell").agg(F.count("*"), F.max("distance")).collect()}  # one row a cell
        n_cells = len(own)
        self.sizes = np.array([self.known.get(c, (0, 0.0))[0] for c in range(n_cells)], np.int64)
        self.radii = np.array([self.known.get(c, (0, 0.0))[1] for c in range(n_cells)])
        self.n_blocks = {c: -(-n // block_rows) for c, (n, _) in self.known.items()}
        blocks = F.create_map(*[F.lit(x) for c, b in sorted(self.n_blocks.items()) for x in (c, b)]) if self.n_blocks else None
        number = blocks[F.col("cell")] if blocks is not None else F.lit(1)
        self.rows = placed.select("id", "vector", "cell", F.pmod(F.xxhash64("id"), number).cast("int").alias("block"))

    def first_cells(self, distances: np.ndarray, zero: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query the nearest cells that together hold more than k vectors."""
        order = np.argsort(distances, axis=1, kind="stable")
        # one block of each cell is met
        met = -(-self.sizes // np.maximum(-(-self.sizes // self.block_rows), 1))
        enough = np.cumsum(met[order], axis=1) > 2 * k
        ends = np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, enough.shape[1])
        return [order[i, :e] for i, e in enumerate(ends)]

    def near_cells(self, distances: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Which cells may hold a vector of at least the bound's similarity; a missing bound rules out none."""
        reach = np.sqrt(np.maximum(2 - 2 * (np.where(np.isnan(bounds), -1.0, bounds) - _SLACK), 0)) + _SLACK
        return (distances - self.radii[None, :] <= reach[:, None]) & (self.sizes > 0)[None, :]


def _dealt(queries: DataFrame, cells: Cells, k: int, bounded: bool) -> DataFrame:
    """(id, vector, cell, block): a row for every block that a query meets; with `bounded` all its bound allows, and the bound."""
    pivots, n_blocks, pick = cells.pivots, cells.n_blocks, Cells.near_cells if bounded else Cells.first_cells
    shell = Cells.__new__(Cells)  # the figures alone, without tables, for the tasks
    shell.sizes, shell.radii, shell.block_rows = cells.sizes, cells.radii, cells.block_rows

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for at in range(0, len(whole), 256):
                part = whole.iloc[at : at + 256].reset_index(drop=True)
                d, zero = _distances(part["vector"], pivots) if len(pivots) else (np.zeros((len(part), 0)), np.ones(len(part), bool))
                if bounded:
                    chosen = [np.flatnonzero(x) for x in pick(shell, d, np.where(zero, np.nan, part["bound"].to_numpy(float)))]
                else:
                    chosen = pick(shell, d, zero, k) if len(pivots) else [np.zeros(0, int)] * len(part)
                who, cell, block = [], [], []
                for i, found in enumerate(chosen):
                    for c in [*found.tolist(), *([ZEROS] if ZEROS in n_blocks else [])]:
                        n = n_blocks.get(c, 0)
                        met = range(n) if bounded else range(i % n, i % n + 1) if n else ()
                        who += [i] * len(met)
                        cell += [c] * len(met)
                        block += met
                yield part[handed].iloc[who].assign(cell=cell, block=block)

    kind = queries.schema["vector"].dataType.simpleString()
    handed = ["id", "vector", "bound"] if bounded else ["id", "vector"]
    return queries.mapInPandas(run, f"id {cells.id_type}, vector {kind}, {'bound double, ' if bounded else ''}cell int, block int")


def _above_bound(k: int):
    """The k best of a block, without those that a query's bound rules out."""
    top = _block_top(k)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = top(left, right)
        if "bound" not in left:
            return found
        bound = found["id"].map(left.groupby("id")["bound"].min()).astype(float)
        return found[~(found["similarity"] < bound - _SLACK)]  # a query without a bound keeps all

    return run


def _met(dealt: DataFrame, cells: Cells, k: int) -> DataFrame:
    """(id, neighbour, similarity, rank) over the blocks that each query meets."""
    dealt = cut_lineage(dealt)
    units = dealt.groupBy("cell", "block").agg(F.ceil(F.count("*") / cells.block_rows).cast("int").alias("parts"))
    units = broadcast_if_small(cut_lineage(units))
    own = [c for c in dealt.columns if c not in ("cell", "block")]
    left = dealt.join(units, ["cell", "block"]).select(*own, "cell", "block", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"))
    right = cells.rows.join(units, ["cell", "block"]).select(
        "id", "vector", "cell", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    keys = ("cell", "block", "part")
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _above_bound(k), f"id {cells.id_type}, neighbour {cells.id_type}, similarity double"
    )
    order = Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def met_blocks(queries: DataFrame, cells: Cells, k: int) -> DataFrame:
    """(id, vector, bound, cell, block): the blocks that have to be met for exact results."""
    plain = _plain(queries)
    first = _met(_dealt(plain, cells, k, False), cells, k)
    bounds = first.where(F.col("rank") == k).select("id", F.col("similarity").alias("bound"))
    return _dealt(plain.join(bounds, "id", "left").select("id", "vector", "bound"), cells, k, True)


def pruned_top_k(queries: DataFrame, candidates: DataFrame, k: int, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, neighbour, similarity, rank) as `cosine_top_k` gives them: similarity to six digits, ties to the lower id."""
    cells = Cells(candidates, pivots, block_rows)
    return _met(met_blocks(queries, cells, k), cells, k)
