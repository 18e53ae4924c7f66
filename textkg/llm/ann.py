"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing.

Vectors get one more component, sqrt(M^2 - |x|^2), where M is the largest norm; queries are scaled to norm M and get 0. The nearest
augmented vectors in Euclidean distance are then those of largest inner product. Each of `tables` tables cuts `functions` Gaussian projections
into cells of width `width` * M. A query visits its own bucket and those of perturbed cells, in order of the estimated success of the
perturbation (the squared distances to the cell borders that it crosses), and the candidates of all tables are ranked by their exact
inner product in double precision.

Every vector is indexed. Equal vectors are one entry that keeps its k + 1 smallest ids, which is all that a result can show. A bucket with
more than `bucket_rows` entries is dealt over several parts and its probes visit all of them. Buckets meet queries part by part in
matrix products; only the best of each query and part go on. Queries that found fewer than k candidates are run against all
parts of one table, which is exact.

Cases: vectors that are null, zero, of another length than the longest, or that hold null or non-finite components take no part. Rows
that repeat an id and its vector count once. Ties go to the smaller id. Empty tables give an empty result; fewer than k candidates are all
returned. Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkg.session import broadcast_if_small, cut_lineage

TABLES = 6
FUNCTIONS = 8
WIDTH = 2.5
PROBES = 64
BUCKET_ROWS = 1 << 15
PART_ROWS = 1 << 16
_SEED = 20240229


class Hashes:
    """The projections, the same on every machine."""

    def __init__(self, dim: int, norm: float, tables: int, functions: int, width: float):
        rng = np.random.default_rng(_SEED)
        self.norm, self.width = norm, width * norm
        self.a = rng.normal(size=(tables, dim + 1, functions))
        self.b = rng.uniform(0, self.width, size=(tables, functions))
        self.mix = rng.integers(1, 1 << 62, size=(tables, functions + 1)) | 1

    def cells(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell numbers of augmented vectors and the places inside the cells (0 to 1)."""
        y = (x @ self.a[table] + self.b[table]) / self.width
        cell = np.floor(y)
        return cell.astype(np.int64), y - cell

    def keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells * self.mix[table, :-1]).sum(axis=1) + self.mix[table, -1]

    def stored(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))
        return np.column_stack([x, rest])

    def asked(self, x: np.ndarray) -> np.ndarray:
        scaled = x * (self.norm / np.sqrt((x * x).sum(axis=1)))[:, None]
        return np.column_stack([scaled, np.zeros(len(x))])


def perturbations(place: np.ndarray, limit: int) -> list[list[tuple[int, int]]]:
    """Sets of (function, step) in order of estimated success; the first is empty."""
    steps = sorted([(p * p, i, -1) for i, p in enumerate(place)] + [((1 - p) ** 2, i, 1) for i, p in enumerate(place)])
    out, heap = [[]], [(steps[0][0], (0,))]
    while heap and len(out) < limit:
        score, chosen = heapq.heappop(heap)
        if len({steps[i][1] for i in chosen}) == len(chosen):
            out.append([(steps[i][1], steps[i][2]) for i in chosen])
        last, after = chosen[-1], chosen[-1] + 1
        if after < len(steps):
            heapq.heappush(heap, (score - steps[last][0] + steps[after][0], (*chosen[:-1], after)))
            heapq.heappush(heap, (score + steps[after][0], (*chosen, after)))
    return out


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def _best(index: pa.Table, probes: pa.Table, dim: int, k: int) -> pa.Table:
    """(qid, gid, score) of the k best of each query among the buckets it visits in this part."""
    empty = pa.table({"qid": pa.array([], pa.int64()), "gid": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not index.num_rows or not probes.num_rows:
        return empty
    order = np.argsort(index["bucket"].to_numpy(), kind="stable")
    bucket, gid, x = index["bucket"].to_numpy()[order], index["gid"].to_numpy()[order], _matrix(index["v"], dim)[order]
    q = _matrix(probes["v"], dim)
    lists = probes["buckets"].combine_chunks()
    visits = lists.flatten().to_numpy()
    who = np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy()))
    turn = np.argsort(visits, kind="stable")
    visits, who = visits[turn], who[turn]
    everywhere = np.flatnonzero(probes["all"].to_numpy(zero_copy_only=False))
    heads = np.flatnonzero(np.append(True, visits[1:] != visits[:-1])) if len(visits) else np.zeros(0, np.int64)
    low, high = (np.searchsorted(bucket, visits[heads], side=side) for side in ("left", "right"))
    todo = [(who[a:z], lo, hi) for a, z, lo, hi in zip(heads, np.append(heads[1:], len(visits)), low, high)]
    if len(everywhere):
        todo.append((everywhere, 0, len(x)))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for w, lo, hi in todo:
        for a in range(lo, hi, 4096):
            z = min(hi, a + 4096)
            for s in range(0, len(w), 1024):
                some = w[s : s + 1024]
                score = q[some] @ x[a:z].T
                if z - a > k:
                    cut = np.partition(score, z - a - k, axis=1)[:, z - a - k]
                    r, c = np.nonzero(score >= cut[:, None] - 1e-9)
                else:
                    r, c = np.nonzero(np.ones_like(score, bool))
                found.append((some[r], c + a))
    if not found:
        return empty
    qi, xi = (np.concatenate(c) for c in zip(*found))
    pair = np.unique(qi * np.int64(len(x)) + xi)
    qi, xi = pair // len(x), pair % len(x)
    score = np.concatenate([(q[qi[a : a + 65536]] * x[xi[a : a + 65536]]).sum(axis=1) for a in range(0, len(qi), 65536)])
    # the same vector comes from several tables
    order = np.lexsort((gid[xi], -score, qi))
    qi, g, score = qi[order], gid[xi][order], score[order]
    once = np.append(True, (qi[1:] != qi[:-1]) | (g[1:] != g[:-1]))
    qi, g, score = qi[once], g[once], score[once]
    first = np.searchsorted(qi, qi)
    keep = np.arange(len(qi)) - first < k
    return pa.table({"qid": probes["qid"].to_numpy()[qi[keep]], "gid": g[keep], "score": score[keep]})


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    tables: int = TABLES, functions: int = FUNCTIONS, width: float = WIDTH, probes: int = PROBES,
    bucket_rows: int = BUCKET_ROWS, part_rows: int = PART_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found of every row for which `is_query` (over `vec_id`) holds."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = cut_lineage(rows.filter(finite & (norm2 > 0)).dropDuplicates(["vec_id", "v"]))
    lengths = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = lengths["dim"] if lengths else 0
    rows = rows.filter(F.size("v") == dim)
    norm, n = rows.agg(F.sqrt(F.max(norm2)), F.count("*")).first()
    norm = norm or 1.0
    parts = max(tables, -(-n * tables // part_rows))
    h = Hashes(dim, norm, tables, functions, width)
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    entries = cut_lineage(
        rows.select("*", place.alias("n")).filter(F.col("n") <= k + 1).groupBy("v").agg(F.min("vec_id").alias("gid"), F.collect_list("vec_id").alias("ids"))
    )
    asked = rows.filter(is_query)
    distinct = cut_lineage(asked.groupBy("v").agg(F.min("vec_id").alias("qid")))

    def store(batches):
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            y = h.stored(x)
            for t in range(tables):
                key = h.keys(h.cells(y, t)[0], t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(x), pa.int32()), pa.array(key), batch.column(0), batch.column(1)], names=["tab", "bucket", "gid", "v"]
                )

    def visit(batches):
        for batch in batches:
            y = h.asked(_matrix(batch.column(1), dim))
            for t in range(tables):
                cells, place = h.cells(y, t)
                key, qid, bucket = h.keys(cells, t), [], []
                for i, q in enumerate(batch.column(0).to_pylist()):
                    for changed in perturbations(place[i], probes):
                        qid.append(q)
                        with np.errstate(over="ignore"):
                            bucket.append(key[i] + sum((np.int64(d) * h.mix[t, f] for f, d in changed), np.int64(0)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(qid), pa.int32()), pa.array(np.array(bucket, np.int64)), pa.array(qid, pa.int64())], names=["tab", "bucket", "qid"]
                )

    index = entries.select("gid", "v").mapInArrow(store, "tab int, bucket long, gid long, v array<double>")
    sizes = cut_lineage(index.groupBy("tab", "bucket").agg(F.ceil(F.count("*") / bucket_rows).cast("int").alias("salts")))
    hot = broadcast_if_small(sizes.filter("salts > 1"))
    part = F.pmod(F.xxhash64("tab", "bucket", F.col("salt").cast("int")), F.lit(parts)).cast("int").alias("part")
    salt = F.pmod(F.xxhash64("gid"), F.coalesce("salts", F.lit(1))).alias("salt")
    dealt = index.join(hot, ["tab", "bucket"], "left").select("*", salt).select(part, "tab", "bucket", "gid", "v")
    calls = distinct.select("qid", "v").mapInArrow(visit, "tab int, bucket long, qid long").join(sizes, ["tab", "bucket"])
    calls = calls.select("*", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")).select(part, "qid", "bucket")
    calls = calls.groupBy("part", "qid").agg(F.collect_list("bucket").alias("buckets"))  # at most tables * probes per salt
    calls = calls.join(distinct, "qid").select("part", "qid", "v", "buckets", F.lit(False).alias("all"))
    schema = "qid long, gid long, score double"

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return _best(left, right, dim, k + 1)

    def top(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "gid"))
        return found.dropDuplicates(["qid", "gid"]).select("*", rank.alias("r")).filter(F.col("r") <= k + 1).drop("r")

    found = cut_lineage(top(dealt.groupBy("part").cogroup(calls.groupBy("part")).applyInArrow(meet, schema)))
    want = min(k + 1, entries.count())
    short = cut_lineage(
        distinct.join(found.groupBy("qid").count().filter(F.col("count") >= want), "qid", "left_anti")
    )
    if short.head(1):
        everywhere = short.select(
            F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "qid", "v",
            F.array().cast("array<bigint>").alias("buckets"), F.lit(True).alias("all"),
        )
        whole = dealt.filter("tab = 0").groupBy("part").cogroup(everywhere.groupBy("part")).applyInArrow(meet, schema)
        found = top(found.unionByName(whole))
    answers = found.join(entries.select("gid", "ids"), "gid").select("qid", F.explode("ids").alias("vec_id"), "score")
    each = asked.select(F.col("vec_id").alias("query_id"), "v").join(distinct, "v").select("query_id", "qid").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    final = each.join(answers, "qid").filter(F.col("vec_id") != F.col("query_id")).select("query_id", rank.cast("int").alias("rank"), "vec_id", "score")
    return final.filter(F.col("rank") <= k)
