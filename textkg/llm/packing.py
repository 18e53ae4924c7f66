"""Packing of documents into windows of token ids by minimum bin slack.

1. Every text is encoded and closed with an end id; a document longer than the window is cut into full windows and a rest.
   Pieces are written to the shared folder with their place among the pieces of the same length in their partition.
2. The histogram of piece lengths (at most one row per length up to the window) is all the driver sees. Minimum bin slack
   plans on it: the longest length left opens a window, a bitset holds the sums that the remaining multiset can reach, the sum
   closest to the capacity is taken, and backtracking through the bitsets gives how often each length is used. A pattern is applied
   as often as the counts allow, so the plan is bounded by the number of lengths, not by the number of documents.
3. A piece's rank among all pieces of its length (offset of its partition + place in it) selects its slot in the plan.

A sum at a power of two needs no padding, so it is preferred where the full window can't be reached.

Cases: a null or empty text is a document of the end id alone. Repeated rows are packed each. An empty table gives no pieces.
Ties between equal lengths go by partition and place. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkg.llm.bpe import encoder
from textkg.session import cut_lineage


def fill_window(counts: dict[int, int], window: int) -> dict[int, int]:
    """The multiset of lengths, as length -> times, with the longest length left that leaves the least slack.

    The sums reachable so far are the bits of an integer. An item used up to k times is folded in as blocks of 1, 2, 4, ... copies;
    the bitset before each block is kept for the way back.
    """
    lengths = sorted((n for n, c in counts.items() if c), reverse=True)
    first = lengths[0]
    room = window - first
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for n in lengths:
        if n > room:
            continue
        left, block = min(counts[n] - (n == first), room // n), 1
        while left > 0 and not reach >> room & 1:
            take = min(block, left)
            steps.append((reach, n, take))
            reach |= (reach << (take * n)) & full
            left, block = left - take, block * 2
        if reach >> room & 1:
            break
    target = reach.bit_length() - 1
    if target < room:
        even = [p - first for p in (1 << k for k in range(window.bit_length())) if first <= p < window and reach >> (p - first) & 1]
        target = max(even, default=target)
    used = {first: 1}
    for before, n, take in reversed(steps):
        if not before >> target & 1:
            used[n] = used.get(n, 0) + take
            target -= take * n
    return used


def plan_windows(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Plan rows (length, first rank, ranks, times per window, first sequence, offset), ordered by length and rank."""
    counts = {n: c for n, c in histogram.items() if c}
    used_up = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    while counts:
        pattern = fill_window(counts, window)
        times = min(counts[n] // k for n, k in pattern.items())
        offset = 0
        for n in sorted(pattern, reverse=True):
            k = pattern[n]
            rows.append((n, used_up[n], times * k, k, sequence, offset))
            offset += n * k
            used_up[n] += times * k
            counts[n] -= times * k
            if not counts[n]:
                del counts[n]
        sequence += times
    return sorted(rows)


def encoded_pieces(
    docs: DataFrame, vocabulary: str, window: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: the document, start, length, checksum, its partition and its place among equal lengths there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(vocabulary), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            row, start, length, crc, total, place = ([] for _ in range(6))
            for i, ids in enumerate(coder.encode(texts)):
                raw = np.append(ids, end_id).astype("<u4").tobytes()
                n = len(raw) // 4
                for a in range(0, n, window):
                    size = min(window, n - a)
                    row.append(i)
                    start.append(a)
                    length.append(size)
                    crc.append(zlib.crc32(raw[4 * a : 4 * (a + size)]))
                    total.append(n)
                    place.append(seen.get(size, 0))
                    seen[size] = place[-1] + 1
            longs = [pa.array(c, pa.int64()) for c in (start, length, crc, total, [part] * len(row), place)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *longs],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "place"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, part long, place long"
    )


def pack_documents(
    docs: DataFrame, vocabulary: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces with their sequence and their offset in it."""
    pieces = cut_lineage(encoded_pieces(docs, vocabulary, window, end_id, id_col, text_col))
    per_part = pieces.groupBy("length", "part").count()
    histogram = dict(per_part.groupBy("length").agg(F.sum("count")).collect())  # at most `window` rows
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    plan = np.array(plan_windows(histogram, window), np.int64).reshape(-1, 6)
    # one sorted key for look-ups: the rank within a length, shifted by the length
    shift = np.int64(1) << np.int64(46)
    keys = plan[:, 0] * shift + plan[:, 1]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            row = plan[np.searchsorted(keys, length * shift + rank, side="right") - 1]
            nth = rank - row[:, 1]
            columns = [batch.column(i) for i in range(5)]
            columns += [pa.array(row[:, 4] + nth // row[:, 3]), pa.array(row[:, 5] + nth % row[:, 3] * length)]
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            )

    ranked = pieces.join(bases, ["length", "part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("place") + F.col("base")).alias("rank")
    )
    id_type = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(
        place,
        f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )


def packed_ids(
    docs: DataFrame, pieces: DataFrame, vocabulary: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(sequence_id, ids): the windows themselves, unpadded. Document ids must be unique here."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            rows = list(coder.encode([t or "" for t in batch.column(1).to_pylist()]))
            ids = pa.array([np.append(r, end_id) for r in rows], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    id_type = docs.schema[id_col].dataType.simpleString()
    coded = docs.select(id_col, text_col).mapInArrow(run, f"doc_id {id_type}, ids array<long>")
    cut = coded.join(pieces, "doc_id").select(
        "sequence_id", F.struct("offset", F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("ids")).alias("p")
    )
    # a sequence holds at most one window of ids
    whole = cut.groupBy("sequence_id").agg(F.sort_array(F.collect_list("p")).alias("p"))
    return whole.select("sequence_id", F.flatten("p.ids").alias("ids"))
