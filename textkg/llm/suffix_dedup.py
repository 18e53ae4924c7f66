"""Exact substring deduplication by a hash-compared suffix sort.

Every byte covered by a string of `length` bytes that also starts anywhere else is removed.

1. Anchors. In each window of `length` bytes the 32-byte string of smallest hash is an anchor (leftmost on ties), so equal windows have
   equal anchors at the same place. Polynomial prefix hashes give all string hashes of a chunk at once; about one position in
   85 is an anchor. An anchor's context is what a window around it can reach: up to 168 bytes before it, 200 from it on.
2. Anchors whose string occurs once are dropped: one pass over the texts counts the strings, a second one keeps the anchors of the others. Equal contexts are counted with map-side combination, so a
   large group of copies costs one row per task; a context that occurs twice is covered whole.
3. Where one anchor string has several contexts, their suffixes are sorted, once to the right and once (reversed) to the left: a
   mergesort whose comparisons find the common extension by binary search over prefix hashes and then look at one byte. Claimed
   extensions of neighbours are verified byte by byte; after a collision the part is sorted by bytes.
   Cutting the sorted orders where the extension is below r gives the classes of equal r bytes. The window that starts o bytes before the
   anchor is repeated if another context is in the same left class of o and right class of `length` - o bytes.
   Anchor strings with more than `group_rows` contexts take another exact way: hashes of their windows are counted by Spark.
4. Covered ranges go back to their documents and are merged there.

Matches never cross documents. Cases: a null or empty text has no bytes and no spans; texts shorter than `length` keep everything;
repeated rows match each other and lose everything that is long enough. Rows are told apart by id and text, so equal ids
do no harm. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkg.llm.common import byte_slices
from textkg.session import cut_lineage, release

LENGTH = 200
GRAM = 32
GROUP_ROWS = 1 << 15
PART_ROWS = 1 << 13
BROADCAST_BYTES = 48 << 20
_CHUNK = 1 << 19
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_MASK = (1 << 64) - 1


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class PrefixHashes:
    """Polynomial hashes of all substrings of a byte array."""

    def __init__(self, x: np.ndarray, base: int):
        power, self.inverse = (p[: len(x) + 1] for p in _powers(base, max(_CHUNK * 2, 1 << (len(x) + 1).bit_length())))
        self.sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum((x.astype(np.uint64) + np.uint64(1)) * power[: len(x)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def find_anchors(raw: bytes, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Anchors of the documents at raw[bounds[i] : bounds[i + 1]]: document, place, hashes of string and context."""
    x = np.frombuffer(raw, np.uint8)
    names = ("doc", "pos", "h", "c1", "c2", "nl", "nr")
    if len(x) < length:
        return {n: np.zeros(0, np.int64) for n in names}
    first, second = (PrefixHashes(x, b) for b in _BASES)
    n = len(x) - gram + 1
    at = np.arange(n)
    h = _mix((first.sums[gram:] - first.sums[:n]) * first.inverse[:n])
    key = (h & np.uint64(_MASK - (1 << 24) + 1)) | at.astype(np.uint64)
    width = length - gram + 1
    low, size = key, 1
    while size * 2 <= width:
        low, size = np.minimum(low[: len(low) - size], low[size:]), size * 2
    if size < width:
        low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    # windows inside one document
    doc_sizes = np.diff(bounds)
    starts = np.repeat(bounds[:-1], np.maximum(doc_sizes - length + 1, 0))
    counts = np.maximum(doc_sizes - length + 1, 0)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + starts
    chosen = (low[inside] & np.uint64((1 << 24) - 1)).astype(np.int64)
    pos = np.unique(chosen[np.append(True, chosen[1:] != chosen[:-1])]) if len(chosen) else chosen
    doc = np.searchsorted(bounds, pos, side="right") - 1
    nl, nr = np.minimum(pos - bounds[doc], length - gram), np.minimum(bounds[doc + 1] - pos, length)
    size = (nl * 1024 + nr).astype(np.uint64)
    c1, c2 = (_mix(p.of(pos - nl, pos + nr) ^ _mix(size + np.uint64(1))) for p in (first, second))
    return dict(zip(names, (doc, pos - bounds[doc], h[pos].view(np.int64), c1.view(np.int64), c2.view(np.int64), nl, nr)))


def _lcp(sums: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common extension of rows a and b: binary search over prefix hashes."""
    low, high = np.zeros(len(a), np.int64), np.minimum(size[a], size[b])
    while len(a) and (low < high).any():
        middle = (low + high + 1) >> 1
        same = sums[a, middle] == sums[b, middle]
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def suffix_order(rows: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the byte rows by (group, bytes), and each row's extension shared with the row before it there.

    `group` must be sorted. Rows are padded with zeros behind their size.
    """
    n = len(rows)
    power = _powers(_BASES[1], 1024)[0][: rows.shape[1]]
    sums = np.zeros((n, rows.shape[1] + 1), np.uint64)
    np.cumsum((rows.astype(np.uint64) + np.uint64(1)) * power, axis=1, out=sums[:, 1:])

    def before(a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        k = _lcp(sums, size, a, b)
        end_a, end_b = k == size[a], k == size[b]
        last = rows.shape[1] - 1
        less = rows[a, np.minimum(k, last)] < rows[b, np.minimum(k, last)]
        return np.where(end_a & end_b, or_equal, np.where(end_a, True, np.where(end_b, False, less)))

    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(heads, n))
    head_of, size_of = np.repeat(heads, sizes), np.repeat(sizes, sizes)
    order, width = np.arange(n), 1
    while n and width < sizes.max():
        # places in groups that are not yet one run
        place = np.flatnonzero(size_of > width)
        inner = place - head_of[place]
        run = inner // width
        other = head_of[place] + (run ^ 1) * width
        end = np.minimum(other + width, head_of[place] + size_of[place])
        low, high = np.minimum(other, end), end.copy()
        item, from_right = order[place], (run & 1).astype(bool)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            # rows of the left run stay ahead of equal rows of the right run
            ahead = before(order[middle], item[open_], from_right[open_])
            low[open_] = np.where(ahead, middle + 1, low[open_])
            high[open_] = np.where(ahead, high[open_], middle)
        target = head_of[place] + (run >> 1) * 2 * width + inner % width + low - np.minimum(other, end)
        new = order.copy()
        new[target] = item
        order, width = new, width * 2
    lcp = np.zeros(n, np.int64)
    same = np.flatnonzero(group[order[1:]] == group[order[:-1]]) + 1 if n > 1 else np.zeros(0, np.int64)
    lcp[same] = _lcp(sums, size, order[same], order[same - 1])
    # verify: what the hashes call equal is equal, and the next byte differs or is missing
    true = np.zeros(n, np.int64)
    for a in range(0, len(same), 8192):
        s = same[a : a + 8192]
        differ = rows[order[s]] != rows[order[s - 1]]
        reach = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        true[s] = np.minimum(reach, np.minimum(size[order[s]], size[order[s - 1]]))
    if (true != lcp).any():
        raw = [r[:k].tobytes() for r, k in zip(rows, size)]
        order = np.array(sorted(range(n), key=lambda i: (group[i], raw[i])), np.int64)
        for i in range(1, n):
            if group[order[i]] == group[order[i - 1]]:
                a, b = raw[order[i]], raw[order[i - 1]]
                true[i] = next((k for k, (u, v) in enumerate(zip(a, b)) if u != v), min(len(a), len(b)))
            else:
                true[i] = 0
    return order, true


def _byte_matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(len(parts), width), size


def repeated_offsets(group: np.ndarray, left: list[bytes], right: list[bytes], length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For each context and o: is the window from o bytes before the anchor in another context of the group? `left` is reversed."""
    reach = length - gram
    rows, size = _byte_matrix(right, length)
    order_r, lcp_r = suffix_order(rows, size, group)
    rows, size_l = _byte_matrix(left, reach)
    order_l, lcp_l = suffix_order(rows, size_l, group)
    n = len(group)
    edge_r, edge_l = (np.append(True, group[o[1:]] != group[o[:-1]]) for o in (order_r, order_l))
    out = np.zeros((n, reach + 1), bool)
    class_r, class_l = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for o in range(reach + 1):
        class_r[order_r] = np.cumsum(edge_r | (lcp_r < length - o))
        class_l[order_l] = np.cumsum(edge_l | (lcp_l < o))
        rows = np.flatnonzero((size_l >= o) & (size >= length - o))
        key = class_r[rows] * np.int64(n + 1) + class_l[rows]
        turn = np.argsort(key)
        same = key[turn[1:]] == key[turn[:-1]]
        hit = np.zeros(len(rows), bool)
        hit[turn[1:][same]] = True
        hit[turn[:-1][same]] = True
        out[rows[hit], o] = True
    return out


def _ranges(mask: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """Bytes, relative to the anchor, that the windows at the marked offsets cover."""
    o = np.flatnonzero(mask)
    if not len(o):
        return [], []
    cut = np.flatnonzero(np.diff(o) > 1)
    first, last = o[np.append(0, cut + 1)], o[np.append(cut, len(o) - 1)]
    return (-last).tolist(), (length - first).tolist()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("d"), text.alias("raw")).select("d", F.xxhash64("raw").alias("t"), "raw")


def _chunk_anchors(raws: list[bytes], length: int):
    """(first row, anchors) of runs of texts of about a chunk; a longer text is worked off in pieces that overlap, each with the anchors that
    begin in it, so memory doesn't follow the length of a text."""
    at = 0
    while at < len(raws):
        end, total = at, 0
        while end < len(raws) and (end == at or total + len(raws[end]) <= _CHUNK):
            total += len(raws[end])
            end += 1
        if total <= 2 * _CHUNK:
            bounds = np.concatenate([[0], np.cumsum([len(r) for r in raws[at:end]])]).astype(np.int64)
            yield at, find_anchors(b"".join(raws[at:end]), bounds, length)
        else:  # one text
            raw = raws[at]
            for begin in range(0, len(raw), _CHUNK):
                # an anchor's windows and its context reach less than `length` bytes beyond it on either side
                low, high = max(0, begin - length), min(len(raw), begin + _CHUNK + 2 * length)
                found = find_anchors(raw[low:high], np.array([0, high - low], np.int64), length)
                found["pos"] = found["pos"] + low
                own = (found["pos"] >= begin) & (found["pos"] < begin + _CHUNK)
                yield at, {k: v[own] for k, v in found.items()}
        at = end


def _anchors(keyed: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in (part for whole in batches for part in byte_slices(whole, 2, _CHUNK)):
            for at, found in _chunk_anchors(batch.column(2).to_pylist(), length):
                who = pa.array(found.pop("doc") + at)
                small = {"pos": pa.int32(), "nl": pa.int16(), "nr": pa.int16()}
                columns = {k: pa.array(v).cast(small.get(k, pa.int64())) for k, v in found.items()}
                whole = pa.table({"d": batch.column(0).take(who), "t": batch.column(1).take(who)} | columns)
                yield from whole.to_batches(max_chunksize=1 << 16)

    d = keyed.schema["d"].dataType.simpleString()
    return keyed.mapInArrow(run, f"d {d}, t long, pos int, h long, c1 long, c2 long, nl short, nr short")


def _repeated_strings(keyed: DataFrame, length: int) -> DataFrame:
    """(h): the hashes of anchor strings that are anchors more than once. Only hashes and counts are shuffled."""

    def run(batches):
        for batch in (part for whole in batches for part in byte_slices(whole, 0, _CHUNK)):
            for _, found in _chunk_anchors(batch.column(0).to_pylist(), length):
                h, n = np.unique(found["h"], return_counts=True)
                for a in range(0, len(h), 1 << 16):
                    columns = [pa.array(h[a : a + (1 << 16)], pa.int64()), pa.array(n[a : a + (1 << 16)], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["h", "n"])

    counted = keyed.select("raw").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return cut_lineage(counted.filter("n > 1").select("h"))


_CONTEXT = ["h", "c1", "c2", "nl", "nr"]


def _with_texts(keyed: DataFrame, lists: DataFrame, column: str, how: str, measured: bool = False) -> DataFrame:
    """Join of the texts with a packed list per document. With `measured` a list of small measured size is broadcast."""
    side = lists.withColumnsRenamed({"d": "d2", "t": "t2"})
    if measured:
        n = lists.agg(F.sum(F.octet_length(column) + 64)).first()[0] or 0
        side = F.broadcast(side) if n <= BROADCAST_BYTES else side
    return keyed.join(side, keyed["d"].eqNullSafe(side["d2"]) & (keyed["t"] == side["t2"]), how).drop("d2", "t2")


def _contexts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of one context per row of `wanted` (context columns and a representative d, t, pos)."""
    item = F.struct("pos", "nl", "nr", "h", "c1", "c2")
    lists = wanted.groupBy("d", "t").agg(F.to_json(F.collect_list(item)).alias("items"))  # bounded by the document's length

    def run(batches):
        import json

        for batch in batches:
            rows = []
            for raw, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i in json.loads(items):
                    p = i["pos"]
                    rows.append((i["h"], i["c1"], i["c2"], i["nl"], i["nr"], raw[p - i["nl"] : p][::-1], raw[p : p + i["nr"]]))
            for a in range(0, len(rows), 8192):
                types = [pa.int64()] * 3 + [pa.int16()] * 2 + [pa.binary()] * 2
                columns = [pa.array(c, t) for c, t in zip(zip(*rows[a : a + 8192]), types)]
                yield pa.RecordBatch.from_arrays(columns, names=[*_CONTEXT, "left", "right"])

    joined = _with_texts(keyed, lists, "items", "inner").select("raw", "items")
    return joined.mapInArrow(run, "h long, c1 long, c2 long, nl short, nr short, left binary, right binary")


_RANGES = "h long, c1 long, c2 long, nl short, nr short, a array<int>, z array<int>"


def _sorted_ranges(contexts: DataFrame, n: int, length: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("h")
        group = table["h"].to_numpy()
        marks = repeated_offsets(group, table["left"].to_pylist(), table["right"].to_pylist(), length)
        both = [_ranges(m, length) for m in marks]
        out = table.select(_CONTEXT)
        out = out.append_column("a", pa.array([b[0] for b in both], pa.list_(pa.int32())))
        return out.append_column("z", pa.array([b[1] for b in both], pa.list_(pa.int32())))

    parts = max(1, -(-n // PART_ROWS))
    dealt = contexts.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(parts)).cast("int"))
    return dealt.groupBy("part").applyInArrow(run, _RANGES)


def _counted_ranges(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchor strings of very many contexts: windows are counted, with map-side combination."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                raw = row["left"][::-1] + row["right"]
                nl, nr = row["nl"], row["nr"]
                o = np.arange(max(0, length - nr), nl + 1)
                if not len(o):
                    continue
                x = np.frombuffer(raw, np.uint8)
                w1, w2 = (_mix(PrefixHashes(x, b).of(nl - o, nl - o + length)).view(np.int64) for b in _BASES)
                columns = [pa.array([row[c]] * len(o), t) for c, t in zip(_CONTEXT, [pa.int64()] * 3 + [pa.int16()] * 2)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(o.astype(np.int32)), pa.array(w1), pa.array(w2)], names=[*_CONTEXT, "o", "w1", "w2"])

    windows = contexts.mapInArrow(run, "h long, c1 long, c2 long, nl short, nr short, o int, w1 long, w2 long")
    key = ["h", "o", "w1", "w2"]
    often = windows.groupBy(key).count().filter("count > 1").select(key)
    hit = windows.join(often, key, "left_semi").groupBy(_CONTEXT).agg(F.collect_list("o").alias("o"))  # at most one per offset
    return hit.select(
        *_CONTEXT, F.transform("o", lambda o: -o).alias("a"), F.transform("o", lambda o: (F.lit(length) - o).cast("int")).alias("z")
    )


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """(d, t, spans): per document with repeated bytes its maximal spans, packed as pairs of int32 (start, end)."""
    keyed = _keyed(docs, id_col, text_col)
    again = _repeated_strings(keyed, length)
    # the texts are read twice, so anchors that occur once are never written
    side = F.broadcast(again) if again.count() * 48 <= BROADCAST_BYTES else again
    anchors = cut_lineage(_anchors(keyed, length).join(side, "h", "left_semi"))
    groups = cut_lineage(
        anchors.groupBy(_CONTEXT).agg(F.count("*").alias("n"), F.min(F.struct("d", "t", "pos")).alias("r"))
    )
    per_string = groups.groupBy("h").agg(F.count("*").alias("contexts")).filter("contexts > 1")
    wanted = groups.join(per_string, "h").select(*_CONTEXT, "r.d", "r.t", "r.pos", "contexts")
    contexts = cut_lineage(_contexts(keyed, wanted.filter(F.col("contexts") <= group_rows)))
    ranges = _sorted_ranges(contexts, contexts.count(), length)
    scratch = [again, groups, contexts]
    large = wanted.filter(F.col("contexts") > group_rows)
    if large.head(1):
        scratch.append(cut_lineage(_contexts(keyed, large)))
        ranges = ranges.unionByName(_counted_ranges(scratch[-1], length))
    whole = groups.filter((F.col("n") > 1) & (F.col("nl") + F.col("nr") >= length)).select(
        *_CONTEXT, F.array((-F.col("nl")).cast("int")).alias("a"), F.array(F.col("nr").cast("int")).alias("z")
    )
    ranges = cut_lineage(ranges.filter(F.size("a") > 0).unionByName(whole))
    release(*scratch)
    placed = anchors.join(ranges, _CONTEXT).select("d", "t", "pos", F.explode(F.arrays_zip("a", "z")).alias("x"))
    span = F.struct((F.col("pos") + F.col("x.a")).alias("a"), (F.col("pos") + F.col("x.z")).alias("z"))
    lists = placed.groupBy("d", "t").agg(F.collect_set(span).alias("s"))  # bounded by the document's length

    def merge(batches):
        for batch in batches:
            out = []
            for spans in batch.column(2).to_pylist():
                pairs = np.array(sorted((s["a"], s["z"]) for s in spans), np.int32)
                reach = np.maximum.accumulate(pairs[:, 1])
                head = np.append(True, pairs[1:, 0] > reach[:-1])
                merged = np.column_stack([pairs[head, 0], reach[np.append(np.flatnonzero(head)[1:] - 1, len(pairs) - 1)]])
                out.append(merged.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["d", "t", "spans"])

    d = keyed.schema["d"].dataType.simpleString()
    spans = cut_lineage(lists.mapInArrow(merge, f"d {d}, t long, spans binary"))
    release(anchors, ranges)
    return spans


def _kept(raw: bytes, spans: np.ndarray) -> bytes:
    edges = np.concatenate([[0], spans.ravel(), [len(raw)]]).reshape(-1, 2)
    return b"".join(raw[a:z] for a, z in edges)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the repeated bytes taken out of the text; pieces of characters that are left behind go too."""
    spans = repeated_spans(docs, length, id_col, text_col)
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("row"), F.col(id_col).alias("d"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))
    joined = _with_texts(rows.withColumn("t", F.xxhash64("raw")), spans, "spans", "left", measured=True)

    def run(batches):
        for batch in batches:
            texts = []
            for raw, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept = raw if packed is None else _kept(raw, np.frombuffer(packed, "<i4").reshape(-1, 2))
                texts.append(kept.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "kept"])

    row_type = rows.schema["row"].dataType.simpleString()
    out = joined.select("row", "raw", "spans").mapInArrow(run, f"row {row_type}, kept string")
    missing = F.col("row")[text_col].isNull()
    return out.select(*[F.when(~missing, F.col("kept")).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names])


def span_digests(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of what is kept, for every row."""
    keyed = _keyed(docs, id_col, text_col)
    joined = _with_texts(keyed, repeated_spans(docs, length, id_col, text_col), "spans", "left", measured=True).select("d", "raw", "spans")

    def run(batches):
        for batch in batches:
            rows = []
            for raw, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = np.frombuffer(packed or b"", "<i4").reshape(-1, 2)
                rows.append((len(raw), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), hashlib.sha256(_kept(raw, spans)).hexdigest()))
            columns = list(zip(*rows)) or [(), (), (), ()]
            types = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    d = keyed.schema["d"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {d}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
