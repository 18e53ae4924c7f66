"""Jaccard join of word n-gram sets with token-combination prefixes, and the groups that its links form.

Two texts link when 100 * |x & y| >= 75 * |x | y| for their sets of 5-word shingles. The join is exact:

1. Texts of equal sets are one set, known by its fingerprint. A set of n shingles can miss at most t = n - ceil(0.75 n) of a
   partner's, so in any common order the first t + l shingles of two partners share at least min(l, l') (extended prefixes). These
   prefixes, in hash order, are counted. Equal shingles of a batch are one row, so frequent ones stay few rows per task. A set
   with fewer shingles in other prefixes than it must share has no partner.
2. The whole sets of the others are counted the same way. A set of n with fewer than r = ceil(0.75 n) shingles in other sets has
   no partner, so texts that share only a passage go. Of its d shingles in other sets a set indexes, in the order of their counts, until its
   signatures outnumber the d - r it may miss: rare ones one by one, frequent ones as pairs inside classes dealt by hash. A class with
   m shingles in the prefix withstands m - 1 misses, so the prefix is extended by one shingle per class. The number of
   classes follows the size band of the sets, so partners agree on it.
3. Each set meets the most central set of its signatures (largest mean count), the one it shares most signatures with. Verified
   links give components. Only signatures that still hold several components are expanded, in blocks, and only into pairs of
   different components: pairs inside a component can't change the result. Parities of the sets' hashes over 1024 classes bound how much two
   sets differ from below; all pairs that this bound lets link are verified.

Sets are held as 64-bit hashes of shingles; verification counts them exactly. Cases: a null, empty or blank text has the empty set
and is a component of its own; with fewer than 5 words the whole sequence is the one shingle. Repeated rows and equal ids are rows of their own
in the result and share their set's component. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkg.llm.common import byte_slices, handing_back
from textkg.llm.suffix_dedup import PrefixHashes, _mix
from textkg.operators.closure import connected_components
from textkg.session import broadcast_if_small, cut_lineage

WORDS = 5
SHARE = 75  # per cent
FREQUENT = 64  # shingles in more prefixes than this are indexed in pairs
BLOCK = 256
BITS = 1024
FIRSTS = 8
BROADCAST_BYTES = 48 << 20
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def least_shared(n: int, share: int = SHARE) -> int:
    return -(-share * n // 100)


def extension(n: int, share: int = SHARE) -> int:
    """Shingles that two partners share at least in their extended prefixes; never falls with n."""
    return min(least_shared(n, share), max(4, -(-n // 20)))


def required(n: int, share: int = SHARE) -> int:
    """What a set of n must share with any partner's prefix: partners have at least share * n shingles."""
    return extension(least_shared(n, share), share)


def prefix_size(n: int, share: int = SHARE) -> int:
    return n - least_shared(n, share) + extension(n, share)


def classes(band: int, share: int = SHARE) -> int:
    """Classes of frequent shingles for sets of 2^band to 2^(band + 1) - 1; 0: no pairs, all shingles are indexed singly."""
    return least_shared(1 << band, share) // 6


def shingle_sets(texts: list[str], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, chunk by chunk."""
    at = 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and (end == at or total + len(texts[end]) <= _CHUNK):
            total += len(texts[end])
            end += 1
        yield from _chunk_sets(texts[at:end], words)
        at = end


def _chunk_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    coded = split.flatten().dictionary_encode()
    raw = coded.dictionary.cast(pa.large_binary())
    sizes = pc.binary_length(raw).to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    flat = np.frombuffer(b"".join(raw.to_pylist()), np.uint8)
    hashes = _mix(PrefixHashes(flat, _BASE).of(ends - sizes, ends) ^ _mix(sizes.astype(np.uint64)))
    which = coded.indices.to_numpy()
    real = sizes[which] > 0 if len(which) else np.zeros(0, bool)  # blanks at the ends of a text leave empty strings
    h = hashes[which][real] if len(which) else np.zeros(0, np.uint64)
    bounds = np.append(0, np.cumsum(real))[split.offsets.to_numpy() - split.offsets[0].as_py()]
    joint = np.zeros(max(len(h) - words + 1, 0), np.uint64)
    for k in range(words):
        joint = joint * np.uint64(_BASE) + h[k : k + len(joint)]
    joint = _mix(joint)
    for a, z in zip(bounds[:-1], bounds[1:]):
        if z - a >= words:
            yield np.unique(joint[a : z - words + 1])
        elif z > a:
            whole = np.uint64(z - a)
            for x in h[a:z]:
                whole = _mix(np.array([whole]) * np.uint64(_BASE) + x)[0]
            yield np.array([whole])
        else:
            yield np.zeros(0, np.uint64)


def _fingerprint(found: np.ndarray) -> int:
    n = np.array([len(found)], np.uint64)
    with np.errstate(over="ignore"):
        total = (_mix(found) * np.uint64(_BASE)).sum(dtype=np.uint64)
        return int(_mix(total + _mix(n + np.uint64(7))).view(np.int64)[0])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("t"), text.alias("text"))


def _sets_table(keyed: DataFrame, share: int) -> DataFrame:
    """(d, t, n, fp, need, prefix) of every row; the prefix holds 6 bytes of each hash."""

    @handing_back
    def run(batches):
        for batch in (part for whole in batches for part in byte_slices(whole, 2, _CHUNK)):
            rows = []
            for found in shingle_sets(batch.column(2).to_pylist()):
                n = len(found)
                head = (found[: prefix_size(n, share) if n else 0] >> np.uint64(16)).astype("<u8")
                rows.append((n, _fingerprint(found), required(n, share), head.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()))
            n, fp, need, head = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (n, fp, need)), pa.array(head, pa.binary())],
                names=["d", "t", "n", "fp", "need", "prefix"],
            )

    d = keyed.schema["d"].dataType.simpleString()
    return keyed.mapInArrow(run, f"d {d}, t long, n long, fp long, need long, prefix binary")


def _of_sets(rows: DataFrame, sets: DataFrame, value: str) -> DataFrame:
    """(fp, value) of the representatives in `sets` (d, t, fp); these are broadcast only when they are few."""
    side = sets.select(F.col("d").alias("d2"), F.col("t").alias("t2"), F.col("fp").alias("fp2"))
    side = F.broadcast(side) if sets.count() * 40 <= BROADCAST_BYTES else side
    rows = rows.select("d", "t", value)
    return rows.join(side, rows["d"].eqNullSafe(side["d2"]) & (rows["t"] == side["t2"])).select(F.col("fp2").alias("fp"), value)


def _shared(packed: DataFrame, width: int) -> DataFrame:
    """(sig, total, fp) from (fp, hashes of `width` bytes): the hashes that occur more than once. Each is one row a batch."""

    @handing_back
    def run(batches):
        for batch in batches:
            fps, values = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            sizes = np.array([len(v) // width for v in values], np.int64)
            wide = np.zeros((int(sizes.sum()), 8), np.uint8)
            wide[:, :width] = np.frombuffer(b"".join(values), np.uint8).reshape(-1, width)
            sig = wide.reshape(-1).view("<i8")
            who = np.repeat(fps, sizes)
            order = np.argsort(sig, kind="stable")
            sig, who = sig[order], who[order]
            heads = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, np.int64)
            counts = np.diff(np.append(heads, len(sig)))
            for a in range(0, len(heads), 1 << 16):
                h, c = heads[a : a + (1 << 16)], counts[a : a + (1 << 16)]
                # the others of each hash, as one flat array with offsets; none where it is alone
                inner = np.ones(int(c.sum()), bool)
                inner[h - h[0]] = False
                ends = np.append(0, np.cumsum(c - 1)).astype(np.int32)
                others = who[h[0] : h[0] + len(inner)][inner]
                more = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(c == 1, False)), pa.array(others))
                yield pa.RecordBatch.from_arrays([pa.array(sig[h]), pa.array(who[h]), more], names=["sig", "fp", "more"])

    found = packed.mapInArrow(run, "sig long, fp long, more array<long>")
    total = F.sum(1 + F.coalesce(F.size(F.col("more")), F.lit(0))).over(Window.partitionBy("sig"))
    more = F.coalesce("more", F.array().cast("array<bigint>"))
    counted = found.withColumn("more", more).withColumn("total", total).filter("total > 1")
    return counted.select("sig", "total", F.explode(F.concat(F.array("fp"), "more")).alias("fp"))


def set_signatures(n: int, counts: np.ndarray, sigs: np.ndarray, share: int = SHARE, frequent: int = FREQUENT) -> np.ndarray:
    """Signatures of a set of n shingles from those that other sets have, or none if it can't have a partner."""
    d, r = len(sigs), least_shared(n, share)
    if d < r:
        return np.zeros(0, np.uint64)
    order = np.lexsort((sigs, counts))
    counts, sigs = counts[order], sigs[order].astype(np.uint64)
    single = _mix(sigs + np.uint64(1))
    need = d - r + 1
    rare = counts <= frequent
    out = []
    for band in {n.bit_length() - 1, least_shared(n, share).bit_length() - 1}:
        m = classes(band, share)
        if not m or rare[:need].all():
            out.append(single[:need])
            continue
        group = (single % np.uint64(m)).astype(np.int64)
        # each rare shingle counts, and each frequent one but the first of its class
        first = np.zeros(d, bool)
        often = np.flatnonzero(~rare)
        first[often[np.unique(group[often], return_index=True)[1]]] = True
        end = int(np.searchsorted(np.cumsum(~first), need)) + 1
        out.append(single[:end][rare[:end]])
        inside = often[often < end]
        for g in np.unique(group[inside]):
            x = single[inside[group[inside] == g]]
            a, b = np.triu_indices(len(x), 1)
            low, high = np.minimum(x[a], x[b]), np.maximum(x[a], x[b])
            out.append(_mix(low * np.uint64(_BASE) + high + np.uint64(band)))
    return np.unique(np.concatenate(out))


def _signatures(shared: DataFrame, share: int, frequent: int) -> DataFrame:
    """(fp, n, rank, sig) from (fp, n, s: counts and shingles)."""

    @handing_back
    def run(batches):
        for batch in batches:
            for fp, n, s in zip(*(c.to_pylist() for c in batch.columns)):
                counts = np.array([x["total"] for x in s], np.int64)
                found = set_signatures(n, counts, np.array([x["sig"] for x in s], np.int64), share, frequent)
                k = len(found)
                if k:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(k, fp)), pa.array(np.full(k, n)), pa.array(np.full(k, -counts.mean() * math.sqrt(len(counts)))),
                            pa.array(found.view(np.int64)),
                        ],
                        names=["fp", "n", "rank", "sig"],
                    )

    return shared.mapInArrow(run, "fp long, n long, rank double, sig long")


def parity_bits(found: np.ndarray) -> bytes:
    """For each of BITS classes of hashes whether the set has an odd number of them. Bitmaps differ in no more bits than their sets in
    elements, so those that differ in more can't link."""
    return np.packbits(np.bincount((found & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1).tobytes()


def _members(texts: DataFrame) -> DataFrame:
    """(fp, members, bits): the shingle hashes of each set, packed, and their parities."""

    @handing_back
    def run(batches):
        for batch in (part for whole in batches for part in byte_slices(whole, 1, _CHUNK)):
            fps = batch.column(0)
            for i, found in enumerate(shingle_sets(batch.column(1).to_pylist())):
                packed = (pa.array([x], pa.binary()) for x in (found.astype("<u8").tobytes(), parity_bits(found)))
                yield pa.RecordBatch.from_arrays([fps.slice(i, 1), *packed], names=["fp", "members", "bits"])

    return texts.mapInArrow(run, "fp long, members binary, bits binary").dropDuplicates(["fp"])


def _verified(pairs: DataFrame, members: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) that link."""

    @handing_back
    def run(batches):
        for batch in batches:
            x, y = ([np.frombuffer(v, "<u8") for v in batch.column(i).to_pylist()] for i in (2, 3))
            keep = []
            for p, q in zip(x, y):
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                common = int((q[at] == p).sum())
                keep.append(100 * common >= share * (len(p) + len(q) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    left = members.select(F.col("fp").alias("a"), F.col("members").alias("x"))
    right = members.select(F.col("fp").alias("b"), F.col("members").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _sizes_fit(a: str, b: str, share: int):
    return (100 * F.col(a) >= share * F.col(b)) & (100 * F.col(b) >= share * F.col(a))


def _open_pairs(rows: DataFrame, members: DataFrame, share: int, block: int) -> DataFrame:
    """Distinct pairs (a, b) of different components that share a signature and whose parities are near enough to link; `rows` are
    (sig, fp, n, label)."""
    # one row per set: its parities and its first signatures, where a pair that shares one of them before `sig` is formed
    each = rows.groupBy("fp", "n", "label").agg(F.sort_array(F.collect_set("sig")).alias("sigs"))  # bounded by the set
    each = each.join(members.select("fp", "bits"), "fp").withColumn("firsts", F.slice("sigs", 1, FIRSTS))
    large = rows.groupBy("sig").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).filter("blocks > 1")
    dealt = each.select("fp", "n", "label", "bits", "firsts", F.explode("sigs").alias("sig")).join(broadcast_if_small(large), "sig", "left")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))))
    lists = dealt.groupBy("sig", "block").agg(F.collect_list(F.struct("fp", "n", "label", "bits", "firsts")).alias("m"))
    right = lists.select("sig", F.col("block").alias("block2"), F.col("m").alias("m2"))
    met = lists.join(right, "sig").filter("block <= block2").select("m", "m2", "sig")

    def parts(column):
        """Offsets and the fields of all members of the lists of a column."""
        flat, ends = column.flatten(), column.offsets.to_numpy()
        bits = np.frombuffer(b"".join(flat.field("bits").to_pylist()), np.uint64).reshape(len(flat), -1)
        first = flat.field("firsts")
        sizes = np.diff(first.offsets.to_numpy())
        # shorter lists are filled up with their last entry
        at = first.offsets.to_numpy()[:-1, None] + np.minimum(np.arange(FIRSTS), sizes[:, None] - 1)
        return ends - ends[0], bits, first.values.to_numpy()[at], *(flat.field(k).to_numpy() for k in ("fp", "n", "label"))

    @handing_back
    def run(batches):
        for batch in batches:
            (ends, bits, first, *x), (ends2, bits2, first2, *y) = parts(batch.column(0)), parts(batch.column(1))
            sigs = batch.column(2).to_numpy()
            for k in range(len(batch)):
                s, s2 = slice(ends[k], ends[k + 1]), slice(ends2[k], ends2[k + 1])
                (fa, na, la), (fb, nb, lb) = (v[s] for v in x), (v[s2] for v in y)
                fits = (la[:, None] != lb) & (100 * na[:, None] >= share * nb) & (100 * nb >= share * na[:, None])
                i, j = np.nonzero(fits)
                apart = np.bitwise_count(bits[s][i] ^ bits2[s2][j]).sum(axis=1, dtype=np.int64)
                near = (100 + share) * apart <= (100 - share) * (na[i] + nb[j])  # the bound on elements that only one set has
                i, j = i[near], j[near]
                f, f2 = first[s][i], first2[s2][j]
                new = ~((f[:, :, None] == f2[:, None, :]) & (f < sigs[k])[:, :, None]).any(axis=(1, 2))
                low, high = np.minimum(fa[i], fb[j])[new], np.maximum(fa[i], fb[j])[new]
                pairs = np.unique(np.stack([low, high]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return met.mapInArrow(run, "a long, b long").distinct()


def linked_sets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE, frequent: int = FREQUENT, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Rows (d, n, fp) of all documents, and components (node, component) of the fingerprints that have links."""
    keyed = _keyed(docs, id_col, text_col)
    table = cut_lineage(_sets_table(keyed, share))
    sets = table.filter("n > 0").groupBy("fp").agg(F.min(F.struct("d", "t")).alias("r"), F.max("n").alias("n"), F.max("need").alias("need"))
    sets = cut_lineage(sets.select("fp", "n", "need", "r.d", "r.t"))
    # a row repeated with its id counts twice here, which keeps only more
    held = _shared(_of_sets(table, sets, "prefix"), 6).groupBy("fp").agg(F.count("*").alias("held"))
    chosen = cut_lineage(sets.join(held, "fp").filter("held >= need").select("fp", "n", "d", "t"))
    members = cut_lineage(_members(_of_sets(keyed, chosen, "text")))
    lists = _shared(members, 8).groupBy("fp").agg(F.collect_list(F.struct("total", "sig")).alias("s"))  # bounded by the set
    signed = cut_lineage(_signatures(lists.join(chosen.select("fp", "n"), "fp").select("fp", "n", "s"), share, frequent))
    hubs = signed.groupBy("sig").agg(F.count("*").alias("k"), F.min(F.struct("rank", "fp", "n")).alias("hub")).filter("k > 1")
    signed = cut_lineage(signed.join(hubs, "sig").select("fp", "n", "sig", "hub"))
    star = signed.filter((F.col("fp") != F.col("hub.fp")) & _sizes_fit("n", "hub.n", share))
    star = star.groupBy("fp", F.col("hub.fp").alias("b")).count().groupBy("fp").agg(F.max(F.struct("count", "b")).alias("best"))
    links = cut_lineage(_verified(star.select(F.col("fp").alias("a"), F.col("best.b").alias("b")), members, share))
    labels = connected_components(links)
    joined = signed.join(labels, signed["fp"] == labels["node"], "left")
    labelled = cut_lineage(joined.select("sig", "fp", "n", F.coalesce("component", "fp").alias("label")))
    mixed = labelled.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("sig")
    rest = cut_lineage(labelled.join(mixed, "sig", "left_semi"))
    more_links = cut_lineage(_verified(cut_lineage(_open_pairs(rest, members, share, block)), members, share))
    if more_links.head(1):
        labels = connected_components(links.unionByName(more_links))
    return table, labels


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id that links reach, for every row."""
    table, labels = linked_sets(docs, id_col, text_col, share)
    rows = table.join(labels, table["fp"] == labels["node"], "left").select("d", "n", F.coalesce("component", "fp").alias("label"))
    heads = rows.filter("n > 0").groupBy("label").agg(F.min("d").alias("head"))
    out = rows.filter("n > 0").join(heads, "label").select("d", "n", "head").unionByName(rows.filter("n = 0").select("d", "n", F.col("d").alias("head")))
    return out.select(F.col("d").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("head").alias("component_id"))


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE) -> DataFrame:
    """`docs` without near duplicates: of each group the row of the smallest id stays; rows with an empty set all stay."""
    table, labels = linked_sets(docs, id_col, text_col, share)
    rows = table.join(labels, table["fp"] == labels["node"], "left").withColumn("label", F.coalesce("component", "fp"))
    heads = rows.filter("n > 0").groupBy("label").agg(F.min(F.struct("d", "t")).alias("r")).select("r.d", "r.t")
    heads = cut_lineage(heads.unionByName(rows.filter("n = 0").select("d", "t").distinct()))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("d"), F.xxhash64(text).alias("t"))
    few = heads.count() * 40 <= BROADCAST_BYTES
    side = heads.withColumnsRenamed({"d": "d2", "t": "t2"})
    match = whole["d"].eqNullSafe(side["d2"]) & (whole["t"] == side["t2"])
    kept = whole.join(F.broadcast(side) if few else side, match, "left_semi")
    twice = rows.filter("n > 0").groupBy("d", "t").count().filter("count > 1")
    if twice.head(1):  # a row repeated with its id is one document
        empty = rows.filter("n = 0").select("d", "t").distinct()
        blank = kept.join(empty, ["d", "t"], "left_semi") if empty.head(1) else kept.limit(0)
        kept = kept.join(empty, ["d", "t"], "left_anti").dropDuplicates(["d", "t"]).unionByName(blank)
    return kept.select("row.*")
