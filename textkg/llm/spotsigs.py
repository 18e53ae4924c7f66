"""Document fingerprints from spot signatures.

A spot signature is a common word (the anchor) with the chain of the next `CHAIN` content words behind it, hashed to 64 bits; the set of a
text's signatures, sorted and written in hexadecimal, is its fingerprint. Since a signature depends on a few neighbouring words only, an
edit changes the signatures around it and no others. Where no anchor has come for `DROUGHT` content words, and at the begin of a text,
every content word starts a chain, so texts of other languages have signatures too.

`near_duplicates` compares fingerprints: equal ones are one representative. Lengths of sets are cut into ranges such that similar sets lie in the same
range or in neighbouring ones; inside a range candidates share one of their rarest signatures, and the pair is dropped as soon as its lengths
or the places of the shared signature leave no room for the threshold. What remains is verified on the whole sets.

Cases: null is the empty text; texts without a word (`[0-9A-Za-z]` or code points beyond ASCII) have the empty fingerprint. A text too short for a
chain has the 4-grams of its characters, or itself, as signatures. A run of more than 32 code points without a blank is read as
its overlapping pairs of code points. Two empty fingerprints are alike (1.0), an empty one and another are not (0.0).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkg.operators.closure import connected_components
from textkg.session import cut_lineage

# Common words of the four languages of the corpus; the anchors.
ANCHORS = (
    "the of and to in a is that for with on as at by from this was are it or an be "
    "le la les de des du et en un une que qui dans pour sur par avec au est pas "
    "der die das und zu den von mit sich dem ein eine ist im für auf nicht als auch "
    "el los las y del una con para se no al lo su más"
).split()
CHAIN = 3
DROUGHT = 8
SHORT_GRAM = 4
LONG_WORD = 32
THRESHOLD = 0.75
_HEX = 16
_ROWS = 256

_anchor_bytes = frozenset(a.encode() for a in ANCHORS)
# Digits, letters and all bytes of other code points; everything else separates words.
_WORD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def spot_words(text: str | None) -> list[bytes]:
    """The words of a text in lower case; a long run is read as its pairs of code points."""
    words = (text or "").lower().encode("utf-8", "replace").translate(_WORD).split()
    if max(map(len, words), default=0) <= LONG_WORD:
        return words
    out = []
    for w in words:
        run = w.decode("utf-8", "replace") if len(w) > LONG_WORD else ""
        out += [run[i : i + 2].encode() for i in range(len(run) - 1)] if len(run) > LONG_WORD else [w]
    return out


def signatures(text: str | None) -> set[int]:
    """The hashed spot signatures of a text."""
    words = spot_words(text)
    content: list[bytes] = []
    chains: list[tuple[bytes, int]] = []
    dry = DROUGHT
    for w in words:
        if w in _anchor_bytes:
            chains.append((w, len(content)))
            dry = 0
        else:
            if dry >= DROUGHT:
                chains.append((b"", len(content)))
            dry += 1
            content.append(w)
    hashed = xxhash.xxh64_intdigest
    last = len(content) - CHAIN
    found = {hashed(a + b" " + b" ".join(content[i : i + CHAIN])) for a, i in chains if i <= last}
    if not found and words:
        whole = b" ".join(words).decode("utf-8", "replace")
        grams = [whole[i : i + SHORT_GRAM] for i in range(max(1, len(whole) - SHORT_GRAM + 1))]
        found = {hashed(b"\x00" + g.encode()) for g in grams}
    return found


def sorted_set(text: str | None) -> np.ndarray:
    found = signatures(text)
    return np.sort(np.fromiter(found, np.uint64, len(found)))


def hexadecimal(numbers: np.ndarray) -> str:
    return numbers.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, threshold: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 as soon as their lengths rule the threshold out."""
    short, long = sorted((len(a), len(b)))
    if not long:
        return 1.0
    if short < threshold * long or not short:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    found = both / (len(a) + len(b) - both)
    return found if found >= threshold else 0.0


def fingerprint_texts(
    df: DataFrame, texts: dict[str, str], keep: list[str], pairs: dict[str, tuple[str, str]] | None = None
) -> DataFrame:
    """The columns `keep`, a fingerprint for each text column (`texts`: column to new name), and the likeness of pairs of text columns.

    Values that follow each other in a column or between columns are computed once.
    """
    pairs = pairs or {}
    columns = list(texts)
    fields = [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in keep]
    fields += [f"`{n}` string" for n in texts.values() if n] + [f"`{n}` double" for n in pairs]
    names = [*keep, *[n for n in texts.values() if n], *pairs]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, np.ndarray] = {}
        for whole in batches:
            for begin in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(begin, _ROWS)
                prints: dict[str, list[str]] = {c: [] for c in columns}
                alike: dict[str, list[float]] = {n: [] for n in pairs}
                for row in zip(*[batch.column(len(keep) + i) for i in range(len(columns))]):
                    sets, before = {}, known
                    known = {}
                    for c, value in zip(columns, row):
                        text = value.as_py()
                        if text not in known:
                            known[text] = before[text] if text in before else sorted_set(text)
                        sets[c] = known[text]
                        if texts[c]:
                            prints[c].append(hexadecimal(sets[c]))
                    for n, (a, b) in pairs.items():
                        alike[n].append(likeness(sets[a], sets[b]))
                arrays = [batch.column(i) for i in range(len(keep))]
                arrays += [pa.array(prints[c], pa.string()) for c in columns if texts[c]]
                arrays += [pa.array(v, pa.float64()) for v in alike.values()]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.select(*keep, *[F.col(c) for c in columns]).mapInArrow(run, ", ".join(fields))


def next_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, next_text): every row with the text of the next one in falling order of ids; the first follows the last.

    Rows of one id are ordered by a hash of their texts, rows without id come last. Ids are cut into ranges by quantiles; each range is sorted
    alone, with a copy of the first rows of the following range at its end. The texts are shuffled once.
    """
    spark = docs.sparkSession
    key = [F.col("doc_id").isNull().alias("no_id"), F.expr("~doc_id").alias("place")]
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).select("*", *key)
    n = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    bounds = np.unique(np.array(rows.agg(F.percentile_approx("place", shares, 20 * n)).first()[0] or [], np.int64))

    @F.pandas_udf("int")
    def range_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, place.to_numpy(np.int64), side="right").astype(np.int32))

    # rows without id stand behind all others
    part = F.when(F.col("no_id"), F.lit(len(bounds) + 1)).otherwise(range_of(F.coalesce("place", F.lit(0).cast("bigint"))))
    ranged = rows.withColumn("part", part)
    firsts = sorted(tuple(r) for r in ranged.groupBy("part").agg(F.min("place")).collect())  # one row per range
    if not firsts:
        return rows.select("doc_id", "text", F.lit("").alias("next_text"))
    ends = [(place, firsts[i - 1][0]) for i, (_, place) in enumerate(firsts)]
    edge = F.broadcast(spark.createDataFrame(ends, "edge_place long, edge_part int"))
    copies = ranged.join(edge, F.col("place").eqNullSafe(F.col("edge_place")), "left")
    own = F.array(F.struct("part", F.lit(False).alias("copy")))
    other = F.array(F.struct(F.col("edge_part").alias("part"), F.lit(True).alias("copy")))
    places = F.when(F.col("edge_part").isNull(), own).otherwise(F.concat(own, other))
    dealt = copies.select("doc_id", "text", "no_id", "place", F.inline(places))
    order = Window.partitionBy("part").orderBy("copy", "no_id", "place", F.xxhash64("text"))
    return (
        dealt.withColumn("next_text", F.lead("text").over(order)).where(~F.col("copy")).select("doc_id", "text", "next_text")
    )


def with_edited(following: DataFrame) -> DataFrame:
    """Adds `edited`: the last third of a text replaced by as many first code points of the next one."""
    third = F.floor(F.length("text") / 3).cast("int")
    kept = F.expr("left(text, length(text) - cast(floor(length(text) / 3) AS int))")
    return following.withColumn("edited", F.concat(kept, F.when(third > 0, F.substring("next_text", F.lit(1), third)).otherwise("")))


def _set_of(column: str) -> Column:
    """The signatures in a fingerprint as fixed-length strings."""
    return F.expr(f"regexp_extract_all({column}, '(.{{{_HEX}}})', 1)")


def similar_pairs(prints: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, likeness): all pairs a < b of distinct non-empty fingerprints (columns id, fingerprint) that are as alike as `threshold`."""
    sets = prints.where("fingerprint <> ''").select("id", _set_of("fingerprint").alias("spots")).withColumn("size", F.size("spots"))
    sets = cut_lineage(sets)
    # ranges [t^-k, t^-(k+1)): a similar set is at most one range above
    step = -math.log(threshold)
    part = F.floor(F.log(F.col("size").cast("double")) / step + 1e-9).cast("int")
    rows = sets.select("id", "size", part.alias("part"), F.explode("spots").alias("spot"))
    rarity = rows.groupBy("spot").agg(F.count("*").alias("n"))
    rare = rows.join(rarity, "spot").where("n > 1")
    # the rarest signatures first; those of one document only can't be shared, but keep their places
    alone = rows.join(rarity.where("n = 1"), "spot").groupBy("id").agg(F.count("*").alias("alone"))
    ranked = (
        rare.join(alone, "id", "left").na.fill(0, ["alone"])
        .withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy("n", "spot")) + F.col("alone"))
        .where(F.col("place") <= F.col("size") - F.ceil(F.lit(threshold - 1e-9) * F.col("size")) + 1)
        .select("id", "size", "part", "spot", "place")
    )
    keyed = ranked.select("id", "size", "spot", "place", F.col("part").alias("met")).alias("x")
    both = ranked.select("id", "size", "spot", "place", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("met")).alias("y")
    needed = F.lit(threshold / (1 + threshold)) * (F.col("x.size") + F.col("y.size")) - 1e-6
    left_over = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    candidates = (
        keyed.join(both, ["spot", "met"])
        .where("x.size > y.size OR (x.size = y.size AND x.id < y.id)")
        .where(F.col("y.size") >= threshold * F.col("x.size") - 1e-6)
        .where(1 + left_over + F.least(F.col("x.place"), F.col("y.place")) - 1 >= needed)
        .select(F.col("x.id").alias("p"), F.col("y.id").alias("q")).distinct()
    )
    found = (
        candidates.join(sets.select(F.col("id").alias("p"), F.col("spots").alias("s")), "p")
        .join(sets.select(F.col("id").alias("q"), F.col("spots").alias("t")), "q")
        .withColumn("both", F.size(F.array_intersect("s", "t")))
        .withColumn("likeness", F.col("both") / (F.size("s") + F.size("t") - F.col("both")))
        .where(F.col("likeness") >= threshold)
    )
    return found.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "likeness")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, class_id): documents with alike fingerprints, linked directly or by others, share the smallest id among them."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = cut_lineage(fingerprint_texts(chosen, {"text": "fingerprint"}, ["doc_id"]))
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("id"))
    pairs = cut_lineage(similar_pairs(first.where("id IS NOT NULL"), threshold))
    groups = connected_components(pairs.select("a", "b"))
    classes = first.join(groups, first["id"] == groups["node"], "left").select(
        "fingerprint", F.coalesce("component", "id").alias("class_id")
    )
    return prints.join(classes, "fingerprint").select("doc_id", "fingerprint", "class_id")
