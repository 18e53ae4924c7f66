"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A text is written as its lower-cased words with one blank between them and a line end behind the last. Each byte is eight binary
decisions. At every node (the last 0 to 5 bytes and the decisions made so far) the training counts give a Krichevsky-Trofimov
estimate, and the tree weighting P_w = (P_e + product of the children's P_w) / 2 gives the share of each depth in the mixture.

1. Counts of byte strings of length 6 come from all training texts: sorted in each task, summed by Spark. They grow with the corpus.
2. The strings are grouped by the two bytes before the predicted one. Each group builds its part of the tree bottom-up as arrays and
   mixes depth 5 to 2 for each of its strings. Above that a byte joins its groups and the root the bytes: 65,792 nodes at most.
3. So every string of the corpus is scored once, with all nodes of the tree. The scores of the most frequent strings (at most
   `top_strings`) travel to the texts, all others meet their documents in a join.

The tree spells out words it has never met, where the base counts all of them as one. `score` weights both as the tree weights its nodes:
P = (P_base + P_tree) / 2 of the whole text, so it lies at most log10(2) below the better of the two. `tree_score` is the tree alone.

The base figures are exact. Word counts are summed by Spark; the most frequent words (at most 200,000) travel with the model, all
others meet their documents in a join.

Cases: a null or empty text is the end token alone. Repeated rows are scored each. Without training rows every count is 0 and each
bit has probability 1/2 in the tree. Invalid ids count as the text of the id, null as the empty text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkg.llm.common import byte_slices, fold, lower_words
from textkg.session import cut_lineage, release

DEPTH = 5
_CHUNK = 2 << 20
_COUNTED = 16 << 20
TOP_WORDS = 200_000
TOP_STRINGS = 1 << 21


def _streams(texts: list[str], chunk: int = _CHUNK) -> Iterator[tuple[np.ndarray, list[int], list[list[bytes]]]]:
    """Chunks of padded byte streams, the length of each stream without its padding, and the words of each text."""
    parts, sizes, words, total = [], [], [], 0
    for t in texts:
        w = lower_words(t)
        body = b" ".join(w) + b"\n"
        parts.append(b"\n" * DEPTH + body)
        sizes.append(len(body))
        words.append(w)
        total += len(body)
        if total >= chunk:
            yield np.frombuffer(b"".join(parts), np.uint8), sizes, words
            parts, sizes, words, total = [], [], [], 0
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), sizes, words


def _strings(stream: np.ndarray, sizes: list[int]) -> np.ndarray:
    """For each byte of each stream: the 5 bytes before it, the nearest highest, then the byte itself."""
    x = stream.astype(np.int64)
    n = len(x) - DEPTH
    key = np.zeros(n, np.int64)
    for back in range(1, DEPTH + 1):
        key = (key << 8) | x[DEPTH - back : DEPTH - back + n]
    key = (key << 8) | x[DEPTH:]
    real = np.ones(n, bool)
    for start in np.cumsum([s + DEPTH for s in sizes])[:-1]:
        real[start - DEPTH : start] = False  # padding of the next stream
    return key[real]


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving the argument above 8."""
    y, shift = x.astype(float).copy(), np.zeros(len(x))
    for _ in range(8):
        low = y < 8
        shift[low] -= np.log(y[low])
        y[low] += 1
    r = 1 / (y * y)
    return shift + (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r / 1260)) / y


def _sum_by(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], *[np.add.reduceat(w[order], heads) if len(heads) else w[:0] for w in weights]


def _decisions(symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of one depth from (context << 8 | byte) and counts: (context << 8 | place in the binary tree), zeros, ones."""
    context, byte = symbols >> 8 << 8, symbols & 255
    nodes = [context | (1 << level) | (byte >> (8 - level)) for level in range(8)]
    ones = [counts * (byte >> (7 - level) & 1) for level in range(8)]
    nodes, total, one = _sum_by(np.concatenate(nodes), np.tile(counts, 8), np.concatenate(ones))
    return nodes, total - one, one


def _joined(place: np.ndarray, n0: np.ndarray, n1: np.ndarray, log_w: np.ndarray) -> tuple[np.ndarray, ...]:
    """One node from its children: place, zeros, ones, log P_w, probability of a one, own share in the mixture."""
    place, n0, n1, below = _sum_by(place, n0, n1, log_w)
    own = _log_kt(n0, n1)
    share = 1 / (1 + np.exp(np.clip(below - own, -700, 700)))
    return place, n0, n1, np.logaddexp(own, below) - np.log(2), (n1 + 0.5) / (n0 + n1 + 1), share


def grow_branch(strings: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """The tree above the two last bytes, grown from strings with counts: for each string the chance of a one at each of its 8
    decisions as depth 5 to 2 mix it (nan: no such node), and (place, zeros, ones, log P_w) of depth 2."""
    byte, learnt = strings & 255, counts > 0
    places = [(1 << level) | (byte >> (8 - level)) for level in range(8)]
    mixed = np.full((len(strings), 8), np.nan)
    deeper = None
    for depth in range(DEPTH, 1, -1):
        context = strings >> (48 - 8 * depth) << 8
        symbols, n = _sum_by((context | byte)[learnt], counts[learnt])
        nodes, n0, n1 = _decisions(symbols, n)
        own = _log_kt(n0, n1)
        if deeper is None:
            log_w, share = own, np.ones(len(nodes))
        else:
            parent = (deeper[0] >> 16 << 8) | (deeper[0] & 255)
            below = np.bincount(np.searchsorted(nodes, parent), weights=deeper[1], minlength=len(nodes))
            log_w = np.logaddexp(own, below) - np.log(2)
            share = 1 / (1 + np.exp(np.clip(below - own, -700, 700)))
        if not len(nodes):
            break
        p = (n1 + 0.5) / (n0 + n1 + 1)
        for level, place in enumerate(places):
            at = np.minimum(np.searchsorted(nodes, context | place), len(nodes) - 1)
            _mix(mixed[:, level], nodes[at] == (context | place), p[at], share[at])
        deeper = (nodes, log_w)
    return mixed, (nodes & 255, n0, n1, log_w)


def _mix(mixed: np.ndarray, known: np.ndarray, p: np.ndarray, share: np.ndarray) -> None:
    """Weight a node into what lies above it in the tree, in place; where nothing deeper is known, its estimate stands alone."""
    own = np.where(np.isnan(mixed), p, share * p + (1 - share) * mixed)
    np.copyto(mixed, own, where=known)


def gather_strings(docs: DataFrame, text_col: str, learnt: Column | None = None) -> DataFrame:
    """(last, string, n, seen): how often each byte string occurs in the texts to learn from (all, unless said) and in all texts.
    `last` are the two bytes before the predicted one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in byte_slices(whole, 0, 2 * _CHUNK)):
            for flag in (True, False):
                texts = batch.column(0).filter(pc.equal(batch.column(1), flag)).to_pylist()
                for stream, sizes, _ in _streams([t or "" for t in texts], 2 * _CHUNK):
                    found = np.sort(_strings(stream, sizes))
                    heads = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
                    seen = np.diff(np.append(heads, len(found)))
                    for a in range(0, len(heads), 1 << 16):  # batches stay small in the JVM
                        part, k = found[heads[a : a + (1 << 16)]], seen[a : a + (1 << 16)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array((part >> 32).astype(np.int32)), pa.array(part), pa.array(k * flag), pa.array(k)],
                            names=["last", "string", "n", "seen"],
                        )

    rows = docs.select(text_col, (F.lit(True) if learnt is None else learnt).alias("learnt"))
    return (
        rows.mapInArrow(run, "last int, string long, n long, seen long")
        .groupBy("last", "string").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    )


def train(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The model: the counts of all byte strings of the texts, written once."""
    return cut_lineage(gather_strings(docs, text_col))


def score_strings(counts: DataFrame) -> DataFrame:
    """(string, seen, value): log10 of the probability of the last byte of each string after the bytes before it, under the tree of
    all rows (last, string, n, seen). Rows with n = 0 are scored only."""

    def branch(table: pa.Table) -> pa.Table:
        table = table.sort_by("string")
        strings = table["string"].to_numpy()
        mixed, top = grow_branch(strings, table["n"].to_numpy().astype(float))
        rows = len(strings)
        chances = pa.Array.from_buffers(
            pa.binary(), rows, [None, pa.py_buffer(np.arange(0, 64 * rows + 1, 64, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(mixed))]
        )
        above = pa.nulls(rows - 1, pa.binary()).to_pylist() + [np.array(top, float).tobytes()]  # the nodes of depth 2 go with the last string
        return pa.table({"string": table["string"], "seen": table["seen"], "chances": chances, "top": pa.array(above, pa.binary())})

    def joined(table: pa.Table) -> pa.Table:
        tops = [np.frombuffer(d, float).reshape(4, -1) for d in table["top"].to_pylist()]
        nodes = np.array(_joined(*np.concatenate(tops, axis=1)))
        return pa.table({"last": pa.array([table["last"][0].as_py()], pa.int32()), "nodes": pa.array([nodes.tobytes()], pa.binary())})

    spark = counts.sparkSession
    parts = cut_lineage(counts.groupBy("last").applyInArrow(branch, "string long, seen long, chances binary, top binary"))
    tops = parts.filter(F.col("top").isNotNull()).select(F.shiftright("string", 40).cast("int").alias("last"), "top")
    upper = {d: (np.zeros(256 << (8 * d), bool), np.zeros(256 << (8 * d)), np.zeros(256 << (8 * d))) for d in (0, 1)}

    def put(depth: int, nodes: np.ndarray, p: np.ndarray, share: np.ndarray) -> None:
        for into, values in zip(upper[depth], (True, p, share)):
            into[nodes.astype(np.int64)] = values

    below = []
    for row in tops.groupBy("last").applyInArrow(joined, "last int, nodes binary").collect():  # at most 256 rows of 255 nodes
        place, n0, n1, log_w, p, share = np.frombuffer(row["nodes"], float).reshape(6, -1)
        put(1, (row["last"] << 8) + place, p, share)
        below.append((place, n0, n1, log_w))
    if below:
        place, _, _, _, p, share = _joined(*np.concatenate(below, axis=1))
        put(0, place, p, share)
    shared = spark.sparkContext.broadcast(upper)

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = batch.column(0).to_numpy()
            mixed = np.frombuffer(b"".join(batch.column(2).to_pylist()), float).reshape(-1, 8).copy()
            byte, value = strings & 255, np.zeros(len(strings))
            for level in range(8):
                place, chance = (1 << level) | (byte >> (8 - level)), mixed[:, level]
                for depth, nodes in ((1, strings >> 40 << 8 | place), (0, place)):
                    known, p, share = shared.value[depth]
                    _mix(chance, known[nodes], p[nodes], share[nodes])
                chance = np.where(np.isnan(chance), 0.5, chance)
                value += np.log10(np.where(byte >> (7 - level) & 1, chance, 1 - chance))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value)], names=["string", "seen", "value"])

    scored = cut_lineage(parts.select("string", "seen", "chances").mapInArrow(finish, "string long, seen long, value double"))
    release(parts)
    return scored


def log10_of_strings(model: DataFrame, strings: np.ndarray) -> np.ndarray:
    """log10 of the probability of the last byte of each string after the bytes before it, for strings at hand."""
    distinct, place = np.unique(strings, return_inverse=True)
    asked = model.sparkSession.createDataFrame([(int(s) >> 32, int(s), 0, 1) for s in distinct], model.schema)
    both = model.withColumn("seen", F.lit(0).cast("bigint")).unionByName(asked)
    scored = score_strings(both.groupBy("last", "string").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")))
    value = dict(scored.filter("seen > 0").select("string", "value").collect())
    return np.array([value[s] for s in distinct.tolist()])[place]


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, c) of all words of the texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in byte_slices(whole, 0, _COUNTED)):
            counts: Counter[bytes] = Counter()
            for t in batch.column(0).to_pylist():
                counts.update(lower_words(t))
            words, n = list(counts), list(counts.values())
            for a in range(0, len(words), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[a : a + (1 << 16)], pa.binary()), pa.array(n[a : a + (1 << 16)], pa.int64())], names=["word", "c"]
                )

    return docs.select(text_col).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _least(counts: DataFrame, c: str, limit: int) -> int | None:
    """The smallest count that at most `limit` rows reach."""
    above, least = 0, None
    for n_times, n in sorted(counts.groupBy(c).agg(F.count("*")).collect(), reverse=True):  # distinct counts: about the root of the corpus
        if above + n > limit:
            break
        above, least = above + n, n_times
    return least


def _frequent(counts: DataFrame, limit: int) -> dict[bytes, float]:
    """log10(c + 1) of all words above the count that at most `limit` words exceed."""
    least = _least(counts, "c", limit)
    return {bytes(w): math.log10(c + 1.0) for w, c in counts.filter(F.col("c") >= least).toLocalIterator()} if least else {}


def _frequent_strings(scored: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The strings seen most often, sorted, and their values; at most `limit`."""
    least = _least(scored, "seen", limit)
    if not least:
        return np.zeros(0, np.int64), np.zeros(0)
    table = scored.filter(F.col("seen") >= least).select("string", "value").toArrow()
    strings, value = table["string"].to_numpy(), table["value"].to_numpy()
    order = np.argsort(strings)
    return strings[order], value[order]


def score_documents(
    docs: DataFrame, folds: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text", top_words: int = TOP_WORDS,
    top_strings: int = TOP_STRINGS,
) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out fold."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (fold(F.col(id_col), folds) == held_out).alias("held_out"))
    training = rows.filter(~F.col("held_out"))
    counts = cut_lineage(word_counts(training, "text"))
    n_words, n_distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = training.count()
    total, distinct = n_words + ends, n_distinct + (ends > 0)
    values = score_strings(gather_strings(rows, "text", ~F.col("held_out")))
    shared = docs.sparkSession.sparkContext.broadcast((_frequent_strings(values, top_strings), _frequent(counts, top_words)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known_strings, known_values), known_words = shared.value
        part, nth = TaskContext.get().partitionId(), 0
        for batch in (piece for whole in batches for piece in byte_slices(whole, 1, _CHUNK)):
            at = 0
            for stream, sizes, words in _streams([t or "" for t in batch.column(1).to_pylist()]):
                strings = _strings(stream, sizes)
                distinct_here, inverse = np.unique(strings, return_inverse=True)
                place = np.searchsorted(known_strings, distinct_here)
                place[place == len(known_strings)] = 0
                hit = known_strings[place] == distinct_here if len(known_strings) else np.zeros(len(distinct_here), bool)
                value = np.zeros(len(distinct_here))
                value[hit] = known_values[place[hit]]
                begins = np.cumsum(sizes) - sizes
                scores = np.add.reduceat(value[inverse], begins)
                missed = np.flatnonzero(~hit[inverse])
                strings_at = np.searchsorted(missed, np.append(begins, len(strings))).astype(np.int32)
                known, log_sum, rest, rest_counts, ends_at = [], [], [], [], [0]
                for w in words:
                    logs = list(map(known_words.get, w))
                    found = [v for v in logs if v]
                    other = Counter(x for x, v in zip(w, logs) if v is None) if len(found) < len(w) else {}
                    known.append(len(found) + (ends > 0))
                    log_sum.append(sum(found) + math.log10(ends + 1.0))
                    rest += other
                    rest_counts += other.values()
                    ends_at.append(len(rest))
                n = len(words)
                others = pa.StructArray.from_arrays([pa.array(rest, pa.binary()), pa.array(rest_counts, pa.int64())], ["word", "k"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(nth, nth + n, dtype=np.int64) + (part << 40)),
                        batch.column(0).slice(at, n), batch.column(2).slice(at, n),
                        pa.array([len(w) + 1 for w in words], pa.int64()), pa.array(known, pa.int64()), pa.array(log_sum, pa.float64()),
                        pa.array(scores, pa.float64()), pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), others),
                        pa.ListArray.from_arrays(pa.array(strings_at), pa.array(strings[missed])),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "log_sum", "found", "rest", "rare"],
                )
                at, nth = at + n, nth + n

    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = cut_lineage(
        rows.select("doc_id", "text", "held_out").mapInArrow(
            run,
            f"row long, doc_id {id_type}, held_out boolean, n_tokens long, known long, log_sum double, found double, "
            "rest array<struct<word: binary, k: long>>, rare array<long>",
        )
    )
    rest = scored.select("row", F.explode("rest").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.k").alias("k"))
    met = rest.join(counts, "word").groupBy("row").agg(
        F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("more_log")
    )
    rare = scored.select("row", F.explode("rare").alias("string"))
    spelled = rare.join(values.select("string", "value"), "string").groupBy("row").agg(F.sum("value").alias("more_tree"))
    base = F.col("log_sum") + F.coalesce("more_log", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))
    tree = F.col("found") + F.coalesce("more_tree", F.lit(0.0))
    better, gap = F.greatest("base_score", "tree_score"), F.abs(F.col("base_score") - F.col("tree_score"))
    return scored.drop("rest", "rare").join(met, "row", "left").join(spelled, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), base.alias("base_score"), tree.alias("tree_score"),
    ).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
        (better + F.log10((F.pow(F.lit(10.0), -gap) + 1.0) / 2.0)).alias("score"), "tree_score",
    )
