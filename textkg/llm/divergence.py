"""Source divergence audit with a vocabulary of minimal acyclic transducers.

1. Every text gives its distinct terms; per language the terms of at least `min_docs` documents are kept, sorted and numbered in the order of
   their UTF-8 bytes.
2. The kept terms of a language are dealt over buckets by hash, so that no bucket exceeds `bucket_terms` terms or `bucket_bytes` bytes. For each
   bucket a minimal acyclic transducer is built from its sorted terms: states with equal continuations are one, and every arc
   carries the number of terms before it, so reading a term sums up to its rank and from there to its ordinal.
3. The texts are read again and their terms, counted per partition, language and source, are sent to the buckets and streamed through the
   transducers, all terms of a group in step. Terms without a path fall out; the others are counted by ordinal. A bucket meets its
   streams in several shares, so frequent terms of a hot language or source don't pile up in one task.
4. Group probabilities and divergences are whole numbers. Sums over all kept terms are formed in blocks of consecutive ordinals with one
   row per group, terms that a group lacks included; ties are broken by ordinal, which is the order of the terms.

Cases: null text, lang and source are ''. Every row is a document of its own, repeated ones too. A group without terms, and a language
without kept terms, has its pairs (value 0 without kept terms) and no term rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkg.operators.ordinals import with_ordinal
from textkg.session import cut_lineage

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
BUCKET_TERMS = 1 << 16
BUCKET_BYTES = 4 << 20
SHARE_ENTRIES = 1 << 23
BLOCK_TERMS = 1 << 13
TILE_SOURCES = 256

# Texts read between two emissions of counts.
_FLUSH_BYTES = 32 << 20
_STREAM_ROWS = 1 << 15
_ROW_BYTES = 1 << 20

# Letters in lower case and all bytes of other code points; everything else separates terms.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text as UTF-8, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Transducer:
    """Minimal acyclic automaton of sorted terms whose arcs count the terms that sort before them."""

    def __init__(self, terms: list[bytes]):
        keys: list[int] = []
        targets: list[int] = []
        skips: list[int] = []
        finals: list[bool] = []
        sizes: list[int] = []
        register: dict[tuple, int] = {}

        def freeze(final: bool, arcs: list[tuple[int, int]]) -> int:
            shape = (final, *arcs)
            state = register.get(shape)
            if state is None:
                state = register[shape] = len(finals)
                size = int(final)
                for byte, target in arcs:
                    keys.append(state << 8 | byte)
                    targets.append(target)
                    skips.append(size)
                    size += sizes[target]
                finals.append(final)
                sizes.append(size)
            return state

        # the path of the last term: per depth whether a term ends there, and the arcs frozen so far
        path: list[list] = [[False, []]]
        last = b""
        for term in terms:
            shared = 0
            for a, b in zip(last, term):
                if a != b:
                    break
                shared += 1
            while len(path) > shared + 1:
                final, arcs = path.pop()
                path[-1][1].append((last[len(path) - 1], freeze(final, arcs)))
            path += [[False, []] for _ in range(len(term) - shared)]
            path[-1][0] = True
            last = term
        while len(path) > 1:
            final, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(final, arcs)))
        self.root = freeze(*path[0])
        self.keys = np.array(keys, np.int64)
        self.targets = np.array(targets, np.int64)
        self.skips = np.array(skips, np.int64)
        self.finals = np.array(finals, bool)

    def ranks(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The rank of each term of `raw` among the terms of the vocabulary, -1 for strangers; all terms advance in step."""
        n = len(bounds) - 1
        out = np.full(n, -1, np.int64)
        at, ends = bounds[:-1].copy(), bounds[1:]
        alive = np.arange(n)
        state = np.full(n, self.root, np.int64)
        rank = np.zeros(n, np.int64)
        while len(alive):
            done = at[alive] == ends[alive]
            stop = alive[done]
            out[stop] = np.where(self.finals[state[done]], rank[stop], -1)
            alive, state = alive[~done], state[~done]
            if not len(alive) or not len(self.keys):
                break
            key = state << 8 | raw[at[alive]]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            alive, arc = alive[hit], arc[hit]
            rank[alive] += self.skips[arc]
            state = self.targets[arc]
            at[alive] += 1
        return out


def _counted_parts(
    batches: Iterable[pa.RecordBatch], n_groups: int, per_document: bool
) -> Iterator[tuple[tuple, list[bytes], np.ndarray, np.ndarray]]:
    """(group, terms, their lengths, counts) of the texts in the column after the group columns, often enough to bound the memory."""

    def parts(counts: dict[tuple, Counter]) -> Iterator[tuple[tuple, list[bytes], np.ndarray, np.ndarray]]:
        for group, found in counts.items():
            terms, numbers = list(found.keys()), np.fromiter(found.values(), np.int64, len(found))
            lengths = np.fromiter(map(len, terms), np.int64, len(terms))
            ends = np.cumsum(lengths)
            begin = 0
            while begin < len(terms):
                full = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _ROW_BYTES))
                end = min(max(full, begin + 1), begin + _STREAM_ROWS, len(terms))
                yield group, terms[begin:end], lengths[begin:end], numbers[begin:end]
                begin = end

    counts: dict[tuple, Counter] = {}
    seen = 0
    for batch in batches:
        groups = zip(*[batch.column(i).to_pylist() for i in range(n_groups)])
        for group, value in zip(groups, batch.column(n_groups)):
            text = value.as_py()
            found = terms_of(text)
            counts.setdefault(group, Counter()).update(set(found) if per_document else found)
            seen += len(text) + 64
            if seen >= _FLUSH_BYTES:
                yield from parts(counts)
                counts, seen = {}, 0
    yield from parts(counts)


def _plain(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]
    return docs.select(*[c.alias(n) for c, n in zip(filled, ("lang", "source", "text"))])


def _document_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (lang,), terms, _, numbers in _counted_parts(batches, 1, per_document=True):
        columns = [pa.array([lang] * len(terms), pa.string()), pa.array(terms, pa.binary()), pa.array(numbers)]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "term", "n"])


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, n_docs, ordinal): the terms of at least `min_docs` documents of a language; ordinals rise with (lang, term bytes)."""
    counted = docs.select("lang", "text").mapInArrow(_document_counts, "lang string, term binary, n long")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("n_docs")).where(F.col("n_docs") >= min_docs)
    return with_ordinal(kept, ["lang", "term"])


def _streams(buckets: int, shares: int):
    """Counted terms of texts as rows (lang, source, bucket, share, terms, lengths, n), packed per bucket."""
    names = ["lang", "source", "bucket", "share", "terms", "lengths", "n"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ((lang, source), terms, lengths, n) in enumerate(_counted_parts(batches, 2, per_document=False)):
            hashes = np.fromiter(map(zlib.crc32, terms), np.int64, len(terms))
            order = np.argsort(hashes % buckets, kind="stable")
            bucket = (hashes % buckets)[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(terms)]])
            sorted_terms = [terms[i] for i in order.tolist()]
            rows = len(cuts) - 1
            # one share for all terms of a part, another one for the next
            share = (int(hashes[0]) + number) % shares
            offsets = pa.array(cuts, pa.int32())
            columns = [
                pa.array([lang] * rows, pa.string()),
                pa.array([source] * rows, pa.string()),
                pa.array(bucket[cuts[:-1]], pa.int32()),
                pa.array([share] * rows, pa.int32()),
                pa.array([b"".join(sorted_terms[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(lengths[order], pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(n[order], pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _recounted(vocabulary: pa.Table, streams: pa.Table) -> pa.Table:
    """(lang, source, ordinal, n) of one bucket of a language."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("n", pa.int64())])
    if not vocabulary.num_rows or not streams.num_rows:
        return schema.empty_table()
    vocabulary = vocabulary.sort_by("ordinal")
    transducer = Transducer(vocabulary.column("term").to_pylist())
    ordinals = vocabulary.column("ordinal").to_numpy()
    sources = streams.column("source").combine_chunks().dictionary_encode()
    keys, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    columns = (streams.column(c) for c in ("terms", "lengths", "n"))
    for source, terms, lengths, n in zip(sources.indices.to_pylist(), *columns):
        bounds = np.concatenate([[0], np.cumsum(lengths.values.to_numpy(), dtype=np.int64)])
        rank = transducer.ranks(np.frombuffer(terms.as_py(), np.uint8), bounds)
        hit = rank >= 0
        keys.append(source * len(ordinals) + rank[hit])
        numbers.append(n.values.to_numpy()[hit])
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, np.concatenate(numbers))
    lang, names = vocabulary.column("lang")[0].as_py(), sources.dictionary
    return pa.Table.from_arrays(
        [
            pa.array([lang] * len(found), pa.string()), names.take(pa.array(found // len(ordinals))),
            pa.array(ordinals[found % len(ordinals)], pa.int64()), pa.array(total, pa.int64()),
        ],
        schema=schema,
    )


def recount(docs: DataFrame, kept: DataFrame, bucket_terms: int = BUCKET_TERMS, share_entries: int = SHARE_ENTRIES) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of every kept term of a language in each group, where there are any."""
    size = kept.agg(F.count("*"), F.sum(F.octet_length("term")), F.sum("n_docs")).first()
    buckets = max(1, -(-size[0] // bucket_terms), -(-(size[1] or 0) // BUCKET_BYTES))
    # the kept terms of all documents bound what is streamed of them
    shares = max(1, -(-(size[2] or 0) // (buckets * share_entries)))
    bucket = F.expr(f"cast(crc32(term) % {buckets} AS int)")
    all_shares = F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
    left = kept.select("lang", "term", "ordinal", bucket.alias("bucket"), all_shares.alias("share"))
    right = docs.select("lang", "source", "text").mapInArrow(
        _streams(buckets, shares),
        "lang string, source string, bucket int, share int, terms binary, lengths array<int>, n array<long>",
    )
    keys = ("lang", "bucket", "share")
    counted = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _recounted, "lang string, source string, ordinal long, n long"
    )
    return counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)) in whole numbers of any size."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    below = (total + terms).cast("decimal(20,0)")
    # the remainder is taken off first, so the division is exact
    wide = ((above - above % below) / below).cast("bigint")
    # the product of most counts fits a machine word
    narrow = F.call_function("div", F.lit(SCALE).cast("bigint") * (count + 1), total + terms)
    return F.when(count < (1 << 62) // SCALE, narrow).otherwise(wide) + 1


def _tile_sums(block_terms: int, tile_sources: int):
    """Sums over the terms of one block of the divergences between the groups of two tiles."""

    def probabilities(part: pa.Table, tile: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        own = part.filter(pc.equal(part.column("tile"), tile))
        head = own.filter(pc.is_null(own.column("local")))
        groups = head.column("position").to_numpy()
        below = (head.column("total").to_numpy() + head.column("n_terms").to_numpy())[:, None]
        row = np.full(tile_sources, -1)
        row[groups % tile_sources] = np.arange(len(groups))
        counts = np.zeros((len(groups), width), np.int64)
        body = own.filter(pc.is_valid(own.column("local")))
        counts[row[body.column("position").to_numpy() % tile_sources], body.column("local").to_numpy()] = body.column("n").to_numpy()
        if int(counts.max(initial=0)) < (1 << 62) // SCALE:
            return groups, 1 + SCALE * (counts + 1) // below
        return groups, (1 + SCALE * (counts.astype(object) + 1) // below.astype(object)).astype(np.int64)

    def run(key: tuple, part: pa.Table) -> pa.Table:
        lang, block, first, second = (k.as_py() for k in key)
        width = min(block_terms, part.column("n_terms")[0].as_py() - block * block_terms)
        rows, p = probabilities(part, first, width)
        columns, q = (rows, p) if first == second else probabilities(part, second, width)
        a, b, value = [], [], []
        for i, mine in zip(rows.tolist(), p):
            gap = mine[None, :] - q
            a.append(np.full(len(columns), i))
            b.append(columns)
            value.append((gap * gap // q).sum(axis=1))
        a, b, value = (np.concatenate(c) for c in (a, b, value))
        return pa.Table.from_arrays(
            [pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(value, pa.int64())],
            names=["lang", "a", "b", "value"],
        )

    return run


def _pair_sums(counts: DataFrame, groups: DataFrame, block_terms: int, tile_sources: int) -> DataFrame:
    """(lang, a, b, value): the sum over all kept terms for the groups at positions a and b of a language.

    The two sides of a pair are tiles of at most `tile_sources` groups, so a task holds two tiles times a block of terms.
    """
    side = groups.select(
        "lang", "source", "position", "total", "n_terms", "first_ordinal",
        F.floor(F.col("position") / tile_sources).cast("int").alias("tile"), "n_tiles",
    ).where("n_terms > 0")
    place = F.col("ordinal") - F.col("first_ordinal")
    body = counts.join(side, ["lang", "source"]).select(
        "lang", "position", "total", "n_terms", "tile", "n_tiles", F.expr(f"(ordinal - first_ordinal) div {block_terms}").alias("block"),
        (place % block_terms).alias("local"), "n",
    )
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n_terms - 1) div {block_terms}")))
    heads = side.select(
        "lang", "position", "total", "n_terms", "tile", "n_tiles", blocks.alias("block"),
        F.lit(None).cast("bigint").alias("local"), F.lit(None).cast("bigint").alias("n"),
    )
    partner = F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)).alias("partner")
    met = body.unionByName(heads).select("*", partner)
    # a row stands on both sides of a pair of tiles; within its own tile once is enough
    sides = F.when(F.col("tile") == F.col("partner"), F.array(F.struct("tile", F.col("partner").alias("other")))).otherwise(
        F.array(F.struct("tile", F.col("partner").alias("other")), F.struct(F.col("partner").alias("tile"), F.col("tile").alias("other")))
    )
    dealt = met.select("*", F.explode(sides).alias("s")).select(
        "lang", "block", F.col("s.tile").alias("first"), F.col("s.other").alias("second"), "tile", "position", "total", "n_terms",
        "local", "n",
    )
    sums = dealt.groupBy("lang", "block", "first", "second").applyInArrow(
        _tile_sums(block_terms, tile_sources), "lang string, a long, b long, value long"
    )
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit_sources(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS, bucket_terms: int = BUCKET_TERMS, share_entries: int = SHARE_ENTRIES, block_terms: int = BLOCK_TERMS,
    tile_sources: int = TILE_SOURCES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from the others, and its marked terms."""
    plain = _plain(docs, text_col, lang_col, source_col)
    kept = cut_lineage(kept_terms(plain, min_docs))
    counts = cut_lineage(recount(plain, kept, bucket_terms, share_entries))
    vocabularies = kept.groupBy("lang").agg(F.count("*").alias("n_terms"), F.min("ordinal").alias("first_ordinal"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    in_language = Window.partitionBy("lang")
    groups = cut_lineage(
        plain.select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left").join(vocabularies, "lang", "left").na.fill(0)
        .select(
            "*", (F.row_number().over(in_language.orderBy("source")) - 1).cast("bigint").alias("position"),
            F.sum("total").over(in_language).alias("lang_total"),
            F.ceil(F.count("*").over(in_language) / tile_sources).cast("int").alias("n_tiles"),
        )
    )
    one, other = groups.alias("x"), groups.alias("y")
    pairs = (
        one.join(other, F.expr("x.lang = y.lang AND x.source <> y.source"))
        .select("x.lang", "x.source", F.col("y.source").alias("item"), F.col("x.position").alias("a"), F.col("y.position").alias("b"))
        .join(_pair_sums(counts, groups, block_terms, tile_sources), ["lang", "a", "b"], "left")
        .select(
            "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("bigint")).alias("value"),
        )
    )
    by_value = Window.partitionBy("lang", "source")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value.orderBy(F.desc("value"), "item")))
    marked = (
        counts.withColumn("lang_n", F.sum("n").over(Window.partitionBy("lang", "ordinal")))
        .join(groups.select("lang", "source", "total", "lang_total", "n_terms"), ["lang", "source"])
        .withColumn("p", _probability(F.col("n"), F.col("total"), F.col("n_terms")))
        .withColumn("q", _probability(F.col("lang_n"), F.col("lang_total"), F.col("n_terms")))
        .where("p > q")
        .select("lang", "source", "ordinal", F.expr("((p - q) * (p - q)) div q").alias("value"))
        .withColumn("rank", F.row_number().over(by_value.orderBy(F.desc("value"), "ordinal")))
        .where(F.col("rank") <= top_terms)
    )
    terms = marked.join(kept.select("ordinal", F.col("term").cast("string").alias("item")), "ordinal").select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank"
    )
    return pairs.select(*terms.columns).unionByName(terms)


AUDIT_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
o AS (SELECT r, lang, source, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (
  SELECT g.lang, g.source, coalesce(t.n, 0) AS total, coalesce(v.v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source) t USING (lang, source) LEFT JOIN v USING (lang)),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + ({SCALE} * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (
  SELECT lang, term, 1 + ({SCALE} * (n + 1)) // (total + v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term)
  JOIN (SELECT lang, sum(total) AS total, max(v) AS v FROM g GROUP BY lang) USING (lang)),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
x AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
y AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(((p.p - q.q) * (p.p - q.q)) // q.q AS BIGINT) AS value
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM x
UNION ALL
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM y)
WHERE rank <= {TOP_TERMS}"""
