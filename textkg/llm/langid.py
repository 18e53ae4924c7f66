"""Language identification with string kernels.

A text is the set of its letter n-grams of 1 to 4 bytes (blended spectrum, presence only), hashed into a block of dimensions per length.
The kernel of two texts is the mean over lengths of the cosine of their sets. Landmark texts of every language give the Nyström
approximation; one-versus-rest kernel ridge regression is solved on it:

    (K_mn K_nm + lambda K_mm) a = K_mn Y,    scores = K(x, landmarks) a

Since the kernel is an inner product of set vectors scaled per length, K(x, landmarks) a = sum over lengths of X_n (L_n^T a) / |X_n|, so
batches of texts are scored by matrix products with one small folded matrix.

Training uses a bounded sample: per language at most `per_language` texts and `landmarks` of them as landmarks, by hash of the id. Texts
are taken whole. The driver gets the landmarks' sets as bits and kernel rows, whose size depends on these parameters alone.

Cases: a null text or one without a letter is `und` with score 0. Without training rows every text is `und`. Ties go to the language that
sorts first. Repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkg.llm.common import fold, handing_back

PER_LANGUAGE = 1024
LANDMARKS = 64
LENGTHS = (1, 2, 3, 4)
# Dimensions per n-gram length; a power of two each.
SIZES = (256, 1 << 14, 1 << 15, 1 << 16)
RIDGE = 1e-2
SHARPNESS = 4.0
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")
_BATCH = 64


def letters_of(text: str | None) -> bytes:
    """Lower-cased letters as UTF-8, with one blank around and between runs of letters."""
    return (" " + _OTHER.sub(" ", text or "").strip().lower() + " ").encode("utf-8", "replace")


def _grams(raw: bytes) -> list[np.ndarray]:
    """Per length, the dimensions that occur, with repetitions."""
    x = np.frombuffer(raw, np.uint8).astype(np.uint32)
    key, out = np.zeros(len(x), np.uint32), []
    for n, size in zip(LENGTHS, SIZES):
        key = x.copy() if n == 1 else (key[:-1] << np.uint32(8)) | x[n - 1 :]
        out.append(key if size == 256 else (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - size.bit_length() + 1))
    return out


def presence(texts: list[bytes], only: int | None = None) -> list[np.ndarray]:
    """Per length, a matrix with a row per text: 1 where an n-gram occurs, divided by the length of the row.

    `only` picks one length by its place.
    """
    chosen = slice(None) if only is None else slice(only, only + 1)
    blocks = [np.zeros((len(texts), size), np.float32) for size in SIZES[chosen]]
    for i, raw in enumerate(texts):
        for block, at in zip(blocks, _grams(raw)[chosen]):
            block[i, at] = 1
    for block in blocks:
        block /= np.maximum(np.sqrt(block.sum(axis=1, keepdims=True)), 1)
    return blocks


def kernel(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    return sum(x @ y.T for x, y in zip(a, b)) / len(LENGTHS)


def kernel_with_bits(texts: list[bytes], packed: list[bytes]) -> np.ndarray:
    """`kernel` of texts and landmarks given as bits, which are unpacked a length at a time.

    All lengths at once, and copies of them, would take some hundred MB in every worker.
    """
    bits = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
    total, begin = np.zeros((len(texts), len(packed)), np.float32), 0
    for n, size in enumerate(SIZES):
        marks = np.empty((len(packed), size), np.float32)
        for a in range(0, len(packed), _BATCH):
            part = marks[a : a + _BATCH]
            part[:] = np.unpackbits(bits[a : a + _BATCH, begin // 8 : (begin + size) // 8], axis=1)
            part /= np.maximum(np.sqrt(part.sum(axis=1, keepdims=True)), 1)
        total += presence(texts, n)[0] @ marks.T
        del marks, part  # before the next length takes its own
        begin += size
    return total / len(LENGTHS)


def labelled_sample(docs: DataFrame, folds: int, held_out: int, per_language: int, landmarks: int) -> DataFrame:
    """(doc_id, lang, landmark): a bounded sample of each language outside the held-out fold."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    known = known.filter((fold(F.col("doc_id"), folds) != held_out) & (F.col("lang") != UNKNOWN)).select("doc_id", "lang")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    return known.select("*", place.alias("n")).filter(F.col("n") <= per_language).select("doc_id", "lang", (F.col("n") <= landmarks).alias("landmark"))


def train(docs: DataFrame, sample: DataFrame, ridge: float = RIDGE) -> tuple[list[str], list[np.ndarray]]:
    """The languages and, per n-gram length, a matrix (dimensions x languages)."""
    chosen = sample.groupBy("doc_id").agg(F.min("lang").alias("lang"), F.max("landmark").alias("landmark"))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # its size is bounded by the parameters

    @handing_back
    def bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                seen = [np.zeros(size, bool) for size in SIZES]
                for s, at in zip(seen, _grams(letters_of(text))):
                    s[at] = True
                out.append(np.packbits(np.concatenate(seen)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["bits"])

    packed = [r.bits for r in rows.filter("landmark").select("text").mapInArrow(bits, "bits binary").collect()]
    if not packed:
        return [], []
    marks = np.unpackbits(np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1), axis=1).astype(np.float32)
    marks = [m / np.maximum(np.sqrt(m.sum(axis=1, keepdims=True)), 1) for m in np.split(marks, np.cumsum(SIZES)[:-1], axis=1)]
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    @handing_back
    def against(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _BATCH):
                part = batch.slice(a, _BATCH)
                k = kernel_with_bits([letters_of(t) for t in part.column(0).to_pylist()], shared.value)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(list(k), pa.list_(pa.float32()))], names=["lang", "k"])

    seen = rows.select("text", "lang").mapInArrow(against, "lang string, k array<float>").collect()
    languages = sorted({r.lang for r in seen})
    k_nm = np.array([r.k for r in seen], float)
    y = np.where(np.array([r.lang for r in seen])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    weight = np.array([1 / sum(r.lang == lang for r in seen) for lang in languages])[[languages.index(r.lang) for r in seen]]
    weight *= len(seen) / weight.sum()  # every language counts alike
    k_mm = kernel(marks, marks).astype(float)
    left = (k_nm * weight[:, None]).T @ k_nm + ridge * len(seen) / len(packed) * k_mm + 1e-8 * np.eye(len(packed))
    a = np.linalg.solve(left, (k_nm * weight[:, None]).T @ y)
    return languages, [(m.T @ a / len(LENGTHS)).astype(np.float32) for m in marks]


def identify_languages(
    docs: DataFrame, folds: int = 5, held_out: int = 0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, carry: bool = False,
) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of `docs`, which also gives the training labels.

    With `carry` the whole input row comes along as the struct `row`.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    # a carried row holds the text already, so it is not sent a second time
    rows = docs.select(F.col(id_col).alias("doc_id"), F.struct(*docs.columns).alias("row")) if carry else plain.drop("lang")
    languages, folded = train(plain, labelled_sample(plain, folds, held_out, per_language, landmarks))
    shared = docs.sparkSession.sparkContext.broadcast((languages, folded))

    @handing_back
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, _BATCH):
                part = batch.slice(a, _BATCH)
                texts = (pc.struct_field(part.column(1), text_col) if carry else part.column(1)).to_pylist()
                known = np.array([bool(t and _LETTER.search(t)) for t in texts]) & bool(names)
                if names:
                    f = sum(x @ m for x, m in zip(presence([letters_of(t) for t in texts]), matrix))
                    e = np.exp(SHARPNESS * (f - f.max(axis=1, keepdims=True)))
                    best = f.argmax(axis=1)
                    p = np.where(known, (e / e.sum(axis=1, keepdims=True))[np.arange(len(f)), best], 0.0)
                    guess = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
                else:
                    p, guess = np.zeros(len(texts)), [UNKNOWN] * len(texts)
                kept = [part.column(i) for i in ((0, 1) if carry else (0,))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(guess, pa.string()), pa.array(p.astype(float))],
                    names=["doc_id", *["row"] * carry, "lang_pred", "score"],
                )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    row_type = f"row {rows.schema['row'].dataType.simpleString()}, " if carry else ""
    out = rows.mapInArrow(run, f"doc_id {id_type}, {row_type}lang_pred string, score double")
    return out.select("doc_id", *["row"] * carry, (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "lang_pred", "score")


def drop_unknown_language(docs: DataFrame, least: float = 0.0, **names: str) -> DataFrame:
    """The rows of `docs` with a known language and a score of at least `least`."""
    found = identify_languages(docs, carry=True, **names)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
