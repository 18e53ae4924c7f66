"""Fill-in-middle transformation by displacement scatter.

A text is cut into tokens (`[A-Za-z]+` or one other code point). Two hashes of the id choose the cuts between prefix, middle and suffix, two
more choose the form. All texts of a slice lie in one array of bytes: scans over it find the cuts, a difference array holds at the first
byte of every piece how much its displacement differs from that of the piece before, the running sum of it is the displacement of
every byte, and one scatter writes the outputs. `restore_texts` finds the marks in an output and builds the same kind of array the other way
round: the running sum then says from where each byte of the text is gathered.

The arrays are worked off in tiles, so besides a text and its output only one flag per byte and a few tiles are held.

Cases: a null text is the empty one; an empty text, and one that holds a mark itself, stay plain. A missing id hashes as the empty string.
Repeated rows get equal outputs. No column but id and text is read. No shuffle takes place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkg.llm.common import byte_slices, strings_of, utf8_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK_BYTES = 3
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)

PLAIN_PERCENT = 10
SPM_PERCENT = 20
_SLICE_BYTES = 4 << 20
_TILE = 1 << 18
_BLOCK = 4096

_LETTER, _INNER = 1, 2  # classes of bytes: ASCII letters, bytes inside a code point
_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = _CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[0x80:0xC0] = _INNER


class Marked:
    """Counting and finding among the set flags of a long array, with one sum per block of it."""

    def __init__(self, flags: np.ndarray):
        self.flags = flags
        sums = np.add.reduceat(flags, np.arange(0, len(flags), _BLOCK), dtype=np.int64) if len(flags) else []
        self.before_block = np.concatenate([[0], np.cumsum(sums)]).astype(np.int64)

    def before(self, places: np.ndarray) -> np.ndarray:
        """How many flags are set before each place."""
        blocks = places // _BLOCK
        inside = [np.count_nonzero(self.flags[b * _BLOCK : p]) for b, p in zip(blocks.tolist(), places.tolist())]
        return self.before_block[blocks] + np.array(inside, np.int64)

    def find(self, ranks: np.ndarray) -> np.ndarray:
        """Where the flag of each rank stands, counted from 0."""
        blocks = np.searchsorted(self.before_block, ranks, side="right") - 1
        rest = ranks - self.before_block[blocks]
        out = [
            b * _BLOCK + np.flatnonzero(self.flags[b * _BLOCK : (b + 1) * _BLOCK])[r] for b, r in zip(blocks.tolist(), rest.tolist())
        ]
        return np.array(out, np.int64)


def displacements(begins: np.ndarray, targets: np.ndarray, total: int) -> Iterator[tuple[int, np.ndarray]]:
    """Tile by tile, the place that each of `total` bytes is paired with.

    Pieces begin at `begins`, in rising order, and are paired with places from `targets` on. Empty pieces may share a begin: their
    differences add up, and the last one of them holds.
    """
    change = np.diff(targets - begins, prepend=0)
    carry = 0
    for at in range(0, total, _TILE):
        end = min(at + _TILE, total)
        lo, hi = np.searchsorted(begins, [at, end], side="left")
        difference = np.zeros(end - at, np.int64)
        np.add.at(difference, begins[lo:hi] - at, change[lo:hi])
        difference[0] += carry
        shift = np.cumsum(difference)
        carry = int(shift[-1])
        yield at, shift + np.arange(at, end)


def _mark_places(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where marks begin, and the text each lies in."""
    at = np.flatnonzero(raw == PREFIX[0])
    at = at[at + MARK_BYTES <= len(raw)]
    names = np.isin(raw[at + 1], [m[1] for m in (PREFIX, SUFFIX, MIDDLE)])
    at = at[names & (raw[at + 2] == PREFIX[2])]
    owner = np.searchsorted(bounds, at, side="right") - 1
    whole = at + MARK_BYTES <= bounds[owner + 1]
    return at[whole], owner[whole]


def _hashes(doc_id, salt: str) -> tuple[int, int, int, int]:
    text = f"{salt}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(text.encode()).digest()
    return tuple(int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4))


def transform(ids: list, raw: np.ndarray, bounds: np.ndarray, salt: str) -> tuple[np.ndarray, ...]:
    """(n, form, prefix_chars, middle_chars, output bytes, output bounds) of the texts in `raw`."""
    kind = _CLASS[raw]
    begins, ends = bounds[:-1], bounds[1:]
    tokens = kind != _INNER
    chars = Marked(tokens.copy())
    tokens[1:] &= (kind[1:] != _LETTER) | (kind[:-1] != _LETTER)
    tokens[begins[begins < ends]] = True
    del kind
    units = Marked(tokens)
    before = units.before(bounds)
    n = np.diff(before)
    h = np.array([_hashes(i, salt) for i in ids], np.int64).reshape(len(ids), 4)
    low, high = np.sort(np.stack([h[:, 0] % (n + 1), h[:, 1] % (n + 1)]), axis=0)

    def place(unit: np.ndarray) -> np.ndarray:
        out = ends.copy()
        inner = unit < n
        out[inner] = units.find((before[:-1] + unit)[inner])
        return out

    form = np.where(h[:, 3] % 100 < SPM_PERCENT, SPM, PSM)
    form[(n == 0) | (h[:, 2] % 100 >= 100 - PLAIN_PERCENT)] = PLAIN
    form[_mark_places(raw, bounds)[1]] = PLAIN
    cut, resume = place(low), place(high)
    at_begin, at_cut, at_resume = chars.before(begins), chars.before(cut), chars.before(resume)
    marks = np.where(form == PLAIN, 0, 3 * MARK_BYTES)
    out_bounds = np.concatenate([[0], np.cumsum(ends - begins + marks)])
    start, p, m, s = out_bounds[:-1], cut - begins, resume - cut, ends - resume
    plain = form == PLAIN
    to_prefix = np.where(plain, start, start + np.where(form == SPM, 2 * MARK_BYTES + s, MARK_BYTES))
    to_suffix = np.where(plain, start + p + m, start + np.where(form == SPM, MARK_BYTES, 2 * MARK_BYTES + p))
    to_middle = np.where(plain, start + p, start + 3 * MARK_BYTES + p + s)
    out = np.empty(out_bounds[-1], np.uint8)
    pieces = np.stack([begins, cut, resume], axis=1).ravel()
    targets = np.stack([to_prefix, to_middle, to_suffix], axis=1).ravel()
    for at, to in displacements(pieces, targets, len(raw)):
        out[to] = raw[at : at + len(to)]
    for mark, target in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        for k in range(MARK_BYTES):
            out[target[~plain] - MARK_BYTES + k] = mark[k]
    return n, form, at_cut - at_begin, at_resume - at_cut, out, out_bounds


def restore(form: np.ndarray, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text bytes, text bounds) of the outputs in `raw`."""
    begins, ends = bounds[:-1], bounds[1:]
    plain = form == PLAIN
    at, owner = _mark_places(raw, bounds)
    at = at[~plain[owner]]
    if len(at) != 3 * np.count_nonzero(~plain):
        raise ValueError("an output does not hold each mark once")
    seen = at.reshape(-1, 3)
    want = np.array([[PREFIX[1], SUFFIX[1], MIDDLE[1]], [SUFFIX[1], PREFIX[1], MIDDLE[1]]], np.uint8)
    if not np.array_equal(raw[seen + 1], want[(form[~plain] == SPM).astype(int)]):
        raise ValueError("the marks of an output are not in the order of its form")
    first, second, third = (np.where(plain, ends, 0) for _ in range(3))
    first[~plain], second[~plain], third[~plain] = seen.T
    turned = form == SPM
    one, two, three = first + MARK_BYTES, second + MARK_BYTES, third + MARK_BYTES
    from_prefix = np.where(plain, begins, np.where(turned, two, one))
    from_suffix = np.where(plain, ends, np.where(turned, one, two))
    from_middle = np.where(plain, ends, three)
    p = np.where(plain, ends - begins, np.where(turned, third - two, second - one))
    s = np.where(plain, 0, np.where(turned, second - one, third - two))
    m = np.where(plain, 0, ends - three)
    text_bounds = np.concatenate([[0], np.cumsum(p + m + s)])
    start = text_bounds[:-1]
    pieces = np.stack([start, start + p, start + p + m], axis=1).ravel()
    sources = np.stack([from_prefix, from_middle, from_suffix], axis=1).ravel()
    text = np.empty(text_bounds[-1], np.uint8)
    for place, source in displacements(pieces, sources, len(text)):
        text[place : place + len(source)] = raw[source]
    return text, text_bounds


def _map(
    df: DataFrame, column: int, added: list[str], rows: Callable[[pa.RecordBatch], list[pa.Array]], dropped: tuple[str, ...] = ()
) -> DataFrame:
    """The columns of `df` without the dropped ones, then the `added` ones ("name type"); texts of `column` bound a slice."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in dropped] + added
    names = [f.name for f in df.schema.fields if f.name not in dropped] + [a.split()[0] for a in added]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, column, _SLICE_BYTES):
                yield pa.RecordBatch.from_arrays(rows(part), names=names)

    return df.mapInArrow(run, ", ".join(fields))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: str = "1") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): the transformed text of every row."""

    def rows(part: pa.RecordBatch) -> list[pa.Array]:
        ids = part.column(0).to_pylist()
        n, form, prefix, middle, out, bounds = transform(ids, *utf8_of(part.column(1)), salt)
        plain = form == PLAIN
        return [
            part.column(0),
            pa.array(n, pa.int64()),
            pa.array([FORMS[f] for f in form], pa.string()),
            pa.array(prefix, pa.int64(), mask=plain),
            pa.array(middle, pa.int64(), mask=plain),
            strings_of(out, bounds),
        ]

    added = ["n long", "form string", "prefix_chars long", "middle_chars long", "output string"]
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    return _map(chosen, 1, added, rows, dropped=("__text",))


def restore_texts(transformed: DataFrame, form_col: str = "form", output_col: str = "output") -> DataFrame:
    """The given rows with `restored`, the text rebuilt from form and output alone."""
    names = transformed.columns
    form_at, output_at = names.index(form_col), names.index(output_col)

    def rows(part: pa.RecordBatch) -> list[pa.Array]:
        form = np.array([FORMS.index(f) for f in part.column(form_at).to_pylist()], np.int64)
        return [*part.columns, strings_of(*restore(form, *utf8_of(part.column(output_at))))]

    return _map(transformed, output_at, ["restored string"], rows)


DIGEST_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS k,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
e AS (
  SELECT doc_id, t, k, CAST(len(k) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM e),
s AS (
  SELECT doc_id, t, n, form, array_to_string(k[1:a], '') AS p, array_to_string(k[a + 1:b], '') AS m,
         array_to_string(k[b + 1:n], '') AS x
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m
              ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s"""
