"""Byte-pair encoding and decoding with forced-boundary splitting.

A byte pair that occurs inside no token of the vocabulary can never be merged over, so a word is cut for certain between the
two bytes. The fragments are encoded independently of each other, all fragments of a batch at once as arrays: in each round
every fragment merges its pair of lowest rank, and a finished fragment leaves the working set. Ids of fragments are then
concatenated to words, and ids of words to texts.

Words between ASCII blanks are encoded once per batch. That is exact for this kind of tokenizer, whose pre-tokenizer drops
white space and never joins over it. Words of plain Latin letters are normalized here; words with other characters go
through the normalizer and the pre-tokenizer of the library, and special tokens inside a word are split off first, as the library
does.

Cases: a null or empty text has no ids and decodes to the empty text. Repeated rows are encoded each. A text is held whole, as
is a batch of texts, whose size `spark.sql.execution.arrow.maxRecordsPerBatch` bounds.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from textkg.llm.common import ragged

# Characters whose treatment is the same in every library: printable ASCII and precomposed Latin letters. Words with
# an apostrophe or a "<" may hold a contraction or a special token and take the other way.
_PLAIN = re.compile("[!-&(-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]*")
# Of bytes of plain words: 0 ends a word, 1 letter (also every byte of a non-ASCII letter), 2 digit, 3 another character.
_CLASS = np.array([0 if b == 10 else 2 if 48 <= b < 58 else 1 if b >= 128 or chr(b).isalpha() else 3 for b in range(256)], np.uint8)
# Characters of text encoded at once.
_BATCH_CHARS = 5 << 20


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = [""] * 256, 256
    for b in range(256):
        if b in printable:
            letters[b] = chr(b)
        else:
            letters[b], spare = chr(spare), spare + 1
    return letters


class Encoder:
    """Tables of one vocabulary file, as arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        suffix: str = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        letters = _byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        # ids of single bytes: inside a word, then at its end
        self.unit = np.array([vocab[c] for c in letters] + [vocab[c + suffix] for c in letters], np.int64)
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.size = size
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self._hash_pairs(left * size + right, np.array([vocab[a + b] for a, b in merges], np.int64))
        self.inside = self._inside_pairs(vocab, suffix)
        names = [b""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            names[i] = t.encode() + b" "
        self.name_at = np.concatenate([[0], np.cumsum([len(x) for x in names])])
        self.names = np.frombuffer(b"".join(names), np.uint8)

    def _hash_pairs(self, keys: np.ndarray, made: np.ndarray) -> None:
        """Open addressing with a bounded number of probes, so that a look-up is a few gathers."""
        bits = 18
        order = np.arange(len(keys))
        while True:
            slots, at = 1 << bits, self._slot(keys, bits)
            table = np.full(slots, -1, np.int64)
            rest, probes = order, 0
            while len(rest) and probes < 4:
                place = (at[rest] + probes) & (slots - 1)
                free = table[place] < 0
                first = np.zeros(len(rest), bool)
                candidates = np.flatnonzero(free)
                _, index = np.unique(place[candidates], return_index=True)
                first[candidates[index]] = True
                table[place[first]] = rest[first]
                rest, probes = rest[~first], probes + 1
            if not len(rest):
                break
            bits += 1
        self.bits, self.probes = bits, probes
        self.slot_key = np.where(table >= 0, keys[table], -1)
        self.slot_rank = table
        self.made = made

    @staticmethod
    def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair; the number of merges where there is none."""
        keys = left * self.size + right
        at = self._slot(keys, self.bits)
        out = np.full(len(keys), len(self.made), np.int64)
        for k in range(self.probes):
            place = (at + k) & ((1 << self.bits) - 1)
            hit = self.slot_key[place] == keys
            out[hit] = self.slot_rank[place[hit]]
        return out

    def _inside_pairs(self, vocab: dict[str, int], suffix: str) -> np.ndarray:
        """inside[a, b]: some token has byte a next to byte b; b + 256 where b ends a word."""
        inside = np.zeros((256, 512), bool)
        for token in vocab:
            word_end = token.endswith(suffix) and token != suffix
            body = token.removesuffix(suffix) if word_end else token
            units = [self.byte_of[c] for c in body]
            if word_end:
                units[-1] += 256
            for a, b in zip(units, units[1:]):
                inside[a, b] = True
        return inside

    def encode_fragments(self, units: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all fragments. `units`: byte units (end of word + 256); `cut`: true where a fragment starts.

        Returns the ids and, for each, the place of the unit where it starts.
        """
        ids, place = self.unit[units], np.arange(len(units), dtype=np.int64)
        done_ids, done_place = [], []
        none = len(self.made)
        start = cut.copy()
        rank = np.full(len(ids), none, np.int64)  # of the pair that begins here
        if len(ids) > 1:
            open_pair = ~start[1:]
            rank[:-1][open_pair] = self.ranks(ids[:-1][open_pair], ids[1:][open_pair])
        while len(ids):
            heads = np.flatnonzero(start)
            sizes = np.diff(np.append(heads, len(ids)))
            best = np.minimum.reduceat(rank, heads)
            live = np.repeat(best < none, sizes)
            if not live.all():
                done_ids.append(ids[~live])
                done_place.append(place[~live])
                ids, place, start, rank = ids[live], place[live], start[live], rank[live]
                if not len(ids):
                    break
                heads = np.flatnonzero(start)
                sizes, best = sizes[best < none], best[best < none]
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            # overlapping hits of one pair (aaa) merge from the left: keep every other one of a run
            run_start = np.ones(len(hits), bool)
            run_start[1:] = hits[1:] != hits[:-1] + 1
            nth = np.arange(len(hits)) - np.flatnonzero(run_start)[np.cumsum(run_start) - 1]
            hits = hits[nth % 2 == 0]
            ids[hits] = self.made[rank[hits]]
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            at = np.cumsum(keep) - 1
            ids, place, start, rank = ids[keep], place[keep], start[keep], rank[keep]
            # only pairs that touch a new id have to be looked up again
            new = at[hits]
            mark = np.zeros(len(ids), bool)
            mark[new] = True
            mark[new[new > 0] - 1] = True
            touched = np.flatnonzero(mark)
            rank[touched] = none
            inner = touched[touched + 1 < len(ids)]
            inner = inner[~start[inner + 1]]
            rank[inner] = self.ranks(ids[inner], ids[inner + 1])
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ids, place = np.concatenate(done_ids), np.concatenate(done_place)
        order = np.argsort(place, kind="stable")
        return ids[order], place[order]

    def _odd_word(self, word: str) -> Iterator[bytes | int]:
        """Byte strings of the pieces of a word, and ids of special tokens in it."""
        for part in self.special_split.split(word):
            if part in self.special:
                yield self.special[part]
            elif part:
                normal = self.library.normalizer.normalize_str(part)
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                    yield bytes(self.byte_of[c] for c in piece)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words without blanks, concatenated, and how many each word has."""
        fits = _PLAIN.fullmatch
        plain = [i for i, w in enumerate(words) if fits(w)]
        raw = np.frombuffer("".join([words[i].lower() + "\n" for i in plain]).encode(), np.uint8)
        kind = _CLASS[raw]
        body = kind > 0
        begins = body.copy()
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        owner = np.array(plain, np.int64)[np.cumsum(~body)[begins]] if len(plain) else np.zeros(0, np.int64)
        units = raw[body].astype(np.int64)
        starts = np.flatnonzero(begins[body])
        ends = np.append(starts[1:], len(units)) if len(units) else starts  # pieces end before these units
        odd_pieces: list[bytes] = []
        odd_owner: list[int] = []
        special_at: list[tuple[int, int]] = []  # piece number among the odd ones, id
        if len(plain) < len(words):
            taken = set(plain)
            for i, w in enumerate(words):
                if i in taken:
                    continue
                for piece in self._odd_word(w):
                    if isinstance(piece, int):
                        special_at.append((len(odd_pieces), piece))
                        piece = b"x"
                    if piece:
                        odd_pieces.append(piece)
                        odd_owner.append(i)
        if odd_pieces:
            more = np.frombuffer(b"".join(odd_pieces), np.uint8).astype(np.int64)
            odd_ends = len(units) + np.cumsum([len(p) for p in odd_pieces])
            first_odd = len(ends)
            units, ends = np.concatenate([units, more]), np.concatenate([ends, odd_ends])
            owner = np.concatenate([owner, np.array(odd_owner, np.int64)])
        if not len(units):
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        units[ends - 1] += 256
        cut = np.ones(len(units), bool)
        cut[1:] = ~self.inside[units[:-1] & 255, units[1:]]
        cut[ends[ends < len(units)]] = True
        ids, place = self.encode_fragments(units, cut)
        piece = np.searchsorted(ends, place, side="right")
        if odd_pieces:
            for k, token in special_at:
                ids[piece == first_odd + k] = token
        whose = owner[piece]
        order = np.argsort(whose, kind="stable")
        return ids[order], np.bincount(whose, minlength=len(words)).astype(np.int64)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, group by group of bounded size."""
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= _BATCH_CHARS:
                yield from self._encode_group(group)
                group, size = [], 0
        if group:
            yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[np.ndarray]:
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        # an empty string stands for a blank at the ends of a text; it has no ids
        ids, lengths = self.encode_words(coded.dictionary.to_pylist())
        begin = np.cumsum(lengths) - lengths
        which = coded.indices.to_numpy()
        bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
        n_ids = np.concatenate([[0], np.cumsum(lengths[which])])
        flat = ids[ragged(begin[which], lengths[which])]
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield flat[n_ids[a] : n_ids[b]]

    def decode(self, ids: np.ndarray) -> bytes:
        """The token strings with a blank between them, as the library joins them without a decoder."""
        begin = self.name_at[ids]
        return self.names[ragged(begin, self.name_at[ids + 1] - begin)].tobytes()[:-1]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One set of tables per worker process and vocabulary file."""
    return Encoder(path)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): the token ids of every text and the text decoded from them."""
    return _map_documents(docs, vocabulary, id_col, text_col, digest=False)


def encode_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `encode_documents`, but with the number of ids and SHA-256 digests instead of the values themselves."""
    return _map_documents(docs, vocabulary, id_col, text_col, digest=True)


def _map_documents(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, digest: bool) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows: list[tuple] = []
            for ids in coder.encode(texts):
                text = coder.decode(ids)
                if digest:
                    packed = ids.astype("<u4").tobytes()
                    rows.append((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text).hexdigest()))
                else:
                    rows.append((ids, text.decode("utf-8", "replace")))
            columns = list(zip(*rows)) or [()] * (3 if digest else 2)
            types = [pa.int64(), pa.string(), pa.string()] if digest else [pa.list_(pa.int64()), pa.string()]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], names=["doc_id", *names]
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids array<long>, decoded string"
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {id_type}, {columns}")
