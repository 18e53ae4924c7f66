"""Toxicity scores from a lexicon met with Levenshtein automata.

1. Lexicon: a seed list plus words and word stems that labelled toxic texts use far more often than clean ones. Labels come from a
   bounded sample (`max_labelled` rows, by hash of the id) outside the held-out fold.
2. The terms form a trie. The Levenshtein automata of all terms run along it at once: a state is the set of trie nodes that the
   letters read so far reach with their edits. States are made determinate as words need them and kept, so most words die after a
   few letters. Terms of 5 letters allow one edit, of 9 two; stems match the beginning of a word, exactly.
3. Each hit is judged by the window of words around it: quotation marks or words of reporting speak for a quotation, words of the
   second person for abuse. Counts of the kinds of hits go into a logistic regression, fitted on the same sample by Newton's
   method on per-document figures.

All texts are scored whole, in one scan without a shuffle. Cases: a null or empty text has no hits and gets the score of a text without
any; repeated rows are scored each; several labels of one document count as toxic if one does; null labels don't count. Without
labelled rows of both kinds the seed list and fixed weights are used. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkg.llm.common import fold, handing_back

MAX_LABELLED = 20_000
MAX_TERMS = 512
WINDOW = 6

SEEDS = (
    "idiot moron stupid loser scum trash pathetic worthless disgusting clown imbecile dumbass bastard asshole retard "
    "scumbag vermin filth lowlife jackass"
).split()
_QUOTES = frozenset("\"“”„«»‟❝❞")
_REPORTING = frozenset("said says called calls quoted quote quotes wrote writes word term insult reported citation dit dijo sagte".split())
_SECOND_PERSON = frozenset("you your yours youre you're u ur tu vous te ton votre du dich dein sie ihr usted vosotros".split())
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”„«»‟‘’…–—¿¡"
FEATURES = ("words", "stems", "misspelled", "quoted", "addressed", "terms")
# Without labels: intercept, then one weight per feature.
PRIOR = np.array([-3.0, 2.5, 2.5, 1.5, -1.5, 0.8, 1.0])


class Lexicon:
    """A trie of terms and the determinate states of their automata met so far."""

    MAX_STATES = 200_000

    def __init__(self, words: list[str], stems: list[str]):
        self.terms = [(w, False) for w in words] + [(s, True) for s in stems]
        self.children: list[dict[str, int]] = [{}]
        self.at_end: list[list[int]] = [[]]
        self.reach: list[int] = [0]  # most edits of any term at or below the node
        for number, (term, stem) in enumerate(self.terms):
            edits, node = self.edits(term, stem), 0
            self.reach[0] = max(self.reach[0], edits)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.at_end.append([])
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], edits)
            self.at_end[node].append(number)
        self._reset()

    @staticmethod
    def edits(term: str, stem: bool) -> int:
        return 0 if stem or len(term) < 5 else 1 if len(term) < 9 else 2

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.items: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.whole: list[tuple[int, int] | None] = []  # (edits, term) if a word ends here
        self.begun: list[tuple[int, int] | None] = []  # a stem that has been read
        self._add(frozenset())
        self.start = self._add(self._close({(0, 0)}))

    def _close(self, items: set[tuple[int, int]]) -> frozenset:
        """Letters of a term may be left out of the word."""
        todo = list(items)
        while todo:
            node, used = todo.pop()
            for child in self.children[node].values():
                if used + 1 <= self.reach[child] and (child, used + 1) not in items:
                    items.add((child, used + 1))
                    todo.append((child, used + 1))
        return frozenset(items)

    def _add(self, items: frozenset) -> int:
        if items not in self.states:
            self.states[items] = len(self.items)
            ends = [(used, t) for node, used in items for t in self.at_end[node] if used <= self.edits(*self.terms[t])]
            self.items.append(items)
            self.moves.append({})
            self.whole.append(min(((u, t) for u, t in ends if not self.terms[t][1]), default=None))
            self.begun.append(min(((u, t) for u, t in ends if self.terms[t][1]), default=None))
        return self.states[items]

    def _move(self, state: int, letter: str) -> int:
        after: set[tuple[int, int]] = set()
        for node, used in self.items[state]:
            for c, child in self.children[node].items():
                cost = used + (c != letter)
                if cost <= self.reach[child]:
                    after.add((child, cost))
            if used + 1 <= self.reach[node]:
                after.add((node, used + 1))  # a letter too many in the word
        new = self._add(self._close(after))
        self.moves[state][letter] = new
        return new

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term number) of the nearest term; ties go to the smaller number."""
        if len(self.items) > self.MAX_STATES:
            self._reset()
        state, stem = self.start, None
        for letter in word:
            after = self.moves[state].get(letter)
            state = self._move(state, letter) if after is None else after
            if state == 0:
                return stem
            stem = stem or self.begun[state]
        return self.whole[state] or stem


def _core(token: str) -> str:
    return token.strip(_EDGE).lower()


def _hit(lexicon: Lexicon, token: str) -> tuple[int, int] | None:
    core = _core(token)
    found = lexicon.match(core) if core else None
    if found is None and core and not core.isalnum():
        parts = "".join(c if c.isalnum() else " " for c in core).split()
        found = min((h for h in map(lexicon.match, parts) if h), default=None)
    return found


def document_features(texts: list[str], lexicon: Lexicon, window: int = WINDOW) -> np.ndarray:
    """One row of FEATURES per text."""
    words = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
    coded = words.flatten().dictionary_encode()
    tokens = coded.dictionary.to_pylist()
    hits = [_hit(lexicon, t) for t in tokens]
    # 0: no hit, else edits + 1, or -1 for a stem
    code = np.array([0 if h is None else -1 if lexicon.terms[h[1]][1] else h[0] + 1 for h in hits], np.int64)
    which = coded.indices.to_numpy()
    bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
    out = np.zeros((len(texts), len(FEATURES)))
    places = np.flatnonzero(code[which] != 0) if len(which) else np.zeros(0, np.int64)
    owner = np.searchsorted(bounds, places, side="right") - 1
    terms: dict[int, set[int]] = {}
    for place, doc in zip(places.tolist(), owner.tolist()):
        a, z = max(bounds[doc], place - window), min(bounds[doc + 1], place + window + 1)
        near = [tokens[i] for i in which[a:z]]
        around = {_core(t) for t in near}
        quoted = any(not _QUOTES.isdisjoint(t) for t in near) or not around.isdisjoint(_REPORTING)
        kind = code[which[place]]
        if quoted:
            out[doc, 3] += 1
        else:
            out[doc, 0 if kind == 1 else 1 if kind < 0 else 2] += 1
        out[doc, 4] += not around.isdisjoint(_SECOND_PERSON)
        terms.setdefault(doc, set()).add(hits[which[place]][1])
    for doc, found in terms.items():
        out[doc, 5] = len(found)
    return np.log1p(out)


def labelled_sample(labels: DataFrame, folds: int, held_out: int, limit: int) -> DataFrame:
    """(doc_id, toxic): at most `limit` labelled documents outside the held-out fold, by hash of the id."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).filter(fold(F.col("doc_id"), folds) != held_out)
    return known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def learn_lexicon(sample: DataFrame, text_col: str, max_terms: int = MAX_TERMS) -> Lexicon:
    """Words and stems whose share of toxic sample texts is at least 25 times that of clean ones."""

    @handing_back
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {c for c in map(_core, set((text or "").split())) if c.isalpha() and 3 <= len(c) <= 30}
                counts[toxic > 0].update({(w, False) for w in words})
                counts[toxic > 0].update({(w[:n], True) for w in words for n in range(3, 9) if len(w) > n})
            forms = sorted({*counts[0], *counts[1]})
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f for f, _ in forms], pa.string()), pa.array([s for _, s in forms], pa.bool_()),
                    pa.array([counts[1][f] for f in forms], pa.int64()), pa.array([counts[0][f] for f in forms], pa.int64()),
                ],
                names=["form", "stem", "bad", "good"],
            )

    n_bad, n_good = sample.agg(F.sum((F.col("toxic") > 0).cast("long")), F.sum((F.col("toxic") <= 0).cast("long"))).first()
    n_bad, n_good = n_bad or 0, n_good or 0
    if not n_bad or not n_good:
        return Lexicon(list(SEEDS), [])
    rows = sample.select(text_col, "toxic").mapInArrow(run, "form string, stem boolean, bad long, good long")
    least = max(4, n_bad // 100)
    lift = (F.col("bad") + 0.5) / (n_bad + 1) / ((F.col("good") + 0.5) / (n_good + 1))
    found = rows.groupBy("form", "stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    found = found.filter((F.col("bad") >= least) & (lift >= 25)).orderBy(F.desc("bad"), "form", "stem").limit(64 * max_terms).collect()
    bad = {(r.form, r.stem): r.bad for r in found}
    stems: list[str] = []
    for stem in sorted(f for f, s in bad if s):
        # the longest form of a stem that still covers nearly all texts of the stem without its last letter
        longer = any(f[:-1] == stem and s and n >= 0.9 * bad[stem, True] for (f, s), n in bad.items())
        if not longer and not any(stem.startswith(s) for s in stems):
            same = any(f.startswith(stem) and not s and n >= 0.9 * bad[stem, True] for (f, s), n in bad.items())
            if not same:  # else it is one word, not a stem
                stems.append(stem)
    words = [f for f, s in bad if not s and not any(f.startswith(x) for x in stems)]
    chosen = sorted([(-bad[f, s], f, s) for s, forms in ((False, words), (True, stems)) for f in forms])[:max_terms]
    learned = [f for _, f, s in chosen if not s]
    return Lexicon([*SEEDS, *[w for w in learned if w not in SEEDS]], [f for _, f, s in chosen if s])


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Logistic regression with an intercept by Newton's method; the ridge spares the intercept."""
    if not len(y) or y.min() == y.max():
        return PRIOR.copy()
    a = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([1e-6] + [ridge] * x.shape[1])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (y - p) - penalty @ w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, id_col: str = "doc_id", text_col: str = "text",
    max_labelled: int = MAX_LABELLED, carry: bool = False,
) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`, and the kinds of hits behind them.

    With `carry` the whole input row comes along as the struct `row`, so that nothing has to be joined back.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # a carried row holds the text already, so it is not sent a second time
    rows = docs.select(F.col(id_col).alias("doc_id"), F.struct(*docs.columns).alias("row")) if carry else plain
    wanted = F.broadcast(labelled_sample(labels, folds, held_out, max_labelled))  # at most `max_labelled` rows
    sample = plain.join(wanted, "doc_id").select("text", "toxic")
    lexicon = learn_lexicon(sample, "text")
    words, stems = ([t for t, s in lexicon.terms if s == kind] for kind in (False, True))
    n = len(FEATURES)

    @handing_back
    def features(batches: Iterable[pa.RecordBatch], keep: list[int], weights: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        own = Lexicon(words, stems)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                texts = part.column(at) if at >= 0 else pc.struct_field(part.column(1), text_col)
                x = document_features([t or "" for t in texts.to_pylist()], own)
                columns = [part.column(i) for i in keep]
                names = [part.schema.names[i] for i in keep]
                if weights is not None:
                    columns.append(pa.array(1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))))
                    names.append("score")
                columns += [pa.array(x[:, i]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *[f"hits_{f}" for f in FEATURES]])

    figures = ", ".join(f"hits_{f} double" for f in FEATURES)
    # at most `max_labelled` rows, and one text repeated under an id counts as often as it occurs
    train = sample.mapInArrow(lambda it: features(it, [1], None), f"toxic int, {figures}").groupBy(*[f"hits_{f}" for f in FEATURES], "toxic").count()
    seen = np.array([[*r] for r in train.collect()], float).reshape(-1, n + 2)
    times = seen[:, -1].astype(int)
    weights = fit_weights(np.repeat(seen[:, :n], times, axis=0), np.repeat((seen[:, n] > 0).astype(float), times))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    row_type = f"row {rows.schema['row'].dataType.simpleString()}, " if carry else ""
    kept = [0, 1] if carry else [0]
    scored = rows.mapInArrow(lambda it: features(it, kept, weights), f"doc_id {id_type}, {row_type}score double, {figures}")
    return scored.select(
        "doc_id", *["row"] * carry, (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), *[f"hits_{f}" for f in FEATURES],
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **names: str) -> DataFrame:
    """The rows of `docs` whose score is below the threshold."""
    scored = score_toxicity(docs, labels, carry=True, **names)
    return scored.filter(F.col("score") < threshold).select("row.*")
