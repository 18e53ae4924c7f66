"""Operators of the training-data subpackage against brute force on small fixtures with awkward rows."""

from __future__ import annotations

import hashlib
import json
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textkg.llm import ann, bpe, chat, ctw, langid, ngram_join, packing, quality, suffix_dedup, toxicity
from textkg.llm.common import lower_words
from textkg.llm.queries import vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, d int, raw string, sig long, score double, part int"


def _words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}x" for _ in range(n))


def _texts():
    rng = random.Random(7)
    base = _words(rng, 150)
    passage = _words(rng, 60)
    near = base.split()
    near[40] = "changed"
    far = base.split()
    for i in range(0, 150, 12):
        far[i] = "other"
    texts = [
        None, "", "   \n\t ", "one", "Two words", "a b c d", base, base, " ".join(near), " ".join(far), base.upper(),
        _words(rng, 80) + " " + passage, passage + " " + _words(rng, 90), "é" * 300, "é" * 301, "a" * 1000,
        "line\nline\nother\n\nline", "x " * 3000, _words(rng, 20_000), "you idiot!", "an ldiot said “idiot”", "日本語 テスト don't",
        "<|endoftext|> <|im_start|>", "!!! ??? 123",
    ]
    texts += [_words(rng, rng.randrange(1, 120), 4000) for _ in range(30)]
    return texts


@pytest.fixture(scope="module")
def texts():
    return _texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 2 else "fr", None, None, "r", 1, "q", 2, 0.5, 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_id(df):
    return {r[0]: r for r in df.collect()}


# quality rules


def test_quality_counts(docs, texts):
    got = _by_id(quality.apply_rules(docs))
    for i, t in enumerate(texts):
        w = [x.decode() for x in (t or "").encode().split()]
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_symbols == sum(c in quality.SYMBOLS for c in t or "")
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_quality_rule_table(spark):
    rows = [(1, "the " * 30 + " ".join(f"w{i}" for i in range(60))), (2, " ".join(f"#w{i}#" for i in range(80)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = _by_id(quality.apply_rules(df, (quality.Rule("symbols", "symbol_ratio", high=0.5),)))
    assert got[1].kept and not got[2].kept and not got[2].pass_symbols


# byte-pair encoding


def test_bpe_equals_library(docs, texts):
    library = bpe.encoder(vocabulary_path()).library
    got = _by_id(bpe.encode_documents(docs, vocabulary_path()))
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert list(got[i].ids) == want
        assert got[i].decoded == library.decode(want, skip_special_tokens=False)


def test_bpe_random_strings():
    coder = bpe.encoder(vocabulary_path())
    rng = random.Random(3)
    letters = "aAbß'é 's12\n<|endoftext|>ñΣ́日!?-_ \x01İ"
    lines = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(800)]
    want = [e.ids for e in coder.library.encode_batch(lines, add_special_tokens=False)]
    assert [list(x) for x in coder.encode(lines)] == want


def test_bpe_cuts_are_certain():
    coder = bpe.encoder(vocabulary_path())
    assert coder.inside.any() and not coder.inside.all()
    # no token crosses a forced cut
    vocab = coder.library.get_vocab()
    for token in random.Random(1).sample(sorted(vocab), 500):
        if token not in coder.special:
            units = [coder.byte_of[c] for c in token.removesuffix("</w>")] if token != "</w>" else []
            if token.endswith("</w>") and units:
                units[-1] += 256
            assert all(coder.inside[a, b] for a, b in zip(units, units[1:]))


# n-gram join


def _sets(texts):
    for t in texts:
        w = lower_words(t)
        yield frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _groups(texts):
    sets = list(_sets(texts))
    head = list(range(len(sets)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                head[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_join_on_awkward_rows(docs, texts):
    got = _by_id(ngram_join.near_duplicate_groups(docs))
    assert [(got[i].n_shingles, got[i].component_id) for i in range(len(texts))] == _groups(texts)


def test_join_of_chained_copies_and_frequent_shingles(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(3):
        words = _words(rng, 130, 5000).split()
        for _ in range(40):  # each differs from the one before, so groups are chains
            words = list(words)
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    common = _words(rng, 60, 5000)
    texts += [common + " " + _words(rng, 25, 10**6) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = _groups(texts)
    for frequent, block in ((1, 4), (64, 256)):
        table, labels = ngram_join.linked_sets(df, frequent=frequent, block=block)
        names = {r.node: r.component for r in labels.collect()}
        label = {r.d: names.get(r.fp, r.fp) for r in table.collect()}
        first = defaultdict(list)
        for i in sorted(label):
            first[label[i]].append(i)
        assert [first[label[i]][0] for i in range(len(texts))] == [w for _, w in want]


def test_signature_bounds_hold():
    """Sets with Jaccard 0.75 or more always share a signature, whatever the counts are."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 300))
        pool = rng.choice(1 << 40, size=3 * n, replace=False)
        x = np.sort(pool[:n])
        drop = int(rng.integers(0, n // 7 + 1))
        y = np.sort(np.concatenate([x[rng.permutation(n)[: n - drop]], pool[n : n + drop]]))
        if 100 * len(np.intersect1d(x, y)) < 75 * len(np.union1d(x, y)):
            continue
        px, py = (s[: ngram_join.prefix_size(len(s))] for s in (x, y))
        assert len(np.intersect1d(px, py)) >= max(ngram_join.required(len(x)), ngram_join.required(len(y)))
        px, py = (np.frombuffer(ngram_join.parity_bits(s.astype(np.uint64)), np.uint8) for s in (x, y))
        assert np.bitwise_count(px ^ py).sum() <= len(np.setxor1d(x, y))
        counts = {int(v): int(rng.integers(2, 200)) for v in np.union1d(x, y)}
        extra = set(pool[n + drop : n + drop + n].tolist())
        both = set(x.tolist()) & set(y.tolist())
        sx, sy = (np.array([v for v in s.tolist() if v in both or v in extra or rng.random() < 0.5]) for s in (x, y))
        a, b = (ngram_join.set_signatures(len(s), np.array([counts[int(v)] for v in p]), p.astype(np.int64), frequent=20) for s, p in ((x, sx), (y, sy)))
        assert len(np.intersect1d(a, b))


def test_keep_one_of_each_group(spark, docs, texts):
    kept = sorted(r.doc_id for r in ngram_join.keep_one_of_each_group(docs).collect())
    assert kept == [i for i, (_, head) in enumerate(_groups(texts)) if head == i]
    again = docs.unionByName(docs)
    twice = Counter(r.doc_id for r in ngram_join.keep_one_of_each_group(again).collect())
    sizes = [n for n, _ in _groups(texts)]
    assert all(twice[i] == (1 if sizes[i] else 2) for i in kept)


# context-tree weighting


def test_ctw_base_and_distribution(docs, texts):
    got = _by_id(ctw.score_documents(docs, top_words=50))
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in lower_words(t))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    for i, t in enumerate(texts):
        w = lower_words(t)
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(train) + 1) / (n + v + 1))
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w) + 1, sum(x in counts for x in w) + 1, n)
        assert r.base_score == pytest.approx(base) and r.score < 0


def test_ctw_weights_of_a_small_tree(spark):
    """The arrays give the same probabilities as the recursive definition, and bytes sum to one."""
    texts = ["abab abba", "abc abab", "bab"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = ctw.train(df)
    stream = [b"\n" * 5 + b" ".join(lower_words(t)) + b"\n" for t in texts]
    nodes = defaultdict(lambda: [0, 0])
    for s in stream:
        for i in range(5, len(s)):
            for depth in range(6):
                for level in range(8):
                    nodes[s[i - depth : i], (1 << level) | (s[i] >> (8 - level))][s[i] >> (7 - level) & 1] += 1

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def log_w(context, place):
        own = log_kt(*nodes[context, place])
        if len(context) == 5:
            return own
        below = sum(log_w(c, p) for c, p in list(nodes) if len(c) == len(context) + 1 and c[1:] == context and p == place)
        return np.logaddexp(own, below) - math.log(2)

    def chance(context, place):
        p, some = 0.5, False
        for depth in range(5, -1, -1):
            key = (context[5 - depth :], place)
            if key in nodes:
                a, b = nodes[key]
                kt = (b + 0.5) / (a + b + 1)
                below = sum(log_w(c, q) for c, q in list(nodes) if len(c) == depth + 1 and c[1:] == key[0] and q == place)
                share = 1 / (1 + math.exp(below - log_kt(a, b))) if some else 1.0
                p, some = share * kt + (1 - share) * p, True
        return p

    context = b"a\nabab"[-5:]
    strings = [int.from_bytes(context[::-1], "big") << 8 | b for b in range(256)]
    got = 10 ** ctw.log10_of_strings(model, np.array(strings, np.int64))
    assert got.sum() == pytest.approx(1.0, abs=1e-6)
    for byte in b"abc \n":
        want = 1.0
        for level in range(8):
            p = chance(context, (1 << level) | (byte >> (8 - level)))
            want *= p if byte >> (7 - level) & 1 else 1 - p
        assert got[byte] == pytest.approx(want, rel=1e-4)


# toxicity


def test_levenshtein_automata_equal_distances():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    terms = ["idiot", "fool", "worthless", "scum"]
    lexicon = toxicity.Lexicon(terms, ["vequ"])
    rng = random.Random(4)
    words = ["".join(rng.choice("idotflwrhescumq") for _ in range(rng.randrange(1, 10))) for _ in range(1500)]
    words += ["".join(rng.sample(t, len(t))) for t in terms] + ["idiott", "idot", "1diot", "wrthlss", "vequa", "veq", "scam", ""]
    for w in words:
        near = [(distance(w, t), k) for k, t in enumerate(terms) if distance(w, t) <= toxicity.Lexicon.edits(t, False)]
        want = min(near, default=(0, 4) if w.startswith("vequ") else None)
        assert lexicon.match(w) == want, w


def test_toxicity_learns_and_tells_quotations(spark, docs, texts, empty):
    rng = random.Random(9)
    rows = [(1000 + i, _words(rng, 30) + (" you idiot loser " if i % 4 == 0 else " ") + _words(rng, 20)) for i in range(200)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int((i - 1000) % 4 == 0)) for i, _ in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = _by_id(toxicity.score_toxicity(more.unionByName(docs.select("doc_id", "text")), labels))
    assert all(got[i].predicted == ((i - 1000) % 4 == 0) for i, _ in rows)
    assert got[0].predicted == 0 and got[1].predicted == 0 and 0 <= got[0].score <= 1
    assert got[19].score > got[3].score
    x = toxicity.document_features(["you idiot", "he said “idiot” once"], toxicity.Lexicon(["idiot"], []))
    assert x[0, 0] > 0 and x[0, 3] == 0 and x[1, 0] == 0 and x[1, 3] > 0
    prior = toxicity.score_toxicity(docs, labels.limit(0))
    assert prior.count() == len(texts)
    assert toxicity.score_toxicity(empty, labels).count() == 0
    assert toxicity.drop_toxic(docs, labels.limit(0)).columns == docs.columns


# packing


def test_packing_is_whole_and_gapless(docs, texts, empty):
    coder = bpe.encoder(vocabulary_path())
    window = 256
    pieces = packing.pack_documents(docs, vocabulary_path(), window).cache()
    rows = pieces.collect()
    ids = dict(enumerate([*x.tolist(), 2] for x in coder.encode([t or "" for t in texts])))
    seen = defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        seen[r.doc_id].append((r.start, r.length))
    for i, want in ids.items():
        assert sum(n for _, n in seen[i]) == len(want) and sorted(a for a, _ in seen[i])[0] == 0
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for a, n in sorted(parts):
            assert a == at
            at += n
        assert at <= window
    assert sorted(by) == list(range(len(by)))
    whole = {r.sequence_id: list(r.ids) for r in packing.packed_ids(docs, pieces, vocabulary_path()).collect()}
    for r in rows:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == ids[r.doc_id][r.start : r.start + r.length]
    assert packing.pack_documents(empty, vocabulary_path()).count() == 0


def test_minimum_bin_slack_finds_the_best_sum():
    rng = random.Random(8)
    for _ in range(200):
        counts = {rng.randrange(1, 60): rng.randrange(1, 4) for _ in range(6)}
        window = max(64, max(counts))
        used = packing.fill_window(counts, window)
        first = max(counts)
        assert used[first] >= 1 and all(k <= counts[n] for n, k in used.items())
        items = [n for n, c in counts.items() for _ in range(c - (n == first))]
        sums = {0}
        for n in items:
            sums |= {s + n for s in sums if s + n <= window - first}
        total = sum(n * k for n, k in used.items())
        best = first + max(sums)
        assert total == best or (best < window and total & (total - 1) == 0)
    plan = packing.plan_windows({5: 7, 9: 2, 64: 3}, 64)
    assert sum(r[2] for r in plan if r[0] == 5) == 7


# nearest neighbours


def test_neighbours_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16))
    x[100:110] = x[99]
    rows = [(i, v.tolist(), "extra") for i, v in enumerate(x)]
    rows += [(900, None, ""), (901, [0.0] * 16, ""), (902, [float("nan")] * 16, ""), (903, [1.0, None] * 8, ""), (904, [1.0], ""), rows[100]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, qid string")
    for parts in (1 << 16, 200):
        got = ann.nearest_neighbours(df, F.col("vec_id") % 20 == 0, k=10, part_rows=parts, bucket_rows=64).collect()
        found = defaultdict(list)
        for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
            found[r.query_id].append((r.vec_id, r.score))
        assert sorted(found) == list(range(0, 600, 20))
        hits = 0
        for q, near in found.items():
            scores = x @ x[q]
            want = sorted((i for i in range(600) if i != q), key=lambda i: (-scores[i], i))[:10]
            hits += len(set(want) & {i for i, _ in near})
            assert len(near) == 10 and near == sorted(near, key=lambda p: (-p[1], p[0]))
            assert all(s == pytest.approx(scores[i], abs=1e-12) for i, s in near)
        assert hits >= 0.9 * 300
    few = ann.nearest_neighbours(df.filter("vec_id in (0, 1, 2, 100, 101)"), F.col("vec_id") % 20 == 0, k=10)
    assert Counter(r.query_id for r in few.collect()) == {0: 4, 100: 4}
    assert ann.nearest_neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_probing_order_is_by_estimated_success():
    place = np.array([0.1, 0.8, 0.45])
    sets = ann.perturbations(place, 12)
    cost = [sum((place[f] if d < 0 else 1 - place[f]) ** 2 for f, d in s) for s in sets]
    assert sets[0] == [] and cost == sorted(cost) and len({tuple(sorted(s)) for s in sets}) == 12


# language identification


def test_language_identification(spark, docs, texts, empty):
    rng = random.Random(6)
    syllables = {"aa": "ka lo mi tu".split(), "bb": "esch ung tz ä".split(), "cc": "que oir eau é".split()}
    rows = []
    for i in range(240):
        lang = sorted(syllables)[i % 3]
        rows.append((i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(40)), lang))
    rows += [(500, None, "aa"), (501, "", None), (502, "123 !!", "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = _by_id(langid.identify_languages(df))
    assert all(got[i].lang_pred == rows[i][2] for i in range(240))
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (500, 501, 502))
    assert {r.doc_id for r in langid.drop_unknown_language(df).collect()} == set(range(240))
    assert langid.identify_languages(docs).count() == len(texts)
    assert langid.identify_languages(empty).count() == 0
    unlabelled = langid.identify_languages(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


# suffix dedup


def _repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        cover = np.zeros(len(r) + 1, int)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        mask = np.cumsum(cover)[:-1] > 0
        kept = bytes(b for b, m in zip(r, mask) if not m)
        out.append((len(r), int(mask.sum()), int((np.diff(np.append(0, mask.astype(int))) == 1).sum()), kept))
    return out


def test_repeats_on_awkward_rows(docs, texts, empty):
    got = _by_id(suffix_dedup.span_digests(docs))
    for i, (n, gone, spans, kept) in enumerate(_repeats(texts, 200)):
        assert tuple(got[i])[1:] == (n, gone, spans, hashlib.sha256(kept).hexdigest())
    assert suffix_dedup.span_digests(empty).count() == 0
    texts_left = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(docs).collect()}
    for i, (*_, kept) in enumerate(_repeats(texts, 200)):
        assert texts_left[i] == (None if texts[i] is None else kept.decode("utf-8", "ignore"))


def test_repeats_of_pasted_passages(spark):
    rng = random.Random(11)
    pool = [_words(rng, 60, 10**6) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(4):
            p = rng.choice(pool)
            a = rng.randrange(0, 150)
            parts += [_words(rng, rng.randrange(1, 12), 10**6), p[a : a + rng.randrange(120, 320)]]
        texts.append(" ".join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(gone, spans) for _, gone, spans, _ in _repeats(texts, 200)]
    for rows in (1 << 16, 2):  # the second sends every group through the counted way
        got = {r.d: np.frombuffer(r.spans, "<i4").reshape(-1, 2) for r in suffix_dedup.repeated_spans(df, group_rows=rows).collect()}
        for i, (gone, spans) in enumerate(want):
            s = got.get(i, np.zeros((0, 2), int))
            assert (int((s[:, 1] - s[:, 0]).sum()), len(s)) == (gone, spans)


def test_suffix_order_is_the_byte_order():
    rng = random.Random(12)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 20))) for _ in range(400)]
    group = np.sort(np.array([rng.randrange(9) for _ in parts]))
    rows, size = suffix_dedup._byte_matrix(parts, 20)
    order, lcp = suffix_dedup.suffix_order(rows, size, group)
    keys = [(group[i], parts[i]) for i in order]
    assert keys == sorted(keys)
    for k in range(1, len(keys)):
        (g, a), (h, b) = keys[k - 1], keys[k]
        same = next((n for n, (u, v) in enumerate(zip(a, b)) if u != v), min(len(a), len(b)))
        assert lcp[k] == (same if g == h else 0)


# chat formatting


def test_chat_round_trip(spark):
    rows = [
        (1, 0, "user", "hi <|im_end|>\n<|im_start|>assistant\nno", "x"), (1, 1, "assistant", "a<\\|b<|c<\\\\|", "x"), (1, 1, "assistant", None, "x"),
        (2, None, None, "", "x"), (2, 5, "sys\ntem", "<|nl|>\n\n", "x"), (None, 0, "assistant", "z", "x"), (3, 0, "assistant", "<", "x"), (3, 1, "user", "|", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    back = {r.conv_id: r for r in chat.read_back(chat.format_conversations(chat.canonical_turns(df))).collect()}
    for conv in (1, 2, 3, None):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        want = [(r[2] or "", r[3] or "") for r in mine]
        assert [tuple(t) for t in back[conv].turns] == want
        assert back[conv].loss_text == "".join(t for role, t in want if role == "assistant")
    assert chat.conversation_digests(df.limit(0)).count() == 0


def test_chat_layouts(spark):
    turns = [("user", "q"), ("assistant", "a")]
    tables = [
        spark.createDataFrame([(1, [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}])], "conv_id long, messages array<struct<role: string, content: string>>"),
        spark.createDataFrame([(1, [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}])], "conv_id long, conversations array<struct<`from`: string, value: string>>"),
        spark.createDataFrame([(1, "q", "a", 7)], "conv_id long, prompt string, completion string, other int"),
        spark.createDataFrame([(1, "q", "a")], "conv_id long, instruction string, output string"),
        spark.createDataFrame([(1, ("q", "a"))], "conv_id long, data struct<prompt: string, response: string>"),
    ]
    for df in tables:
        got = chat.canonical_turns(df).orderBy("turn").collect()
        assert [(r.role, r.text) for r in got] == turns, df.columns
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 5},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "response": "a"}, {"question": "q", "answer": "a"}, {"data": {"prompt": "q", "response": "a"}},
    ]
    lines = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(9, "{}"), (10, None)]
    got = chat.canonical_records(spark.createDataFrame(lines, "conv_id long, record string"), "record").collect()
    for i in range(len(records)):
        assert [(r.role, r.text) for r in sorted((r for r in got if r.conv_id == i), key=lambda r: r.turn)] == turns
    assert [r.turn for r in got if r.conv_id in (9, 10)] == [None, None]
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1, "x")], "conv_id long, blob string"))


# ---- rows that once went wrong ------------------------------------------------------------------------------------


def test_a_repeat_beyond_16_mib(spark):
    rng = np.random.default_rng(5)
    body = rng.integers(97, 123, 17_500_000, dtype=np.uint8)
    passage = rng.integers(65, 91, 1000, dtype=np.uint8)
    body[2_000_000:2_001_000] = passage
    body[17_200_000:17_201_000] = passage
    text = body.tobytes().decode()
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.span_digests(docs).collect()}
    want = text[:2_000_000] + text[2_001_000:17_200_000] + text[17_201_000:]
    assert got[1].n_removed == 2000 and got[1].n_spans == 2 and got[1].n_bytes == 17_500_000
    assert got[1].kept_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert got[2].n_removed == 0


def test_anchors_of_a_long_text_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(6)
    raw = rng.integers(0, 4, 40_000, dtype=np.uint8).tobytes()
    whole = suffix_dedup.find_anchors(raw, np.array([0, len(raw)]))
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 1500)
    parts = [found for _, found in suffix_dedup._chunk_anchors([raw], 200)]
    assert len(parts) > 20
    for name, values in whole.items():
        assert np.array_equal(np.concatenate([p[name] for p in parts]), values), name


def test_vectors_of_another_length_take_no_part(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(100, 3))
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(200, [9.0, 9.0, 9.0, 9.0])]
    found = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=3)
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    score = x @ x.T
    want = {i: sorted((j for j in range(100) if j != i), key=lambda j: (-score[i, j], j))[:3] for i in range(0, 100, 20)}
    assert set(got) == set(want)
    assert np.mean([len(set(got[i]) & set(want[i])) / 3 for i in want]) >= 0.9
