"""Fill-in-middle against a plain reading of its definition."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from textkg.llm import fim

SCHEMA = "doc_id long, text string, output string, form string, n long, restored string"


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(3)
    fixed = [None, "", "a", "é", "<P>", "x<S>y", "<M", "M>", "<<P", ">", "日本語 text", "😀😀a😀", "a\n\nb", " ", "<", "word " * 300, "é" * 5000]
    alphabet = ["a", "Zb", " ", "é", "日", "😀", "<", ">", "P", "S", "\n", "1"]
    return fixed + ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(400)]


def test_against_the_definition(spark):
    rows = [(i, t, "x", "y", 1, "z") for i, t in enumerate(texts())] * 2 + [(None, "no id at all", "x", "y", 1, "z")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = fim.restore_texts(fim.fill_in_middle(docs)).collect()
    want = sorted(((r[0], *brute(r[0], r[1]), r[1] or "") for r in rows), key=repr)
    assert sorted((tuple(r) for r in found), key=repr) == want
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert fim.restore_texts(fim.fill_in_middle(docs)).count() == 0


@pytest.mark.parametrize("tile", [1, 7, 4096])
def test_tiles_and_blocks(monkeypatch, tile):
    monkeypatch.setattr(fim, "_TILE", tile)
    monkeypatch.setattr(fim, "_BLOCK", 5)
    given = [(t or "").encode() for t in texts()[:80]]
    raw = np.frombuffer(b"".join(given), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in given])])
    n, form, _, _, out, ends = fim.transform(list(range(80)), raw, bounds, "1")
    got = [out[a:b].tobytes().decode() for a, b in zip(ends[:-1], ends[1:])]
    assert got == [brute(i, t)[-1] for i, t in enumerate(texts()[:80])]
    back, _ = fim.restore(form, out, ends)
    assert back.tobytes() == raw.tobytes()


def test_a_very_long_text():
    text = ("plain Words, é and 日本 " * 900_000).encode()
    raw, bounds = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    _, form, _, _, out, ends = fim.transform([5], raw, bounds, "1")
    assert out.tobytes().decode() == brute(5, text.decode())[-1]
    assert fim.restore(form, out, ends)[0].tobytes() == text


def test_a_damaged_output_is_refused():
    raw = np.frombuffer(b"<P>a<S>b", np.uint8)
    with pytest.raises(ValueError):
        fim.restore(np.array([fim.PSM]), raw, np.array([0, len(raw)]))
    raw = np.frombuffer(b"<S>a<P>b<M>", np.uint8)
    with pytest.raises(ValueError):
        fim.restore(np.array([fim.PSM]), raw, np.array([0, len(raw)]))
