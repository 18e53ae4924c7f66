"""Landmarks are unpacked a length at a time: the kernel is the same and needs little memory."""

from __future__ import annotations

import tracemalloc

import numpy as np

from textkg.llm import langid


def test_kernel_with_bits_is_the_kernel_in_little_memory():
    made = np.random.default_rng(3)
    texts = [langid.letters_of("".join(made.choice(list("abcdeé ñ"), 300))) for _ in range(300)]
    packed = []
    for raw in texts:
        seen = [np.zeros(size, bool) for size in langid.SIZES]
        for s, at in zip(seen, langid._grams(raw)):
            s[at] = True
        packed.append(np.packbits(np.concatenate(seen)).tobytes())
    want = langid.kernel(langid.presence(texts[:30]), langid.presence(texts))
    tracemalloc.start()
    got = langid.kernel_with_bits(texts[:30], packed)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got, want) and got.shape == (30, 300)
    assert most < 110 << 20  # all lengths of 300 landmarks as numbers have 138 MB
