"""Decontamination of repetitive texts: results, time and memory."""

from __future__ import annotations

import os
import random
import resource
import sys
import time

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

from vigil.llm import suffix  # noqa: E402
from vigil.llm import textkernel as K  # noqa: E402


def matches(rows, texts, window=13):
    data, off = K.string_parts(pa.array(rows, pa.large_string()))
    words = K.Words(data, off, K.ALNUM, lower=True)
    items = suffix.TestItems([[str(i)] for i in range(len(texts))], texts, window)
    return sorted(zip(*(x.tolist() for x in suffix._matches(words, items))))


def plain(rows, texts, window=13):
    """per row, item and word: the longest match, without rests of the one before"""
    out = []
    for r, row in enumerate(rows):
        w = brute.ALNUM.findall((row or "").lower())
        for k, text in enumerate(texts):
            x = brute.ALNUM.findall((text or "").lower())
            need, last = min(window, len(x)), 0
            for i in range(len(w)):
                best = max((next((n for n in range(len(x) - j) if i + n >= len(w) or w[i + n] != x[j + n]), len(x) - j) for j in range(len(x))), default=0)
                if need and best >= need and best != last - 1:
                    out.append((r, k, i, best))
                last = best if need and best >= need else 0
    return sorted(out)


@pytest.mark.parametrize("seed", range(8))
def test_longest_matches(seed):
    rng = random.Random(seed)
    prose = lambda n, v: [f"w{rng.randint(0, v)}" for _ in range(n)]
    texts = [prose(rng.randint(0, 40), rng.choice([1, 3, 30])) for _ in range(8)]
    rows = []
    for _ in range(12):
        row = prose(rng.randint(0, 40), rng.choice([1, 3, 30]))
        for _ in range(rng.randint(0, 3)):
            t = rng.choice(texts)
            a = rng.randint(0, len(t))
            row += t[a:a + rng.randint(0, 40)]
        rows.append(" ".join(row))
    texts = [" ".join(t) for t in texts]
    for window in (13, 4):
        got = matches(rows, texts, window)
        assert sorted((r, k, i, n) for r, k, _, i, n in got) == plain(rows, texts, window)
        for r, k, j, i, n in got:
            w, x = brute.ALNUM.findall(rows[r].lower()), brute.ALNUM.findall(texts[k].lower())
            assert w[i:i + n] == x[j:j + n] and len(x[j:j + n]) == n


def test_a_word_repeated_does_not_multiply():
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    t0 = time.time()
    got = matches(["the " * 20_000, "the cat " * 5000], ["the " * 2000, "cat the " * 900, "the " * 2000])
    assert time.time() - t0 < 30 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20       # KB
    assert {(r, k) for r, k, *_ in got} == {(0, 0), (0, 2), (1, 1)}
    assert all(n == 2000 for r, k, _, i, n in got if r == 0) and [i for r, k, _, i, n in got if (r, k) == (0, 0)] == list(range(18_001))


def test_common_beginnings():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 2, 300).astype(np.uint64), rng.integers(0, 2, 200).astype(np.uint64)
    i, j = rng.integers(0, 300, 500), rng.integers(0, 200, 500)
    most = np.minimum(300 - i, 200 - j)
    want = [next((n for n in range(m) if a[x + n] != b[y + n]), m) for x, y, m in zip(i, j, most)]
    assert suffix.Rolling(a).common(i, suffix.Rolling(b), j, most).tolist() == want
