"""Runs against a plain search over all periods."""

from __future__ import annotations

import hashlib
import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from vigil.llm import periodic as R  # noqa: E402
from vigil.llm import queries  # noqa: E402
from vigil.llm import textkernel as K  # noqa: E402


def plain_runs(s, least=2):
    n, out = len(s), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and s[j] == s[j + p]:
                j += 1
            part = s[i:j + p]
            if j - i >= p and len(part) >= least and not any(part[q:] == part[:-q] for q in range(1, p)):
                out.append((i, len(part), p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def with_tail(i, words):
    h, n = zlib.crc32(str(i).encode()), len(words)
    if i is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]


def judged(i, words):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    found = plain_runs(words, R.MIN_WORDS)
    gone = {k for s, n, p in found for k in range(s + p, s + n)}
    s, n, p = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    return (i, len(found), s, n, p, n and 1000 * n // p, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)),
            sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_all_runs_of_short_sequences():
    rng = random.Random(1)
    for _ in range(1500):
        n, k = rng.randint(0, 40), rng.randint(1, 4)
        s = [rng.randint(1, k) for _ in range(n)]
        if rng.random() < 0.5 and n > 5:
            p = rng.randint(1, n // 2)
            s = [s[i % p] for i in range(n)]
        assert list(zip(*[x.tolist() for x in R.runs(np.array(s, np.int64), k + 1)])) == plain_runs(s)


def test_range_minima():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 10 ** 6, 20_000)
    low = rng.integers(0, len(x), 4000)
    high = np.minimum(low + rng.integers(0, np.array([3, 34, 70, 20_000])[np.arange(4000) % 4]), len(x) - 1)
    m = R.RangeMinima(x)
    assert m(low, high).tolist() == [int(x[a:b + 1].min()) for a, b in zip(low, high)]
    one = np.zeros(1, int)
    assert R.RangeMinima(x[:1])(one, one).tolist() == [x[0]]


def texts(seed, n):
    """prose with runs of words and of lines, some of them side by side"""
    rng, out = random.Random(seed), []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = [rng.choice("abcde") for _ in range(rng.randint(1, 9))] if rng.random() < 0.7 else [f"w{rng.randint(0, 99)}" for _ in range(rng.randint(5, 40))]
            parts += (p * rng.randint(1, 9))[:rng.randint(1, 90)]
        out.append(rng.choice(["", " ", "\n"]) + "".join(w + rng.choice([" ", "\n", " \t "]) for w in parts))
    return out


def test_stretches_share_and_fill_trees(monkeypatch):
    rows = texts(4, 120)
    data, off = K.string_parts(pa.array(rows, pa.large_string()))
    words = K.Words(data, off, K.NON_SPACE, lower=False)
    want = []
    for i, t in enumerate(rows):
        want += [(int(words.first[i]) + s, n, p) for s, n, p in plain_runs(brute.SPACED.findall(t), R.MIN_WORDS)]
    for tree in (1, 100, 1 << 15):
        monkeypatch.setattr(R, "TREE_WORDS", tree)
        assert sorted(zip(*(x.tolist() for x in R.find_in_rows(words)))) == sorted(want)


def test_query_equals_brute_force(spark):
    rows = list(enumerate(texts(5, 150))) + [(1000, None), (1001, ""), (1002, " \n "), (None, "a b " * 9), (1003, "é " * 20), (3, "x y z " * 7), (3, "x y z " * 7)]
    df = spark.createDataFrame([(i, t, "k", [1], 2) for i, t in rows], "doc_id long, text string, id string, runs array<int>, collapsed int")
    tailed = df.select("doc_id", R.repeated_tail(F.col("text"), F.col("doc_id")).alias("text"))
    got = sorted([tuple(r) for r in R.digests(R.find_runs(tailed)).collect()], key=str)
    want = [judged(i, with_tail(i, brute.SPACED.findall(t or ""))) for i, t in rows]
    assert got == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 60 and any(i is not None and not zlib.crc32(str(i).encode()) % 10 for i, _ in rows)
    assert R.digests(R.find_runs(tailed.limit(0))).collect() == []


def test_long_periodic_text(spark):
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 30000)}" for _ in range(7000)]
    df = spark.createDataFrame([(1, " ".join(base * 6)), (2, "na " * 60_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in R.find_runs(df).collect()}
    assert [tuple(x) for x in got[1].runs if x.length > 100] == [(0, 42_000, 7000)] and got[1].collapsed == " ".join(base)
    assert [tuple(x) for x in got[2].runs] == [(0, 60_000, 1)] and got[2].collapsed == "na"


def test_registered_query_on_the_tables(spark):
    rows = queries.op11_periodic_runs(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    short = [(r.doc_id, with_tail(r.doc_id, brute.SPACED.findall(r.text or ""))) for r in docs]
    want = {i: judged(i, w) for i, w in short if len(w) < 1500}
    assert len(rows) == len(docs) and {tuple(r) for r in rows if r.doc_id in want} == set(want.values())
