"""Slow, plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def shingles(text, k=5):
    w = SPACED.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def jaccard_components(rows, k=5, num=75, den=100):
    """rows of (id, text) -> [(id, n_shingles, component)]"""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    owners = {}
    for at, (_, s) in enumerate(sets):
        for g in s:
            owners.setdefault(g, []).append(at)
    pairs = {(a, b) for own in owners.values() for i, a in enumerate(own) for b in own[i + 1:]}
    for a, b in pairs:
        (i, x), (j, y) = sets[a], sets[b]
        if i is None or j is None:
            continue
        if len(x & y) * den >= num * len(x | y):
            i, j = find(i), find(j)
            parent[max(i, j)] = min(i, j)
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]


def decontamination(docs, items, window=13, times=20):
    """rows of (id, text), (item_id, text) -> [(id, n_words, n_hit, n_items, sha, contaminated)]"""
    wins = {}
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        if not w:
            continue
        size = min(window, len(w))
        for i in range(len(w) - size + 1):
            wins.setdefault(tuple(w[i:i + size]), set()).add(item)
    sizes = {len(x) for x in wins}
    out = []
    for doc, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                got = wins.get(tuple(w[i:i + size]))
                if got:
                    hit.update(range(i, i + size))
                    found |= got
        ids = sorted(str(x) for x in found if x is not None)
        sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), sha, len(hit) > 0 and times * len(hit) >= len(w)))
    return out


def _grams(text):
    """1- to 3-grams inside runs of letters, one blank on either side, as code points"""
    out, n = {}, 0
    for w in re.findall(r"[^\W\d_]+", text or ""):
        w = [0, *(ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in w if c.isalpha()), 0]
        for size in (1, 2, 3):
            for i in range(len(w) - size + 1):
                g = tuple(w[i:i + size])
                if g != (0,):
                    out[g] = out.get(g, 0) + 1
    return out


def _ranked(counts, ranks):
    """most frequent first; ties by code points, shorter n-grams after longer ones"""
    none = 0x1FFFFF
    order = sorted(counts, key=lambda g: (-counts[g], [none] * (3 - len(g)) + list(g)))
    return {g: r for r, g in enumerate(order[:ranks])}


def languages(rows, ranks=300):
    """rows of (id, text, lang) -> [(lang_pred, score, margin)] by out-of-place distance"""
    import zlib
    counts = {}
    for i, text, lang in rows:
        if i is not None and lang is not None and zlib.crc32(str(i).encode()) % 5:
            own = counts.setdefault(lang, {})
            for g, n in _grams(text).items():
                own[g] = own.get(g, 0) + n
    profiles = {lang: _ranked(c, ranks) for lang, c in counts.items() if c}
    out = []
    for _, text, _ in rows:
        mine = _ranked(_grams(text), ranks)
        if not mine or not profiles:
            out.append(("und", 0.0, 0.0))
            continue
        most = len(mine) * ranks
        far = sorted((sum(min(abs(p[g] - r), ranks) if g in p else ranks for g, r in mine.items()), lang) for lang, p in profiles.items())
        second = far[1][0] if len(far) > 1 else most
        out.append((far[0][1], 1 - far[0][0] / most, (second - far[0][0]) / most))
    return out
