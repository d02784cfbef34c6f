"""The filter audit against a walk through all orders, document by document."""

from __future__ import annotations

import os
import random
import re
import sys
from fractions import Fraction
from itertools import permutations

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

from vigil.llm import filteraudit as A  # noqa: E402


def plain(rows, labels):
    """rows of (id, text, part), labels of (id, good, toxic) -> every step of every order"""
    good = {i for i, g, _ in labels if g == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = {}
    for i, text, part in rows:
        text = text or ""
        w = brute.SPACED.findall(text)
        earlier = any(j is not None and i is not None and j < i and (u or "") == text for j, u, _ in rows)
        fails = {f for f, x in zip("ABCDE", [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                                             any(c in text for c in "#$%&*|"), earlier]) if x}
        docs.setdefault(part or "", []).append((i, fails))
    out = []
    for part, held in docs.items():
        totals = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = list(held)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                totals[f] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), sum(f in x for _, x in held) - len(gone),
                              sum(x == {f} for _, x in held), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), f))
        out += [(*s[:-1], totals[s[-1]]) for s in steps]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, t, p, "en", 1, 2) for i, t, p in rows], "doc_id long, text string, source string, lang string, mask int, n int")


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_audit_equals_the_walk(spark):
    rng = random.Random(9)
    def text():
        n = rng.choice([0, 5, 199, 200, 220])
        words = [rng.choice(["a", "b", "Cc"]) if rng.random() < 0.4 else f"w{rng.randint(0, 400)}" for _ in range(n)]
        return rng.choice(["", " ", "\n"]).join(["", ""]) + " ".join(words + rng.choice([[], [], ["#1"], ["ABCDEFGHIJKL" * 3]])) + rng.choice(["", " ", "\t\t"])
    texts = [text() for _ in range(40)]
    rows = [(i, texts[rng.randrange(40)] if i % 3 else text(), rng.choice(["a", "b", None, ""])) for i in range(150)]
    rows += [(500, None, "a"), (501, "", "b"), (None, texts[0], "a"), (None, texts[0], "a"), (None, None, None), (7, rows[7][1], rows[7][2]),
             (3, "é" * 300, "c"), (900, "x " * 60000, "c"), (901, "x " * 60000, "b")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(0, 1, 1), (None, 1, 1), (7, 1, 0), (9999, 1, 1)]
    got = sorted(tuple(r) for r in A.audit(table(spark, rows), label_table(spark, labels)).collect())
    assert got == plain(rows, labels)


def test_hot_text_and_nothing(spark):
    rows = [(i, "same text", "hot") for i in range(400)] + [(None, "same text", "hot")] * 50
    got = {(r.filter_order, r.step): r for r in A.audit(table(spark, rows), label_table(spark, [])).collect()}
    assert got["EABCD", 1].removed == 399 and got["EABCD", 2].removed == 51 and got["ABCDE", 5].redundant == 399
    assert A.audit(table(spark, []), label_table(spark, [])).collect() == []


def test_least_squares_gives_the_mean_over_orders():
    rng = random.Random(2)
    for k in (2, 3, 5):
        counts = [rng.randint(0, 50) for _ in range(1 << k)]
        removed = A.coalition_removals(counts)
        orders = list(permutations(range(k)))
        mean = [Fraction(0)] * k
        for order in orders:
            before = 0
            for i in order:
                mean[i] += Fraction(removed[before | 1 << i] - removed[before], len(orders))
                before |= 1 << i
        assert A.shapley_values(removed, k) == mean
