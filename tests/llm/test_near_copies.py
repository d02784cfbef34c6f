"""One of each group of near copies stays, row by row."""

from __future__ import annotations

import os
import random
import sys

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

from vigil.llm import ngram_join  # noqa: E402


def test_reused_ids_lose_only_copies(spark):
    rng = random.Random(11)
    a, b, c, d = (" ".join(f"w{rng.randint(0, 10 ** 6)}" for _ in range(60)) for _ in range(4))
    # id 5: a near copy of id 1, a text of its own and its exact repeat; id 6: two texts; id 7: a copy of 5's own text
    rows = [(1, a), (5, a + " more"), (5, b), (5, b), (6, c), (6, d), (7, b + " more"), (8, "!"), (8, ""), (8, None), (None, a), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in ngram_join.keep_one_of_each(df).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (5, b), (6, c), (6, d), (8, "!"), (8, ""), (8, None), (None, a), (None, a)], key=str)
    unique = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    comps = brute.jaccard_components([(i, t) for i, (_, t) in enumerate(rows)])
    assert sorted(r.doc_id for r in ngram_join.keep_one_of_each(unique).collect()) == [i for i, n, own in comps if n == 0 or own == i]
