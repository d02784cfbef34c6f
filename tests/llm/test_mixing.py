"""Mixing: every row stays, and the schedule spreads the sources."""

from __future__ import annotations

import math

import pytest

from vigil.llm import mixing, queries


@pytest.mark.parametrize("empty_sources", [[], [(None, "", "b"), (None, "", "b"), (None, None, None), (None, None, None)]])
def test_repeated_empty_rows_stay(spark, empty_sources):
    rows = [(7, None, "a"), (7, "", "a"), (7, " \t", "a"), (8, "x y", "a"), (8, "x y", "a"), (None, "", "a"), (None, None, "a"), *empty_sources]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted(((r.doc_id, r["size"]) for r in mixing.mix_documents(df, block_words=1).collect()), key=str)
    assert got == sorted(((i, len((t or "").split())) for i, t, _ in rows), key=str)


def plain_schedule(slots):
    """(slot, sid, rank) by the golden ratio, a slot at a time"""
    n, taken, out = sum(slots), [0] * len(slots), []
    for i in range(n):
        u, at = math.fmod((i + 1) * mixing.GOLDEN, 1.0), 0
        for sid, s in enumerate(slots):
            if at / n <= u < (at + s) / n:
                if taken[sid] < s:
                    out.append((i, sid + 1, taken[sid]))
                taken[sid] += 1
            at += s
    return out + [(n, sid + 1, r) for sid, s in enumerate(slots) for r in range(taken[sid], s)]


@pytest.mark.parametrize("slots", [(1500, 1000, 503), (7, 0, 900, 1), (1,)])
def test_schedule_spreads_the_sources(spark, slots):
    targets = spark.createDataFrame([(i + 1, s) for i, s in enumerate(slots)], "sid long, slots long")
    got = sorted(map(tuple, mixing.schedule(targets, sum(slots)).collect()))
    assert got == sorted(plain_schedule(slots))
    # any run of slots has each source's share of them, give or take a few
    for sid, s in enumerate(slots):
        seen = [0]
        at = {slot for slot, x, _ in got if x == sid + 1 and slot < sum(slots)}
        for i in range(sum(slots)):
            seen.append(seen[-1] + (i in at))
        for width in (20, 100):
            assert all(abs(seen[i + width] - seen[i] - width * s / sum(slots)) <= 4 for i in range(sum(slots) - width))


def test_order_query_has_the_first_slot(spark, tmp_path):
    rows = [(i, "w " * (300 + 40 * i), f"s{i % 3}") for i in range(30)] + [(99, "", "s0")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op9_mixing_order"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and all((r.first_slot is not None) == (r.taken > 0) for r in got)
    # the sources' first documents come early, not one source after the other
    first = {s: min(r.first_slot for r in got if r.taken and f"s{r.doc_id % 3}" == s) for s in ("s0", "s1", "s2")}
    assert max(first.values()) < 30 < max(r.first_slot for r in got if r.taken)
