"""Decontamination builds each block of test items once."""

from __future__ import annotations

from vigil.llm import suffix


def test_blocks_are_counted_without_building_them(spark, monkeypatch):
    built, make = [], suffix.TestItems.__init__
    monkeypatch.setattr(suffix.TestItems, "__init__", lambda self, *a: built.append(1) or make(self, *a))
    items = spark.createDataFrame([(i, " ".join(f"t{i}x{j}" for j in range(20))) for i in range(8)], "item_id long, text string")
    rows = [(i, " ".join(f"t{i}x{j}" for j in range(20)), "a") for i in range(4)] + [(9, "clean words", "a"), (9, None, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size = sum(len(r.text) for r in items.collect())
    for block_bytes, n in ((1 << 20, 1), (300, -(-size // 300))):
        built.clear()
        got = sorted(map(tuple, suffix.decontaminate(docs, items, block_bytes=block_bytes).collect()), key=str)
        assert got == sorted(rows[4:], key=str) and len(built) == n
    assert n > 1
