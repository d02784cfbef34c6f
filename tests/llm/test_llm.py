"""The training-data operators against plain versions of their contracts."""

from __future__ import annotations

import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import public_tokenizers  # noqa: E402

from vigil.llm import langid, licenses, lines, mixing, ngram_join, records, subword, suffix, tokencount, urlfilter  # noqa: E402
from vigil.llm import textkernel as K  # noqa: E402

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (4, "one two"), (5, "!!! ???"), (None, "a b c d e f g"), (6, "é" * 9)]


def docs(spark, rows, more=True):
    """documents with clashing extra columns"""
    schema = "doc_id long, text string, lang string, source string, n_chars long" + (", id string, h long, size string, score string, row int" if more else "")
    full = [(i, t, "en" if (i or 0) % 2 else None, None if i == 5 else f"s{(i or 0) % 3}", len(t or "")) + (("x", 1, "y", "z", 2) if more else ()) for i, t in rows]
    return spark.createDataFrame(full, schema)


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]) + str(rng.randint(0, 40)) for _ in range(n))


def families(seed):
    """groups of near copies around the threshold, chains of them, and exact copies"""
    rng, rows = random.Random(seed), []
    for _ in range(6):
        base = prose(rng, rng.randint(30, 90)).split()
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"new{rng.randint(0, 10 ** 6)}"
            rows.append(" ".join(w))
            if rng.random() < 0.4:
                base = w
    rows += rows[:5]
    rng.shuffle(rows)
    return [(i + 10, t) for i, t in enumerate(rows)]


def test_ngram_join_equals_brute_force(spark):
    rows = families(3) + ODD
    got = [tuple(r) for r in ngram_join.ngram_jaccard_join(docs(spark, rows)).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(brute.jaccard_components(rows), key=key)


def test_ngram_join_of_nothing(spark):
    assert ngram_join.ngram_jaccard_join(docs(spark, [])).collect() == []


def test_block_product_finds_links():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 40, 200))
    sets = [base, np.append(base[:-4], [1, 2]), base[:100]]
    table = pa.table({"comp": [1, 2, 3], "block": [0, 0, 0], "shingles": pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))})
    assert ngram_join._block_links(table, 75, 100).to_pylist() == [{"u": 1, "v": 2}]


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_decontamination_equals_brute_force(spark, block_bytes):
    rng = random.Random(5)
    items = [(i, prose(rng, rng.randint(1, 40))) for i in range(12)] + [(100, None), (101, ""), (102, "... !"), (None, prose(rng, 20))]
    items.append((103, items[0][1]))
    rows = []
    for i in range(30):
        t = prose(rng, rng.randint(0, 80))
        if i % 2:
            it = (items[rng.randrange(12)][1] or "").split()
            a = rng.randrange(len(it))
            t = t + " " + " ".join(it[a:]).upper() + ", " + t
        rows.append((i + 10, t))
    rows += ODD
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = suffix.judge(suffix.verbatim_matches(docs(spark, rows), bench, block_bytes=block_bytes))
    got = [tuple(r) for r in found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
    key = lambda r: tuple(str(x) for x in r)
    want = brute.decontamination(rows, items)
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = suffix.decontaminate(docs(spark, rows), bench, block_bytes=block_bytes)
    assert kept.columns == docs(spark, rows).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in want if not r[5])


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 3, 60).astype(np.uint64)
    ends = np.where(np.arange(60) < 25, 25, 60)
    order = suffix.suffix_array(words, ends, 60)
    seqs = [tuple(words[i:ends[i]].tolist()) for i in order]
    assert seqs == sorted(seqs)


def test_language_profiles(spark):
    rng = random.Random(1)
    en, de = "the quick brown fox thinks that this is other".split(), "der schnelle braune fuchs denkt dass dies nicht ist".split()
    rows = [(i, " ".join(rng.choice(en if i % 2 else de) for _ in range(30)), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, None, "en"), (101, "12 !!", "de"), (None, "the fox", "en"), (102, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.predict_languages(df).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(60))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(60)) and got[None].held_out
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == 61
    assert langid.predict_languages(df.limit(0)).collect() == []


def test_language_grams_by_hand():
    data, off = K.string_parts(pa.array(["Ab a", "é1"]))
    row, code, alphabet = langid.grams(data, off)
    n = 0x1FFFFF
    want = [(0, (n, n, 97)), (0, (n, n, 98)), (0, (n, n, 97)), (0, (n, 0, 97)), (0, (n, 97, 98)), (0, (n, 98, 0)), (0, (n, 0, 97)),
            (0, (n, 97, 0)), (0, (0, 97, 98)), (0, (97, 98, 0)), (0, (0, 97, 0)),
            (1, (n, n, 233)), (1, (n, 0, 233)), (1, (n, 233, 0)), (1, (0, 233, 0))]
    value = langid.packed(code, alphabet)
    assert sorted(zip(row.tolist(), value.tolist())) == sorted((r, (a << 42) | (b << 21) | c) for r, (a, b, c) in want)


def test_token_counts(spark):
    import sentencepiece
    model, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), random.Random(2)
    parts = ["a", "the", "don't", "  ", " ", "\n", "é", "漢字", "<s>", "ing", " word", " of"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 300)))) for i in range(20)] + [(50, "x" * 700 + " y z" * 200), *ODD]
    got = tokencount.count_tokens(docs(spark, rows), PIECES, limit=100, chunk=64, overlap=8).collect()
    want = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((*w, w[2] > 100) for w in want), key=key)


def test_records_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer
    t, rng = Tokenizer.from_file(BYTE_BPE), random.Random(3)
    parts = ["a", "don't", "'s", "  ", " ", "\n", "\t", "é", "“", ",", "..", "12", "<|endoftext|>", "<|endo", "　", "漢", "\x1f", "x,y"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(40, 0, -1)] + [(90, None), (91, "")]
    got = [tuple(r) for r in records.write_and_read(docs(spark, rows), BYTE_BPE).orderBy("doc_id").collect()]
    start, want = 0, []
    for i, text in sorted(rows):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert records.write_and_read(docs(spark, []), BYTE_BPE).collect() == []
    assert len(records.write_and_read(docs(spark, ODD), BYTE_BPE).collect()) == len(ODD)


def test_damaged_records_are_found():
    r = records.frame(records.pack_ids(np.array([1, 70000]), 4))
    assert records.unpack_ids(records.unframe(r)).tolist() == [1, 70000]
    for i in range(len(r)):
        with pytest.raises(ValueError):
            records.unframe(r[:i] + bytes([r[i] ^ 1]) + r[i + 1:])


def test_mixing_reaches_targets_and_repeats(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(0, 120)), "big" if i % 3 else rng.choice(["a", "b", None])) for i in range(300)] + [(7, None, "a"), (7, "x y", "a"), (7, "x y", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_documents(df, block_words=16).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r["size"] for r in got)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_documents(df.repartition(5), block_words=16).collect()), key=str)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(v) - t) <= 17 for (_, t), v in by.items())
    assert sum(t for _, t in by) == pytest.approx(1.5 * sum(r["size"] for r in got))
    whole = mixing.mixed_documents(df.withColumn("n_chars", __import__("pyspark").sql.functions.length("text")), block_words=16).collect()
    assert sum(len(brute.SPACED.findall(r.text)) for r in whole) == sum(r.taken for r in got)
    assert mixing.mix_documents(df.limit(0)).collect() == []


def test_line_rules(spark):
    clean = "This is a plain sentence of words. It has a mark.\nAnother good line comes here, all fine.\nAnd so on it goes."
    rows = [(20, clean), (21, "Home | About | Contact us\n" * 3 + "One real sentence stands here alone."), (22, "a b c d e " * 6),
            (23, clean + "\n" + clean.split("\n")[0]), *ODD]
    got = {r.doc_id: r for r in lines.judge_lines(docs(spark, rows)).collect()}
    assert got[20].kept and not got[21].kept and got[22].base_failed and got[23].n_dup_lines == 1
    assert got[1].n_words == 0 and got[1].base_failed and not got[2].kept
    for i, t in rows:
        if i in (20, 21, 22, 23):
            w = brute.SPACED.findall(t)
            wins = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
            hit = {k + j for k, x in enumerate(wins) if wins.count(x) > 1 for j in range(5)}
            assert (got[i].n_words, got[i].n_repeat_words, got[i].word_chars) == (len(w), len(hit), sum(map(len, w)))
    assert [r.text.count("Home") for r in lines.clean_lines(docs(spark, [(20, clean + "\nHome")])).collect()] == [0]


def test_quality_classifier(spark):
    rng = random.Random(6)
    rows = [(i, ". ".join(prose(rng, 8) for _ in range(4)) if i % 2 else " ".join(x + "%%%" for x in prose(rng, 30).split())) for i in range(200)] + ODD[:3]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (900, None)], "doc_id long, quality int")
    df = docs(spark, [(None if i is None else i + (1000 if i < 4 and t in (None, "", " \t\n") else 0), t) for i, t in rows])
    model = subword.fit(df, labels, sample=120)
    got = subword.score(df, model).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 1000]
    assert held and all(r.predicted == r.doc_id % 2 for r in held)
    assert all(r.score == 0.5 for r in subword.score(df, subword.fit(df, labels.limit(0))).collect())


def test_url_rules_and_aliases(spark):
    rows = [(1, "http://EXAMPLE.com/en/a", None), (2, "https://www.example.com/en/a?x#y", ""), (3, "http://a.net/es/", None), (4, None, None), (5, "nonsense", ""),
            (6, "http://x.org/p?q=1", '<link rel="canonical" href="http://a.net/es/z">'), (7, "http://y.org/p", '<META http-equiv=refresh content="0; url=//x.org/p">'),
            (8, "http://z.org/p", "<link href='http://a.com/ok' rel=canonical>"), (9, "http://z.org/q", '<link rel="canonical" href="/p">'),
            (10, "http://z.org/q", '<link rel="canonical" href="http://b.net/fr/1">'), (11, "http://com", None), (12, "http://u.org", '<link rel="canonical" href="/">')]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("node", __import__("pyspark").sql.functions.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge_urls(df).collect()}
    assert got[1] == ("example.com", "/en/a", "example.com/en/", "block") and got[2][2:] == ("www.example.com/en/", "allow")
    assert got[3] == ("a.net", "/es/", "net/es/", "block") and got[4] == ("", "", None, "allow") == got[5]
    assert got[6][2:] == (None, "block") and got[7][2:] == (None, "block")          # through the chain of aliases
    assert got[8][3] == got[9][3] == got[10][3] == "allow"                          # an explicit allow goes first
    assert got[11] == ("com", "", None, "allow") and got[12][3] == "allow"
    assert urlfilter.judge_urls(df.limit(0)).collect() == []


def test_licenses_and_inheritance(spark):
    rows = [(1, "h/LICENSE", "Released under the MIT License."), (2, "h/a/b.py", "print()"), (3, "h/a/COPYING", "x\nLicensed under the Apache License, Version 2.0."),
            (4, "h/a/c/d.py", ""), (5, "h/e.py", "# Licensed under CC BY-NC 4.0."), (6, None, None), (7, "other/x", "the licence of nothing known at all whatsoever"),
            (8, "h/a/b.py", "print()")]
    df = spark.createDataFrame(rows, "id long, path string, text string")
    got = {r.id: (r.license, r.origin, r.inherited_from) for r in licenses.scan(df).collect()}
    assert got == {1: ("MIT", "own", None), 2: ("Apache-2.0", "inherited", "h/a/"), 3: ("Apache-2.0", "own", None), 4: ("Apache-2.0", "inherited", "h/a/"),
                   5: ("CC-BY-NC-4.0", "own", None), 6: (None, "none", None), 7: (None, "none", None), 8: ("Apache-2.0", "inherited", "h/a/")}
    assert licenses.scan(df.limit(0)).collect() == []
