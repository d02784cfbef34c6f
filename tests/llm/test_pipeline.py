"""The corpus pipeline against a plain version of its five stages."""

from __future__ import annotations

import hashlib
import math
import os
import random
import sys
import zlib

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import public_tokenizers  # noqa: E402

import corpus_pipeline  # noqa: E402


def near_copies(rows):
    kept = brute.jaccard_components([(i, t) for i, t, _ in rows])
    return [r for r, (i, n, own) in zip(rows, kept) if n == 0 or own == i]


def targets(sizes, weights=(5, 2, 1), epochs=1.5, most=2):
    """words by source: weights share all, no source above ``most`` times its words"""
    names = sorted(sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = epochs * sum(sizes.values()), list(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if most * sizes[s] < level * weight[s]]
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
            open_.remove(s)
    return out


def golden_slots(shares):
    """slot of each (source, rank): the points of the golden ratio, one by one"""
    total = sum(n for _, n in shares)
    got, out = dict.fromkeys((s for s, _ in shares), 0), {}
    for slot in range(total):
        u, at = math.fmod((slot + 1) * 0.6180339887498949, 1.0), 0
        for s, n in shares:
            if at / total <= u < (at + n) / total:
                out[s, got[s]] = slot
                got[s] += 1
            at += n
    return {(s, r): out.get((s, r), total) for s, n in shares for r in range(n)}


def mixed(rows, block_words=256):
    """(id, text) taken, in the order of the schedule: whole passes of a source,
    the last cut after its last block; a copy stands where the slot of the
    block with its first word does"""
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    streams = {}
    for key, i, text, source in sorted((md5(f"{i}:{md5(t)}"), i, t, s) for i, t, s in rows):
        streams.setdefault(source, []).append((key, i, text))
    sizes = {s: sum(len(brute.SPACED.findall(t)) for _, _, t in x) for s, x in streams.items()}
    blocks = {s: math.ceil(n / block_words) for s, n in sizes.items()}
    shares = [(s, math.floor(target * blocks[s] / sizes[s] + 0.5)) for s, target in sorted(targets(sizes).items())]
    slots = golden_slots(shares)
    out = []
    for s, share in shares:
        bounds, n = [0], sizes[s]
        for b in range(blocks[s]):
            bounds.append(bounds[-1] + n // blocks[s] + (b < n % blocks[s]))
        for turn in range(-(-share // blocks[s])):
            words = bounds[min(blocks[s], share - turn * blocks[s])]
            at = 0
            for key, i, text in streams[s]:
                ends = [m.end() for m in brute.SPACED.finditer(text)]
                take = min(len(ends), max(0, words - at))
                if take:
                    block = max(b for b in range(blocks[s]) if bounds[b] <= at)
                    out.append((slots[s, turn * blocks[s] + block], key, turn, i, text if take == len(ends) else text[:ends[take - 1]]))
                at += len(ends)
    return [(i, text) for _, _, _, i, text in sorted(out)]


def test_pipeline_equals_its_plain_version(spark, tmp_path):
    from tokenizers import Tokenizer
    rng = random.Random(21)
    tongue = {"en": ["lorem", "don't", "two,", "thing"], "fr": ["été", "voilà", "rouge,", "chien"]}
    prose = lambda n, lang="en": " ".join(rng.choice(tongue[lang]) + str(rng.randint(0, 99)) for _ in range(n))
    items = [(1, prose(30)), (2, prose(20))]
    rows = [(i, prose(rng.randint(40, 200), "en" if i % 2 else "fr"), rng.choice(["a", "b", "b", "c", "d"])) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " one more", "a") for i in range(5)] + [(110, rows[9][1], "b"), (111, rows[9][1], "c")]
    rows += [(121, prose(40) + " " + items[0][1], "a"), (123, items[1][1], "b"), (125, prose(4000) + " " + items[1][1].split()[0], "c")]
    rows += [(130, "12 34 !!", "a"), (131, "", "b"), (132, None, "c"), (141, "qqq " * 30, "a"), (143, "lorem été " * 9, "b"), (145, "zéz wik " * 40, "a")]
    lang = lambda i: None if i > 140 else "en" if i % 2 else "fr"
    spark.createDataFrame([(i, t, lang(i), s, len(t or "")) for i, t, s in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    told = brute.languages([(i, t, lang(i)) for i, t, _ in rows])
    known = [r for r, (name, score, margin) in zip(rows, told) if name != "und" and score >= 0.3 and margin >= 0.01]
    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    single = near_copies(known)
    bad = {r[0] for r in brute.decontamination([(i, t) for i, t, _ in single], items) if r[5]}
    clean = [r for r in single if r[0] not in bad]
    assert len(rows) > len(lettered) > len(known) > len(single) > len(clean) and {121, 123} <= bad
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [(i, t.encode(text, add_special_tokens=False).ids + [0]) for i, text in mixed(clean)]

    got = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want]
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    order = [r.doc_id for r in got]
    assert order != sorted(order) and len({s for i in order[:12] for j, _, s in rows if i == j}) > 2


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
