"""Language identification against plain rank-order profiles."""

from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

from vigil.llm import langid  # noqa: E402

VOCABULARY = {
    "en": "the quick brown fox thinks that this is other and nothing".split(),
    "de": "der schnelle braune fuchs denkt dass dies nicht ist und größer".split(),
    "es": "el rápido zorro marrón piensa que esto no es nada y señor".split(),
}


def rows(seed=1):
    rng = random.Random(seed)
    out = [(i, " ".join(rng.choice(VOCABULARY[lang]) for _ in range(rng.randint(1, 40))), lang)
           for i, lang in enumerate(rng.choice(list(VOCABULARY)) for _ in range(90))]
    half = lambda a, b: " ".join(w for pair in zip(VOCABULARY[a], VOCABULARY[b]) for w in pair)
    out += [(100, None, "en"), (101, "12 !!", "de"), (None, "the fox", "en"), (102, "", None), (103, "ÉTÉ Straße İ ǅ", None), (104, half("en", "de"), "en"),
            (105, "日本語 текст", None), (7, out[7][1], out[7][2]), (7, "an other text", "en"), (106, "a b a b", "de"), (107, "zzz " * 5000, None)]
    return out


def frame(spark, held):
    return spark.createDataFrame([(i, t, lang, "x", 0.5, 1) for i, t, lang in held], "doc_id long, text string, lang string, lang_pred string, score double, c0 int")


@pytest.mark.parametrize("ranks", [300, 20])
def test_predictions_equal_plain_profiles(spark, ranks):
    held = rows()
    df = frame(spark, held)
    got = langid.identify(df, langid.learn_profiles(df, ranks=ranks), keep=["doc_id"]).collect()
    want = [(i, lang, round(score, 9), round(margin, 9)) for (i, _, _), (lang, score, margin) in zip(held, brute.languages(held, ranks))]
    assert sorted(((r.c0, r.lang_pred, round(r.score, 9), round(r.margin, 9)) for r in got), key=str) == sorted(want, key=str)


def test_stage_follows_the_profiles(spark):
    held = rows()
    df = frame(spark, held)
    told = brute.languages(held)
    for score, margin in ((langid.MIN_SCORE, langid.MIN_MARGIN), (0.5, 0.2)):
        kept = langid.keep_identified(df, min_score=score, min_margin=margin)
        want = [(i, t, lang) for (i, t, _), (lang, s, m) in zip(held, told) if lang != "und" and s >= score and m >= margin]
        assert kept.columns == df.columns
        assert sorted(((r.doc_id, r.text, r.lang) for r in kept.collect()), key=str) == sorted(want, key=str)
        assert 0 < len(want) < sum(lang != "und" for lang, _, _ in told)


def test_nothing_to_learn(spark):
    df = frame(spark, [(1, "a text", None), (2, None, "en")])
    assert {(r.lang_pred, r.score) for r in langid.predict_languages(df).collect()} == {("und", 0.0)}
    assert langid.predict_languages(df.limit(0)).collect() == [] and langid.keep_identified(df).collect() == []
