"""Scoring plans that mix kinds of features, packed weights, callers' models."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil import schemas
from vigil.operators import classify as C
from vigil.sources.config import literal_table

MODELS = [
    (1, "words", "w", "nb", "tfidf", False, None, None), (2, "vectors", "v", "lr", "embeddings", False, None, None),
    (3, "both", "b", "nb", "tfidf", True, "lr", "embeddings"), (4, "two vectors", "vv", "lr", "embeddings", True, "nb", "embeddings"),
    (5, "own", "o", "lr", "tfidf", True, "lr", "tfidf"),
]
WORDS = [("good", 1.0, 2.0), ("bad", 2.0, -1.0), (None, None, 0.25)]
VECTOR = {2: (0.5, [1.0, -2.0, 0.5]), 4: (-1.0, [0.1, 0.2, 0.3])}
TEXTS = {1: "good good bad", 2: "nothing known", 3: None, 4: "bad"}
VECTORS = {1: [0.5, 0.25, -1.0], 2: [0.0, 0.0, 0.0], 3: [1.0, 1.0, 1.0], 4: None}

sig = lambda x: 1 / (1 + math.exp(-x))


def by_words(text):
    if text is None:
        return None
    v = [(text.split().count(t) * idf, w) for t, idf, w in WORDS if t]
    norm = math.sqrt(sum(x * x for x, _ in v))
    return sig(0.25 + (sum(x * w for x, w in v) / norm if norm else 0.0))


def by_vector(vec, model):
    bias, w = VECTOR[model]
    return None if vec is None else sig(bias + sum(a * b for a, b in zip(vec, w)))


def product(a, b):
    return None if a is None or b is None else a * b


@pytest.fixture
def parts(spark):
    projects = literal_table(spark, [(p, f"p{p}", None, None, None, None, None, 0.0, p) for p in range(1, 6)], schemas.PROJECT)
    models = literal_table(spark, MODELS, schemas.MODEL)
    rows = [(m, st, t, idf, w) for m, st in ((1, 1), (3, 1)) for t, idf, w in WORDS]
    for m, st, source in ((2, 1, 2), (3, 2, 2), (4, 1, 2), (4, 2, 4)):
        bias, w = VECTOR[source]
        rows += [(m, st, str(i + 1), None, x) for i, x in reversed(list(enumerate(w)))] + [(m, st, None, None, bias)]
    terms = literal_table(spark, rows, schemas.MODEL_TERMS)
    stories = spark.createDataFrame([(i, p, t) for i, t in TEXTS.items() for p in range(1, 6)], "story_id long, project_id long, story_text string")
    vectors = spark.createDataFrame(list(VECTORS.items()), "story_id long, embedding array<float>")
    return stories, projects, models, terms, vectors


def own_scorer():
    def scorer(stage, batch):       # defined here, so that it travels to the tasks by value
        n = np.array([len(t) for t in batch.column("text").to_pylist()], float)
        return np.where(n > 12, np.nan, n / 20 / stage)
    return scorer


@pytest.mark.parametrize("separate_texts", [True, False])
def test_every_kind_of_stage_in_one_plan(spark, parts, separate_texts):
    stories, projects, models, terms, vectors = parts
    texts = stories.select("story_id", "story_text").distinct() if separate_texts else None
    given = stories.drop("story_text") if separate_texts else stories
    got = {(r.story_id, r.project_id): (r.model_1_score, r.model_2_score, r.model_score)
           for r in C.score(given, projects, models, terms, texts=texts, vectors=vectors, scorers={5: own_scorer()}).collect()}
    assert len(got) == 20
    for i, text in TEXTS.items():
        vec = VECTORS[i]
        w, v2, v4 = by_words(text), by_vector(vec, 2), by_vector(vec, 4)
        own = None if text is None or len(text) > 12 else len(text) / 20
        want = {1: (None, None, w), 2: (None, None, v2), 3: (w, v2, product(w, v2)), 4: (v2, v4, product(v2, v4)),
                5: (own, own and own / 2, product(own, own and own / 2))}
        for p, scores in want.items():
            assert [x and pytest.approx(x, abs=1e-12) for x in scores] == list(got[i, p]), (i, p)


def test_embedding_only_models_need_no_text(spark, parts):
    stories, projects, models, terms, vectors = parts
    got = C.score(stories.filter("project_id = 2"), projects.filter("project_id = 2"), models, terms, vectors=vectors).collect()
    assert {r.story_id: r.model_score is None for r in got} == {1: False, 2: False, 3: False, 4: True}


def test_vectors_of_another_length_stop(spark, parts):
    stories, projects, models, terms, _ = parts
    short = spark.createDataFrame([(1, [1.0])], "story_id long, embedding array<float>")
    with pytest.raises(Exception, match="a vector of 1 dimensions for a model of 3"):
        C.score(stories, projects.filter("project_id = 2"), models, terms, vectors=short).collect()


def test_missing_features_and_weights_stop(spark, parts):
    stories, projects, models, terms, vectors = parts
    with pytest.raises(C.ModelConfigError, match="model 2 stage 1: embeddings features, but no vectors"):
        C.score(stories, projects.filter("project_id = 2"), models, terms)
    with pytest.raises(C.ModelConfigError, match="model 3 stage 2: no weights"):
        C.score(stories, projects.filter("project_id = 3"), models, terms.filter("NOT (model_id = 3 AND stage = 2)"), vectors=vectors)
    with pytest.raises(C.ModelConfigError, match="model 5 stage 1: no weights"):
        C.score(stories, projects.filter("project_id = 5"), models, terms)
    with pytest.raises(Exception, match="the scorer of model 5 gave"):
        C.score(stories, projects.filter("project_id = 5"), models, terms, scorers={5: lambda stage, batch: [0.5]}).collect()


def test_packed_weights_keep_their_order(spark):
    rows = [(7, 1, str(i + 1), None, float(i)) for i in range(64)][::-1] + [(7, 1, None, None, 3.0)]
    r = C.pack_weights(literal_table(spark, rows, schemas.MODEL_TERMS).repartition(5)).first()
    assert (r.bias, list(r.weights)) == (3.0, [float(i) for i in range(64)])


def test_no_stories_and_no_projects(spark, parts):
    stories, projects, models, terms, vectors = parts
    assert C.score(stories.limit(0), projects.filter("project_id < 5"), models, terms, vectors=vectors).collect() == []
    assert C.score(stories, projects.limit(0), models, terms).collect() == []


def test_logistic_steps_equal_plain_gradient_descent(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "common"], 6)) for _ in range(40)]
    labels = [int("alpha" in t) if i % 9 else None for i, t in enumerate(texts)]
    rows = [(i, t, y) for i, (t, y) in enumerate(zip(texts, labels))] + [(100, None, 1), (101, "", 0), (102, "common common", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, y int")
    got = {r.term: r.weight for r in C.fit_logistic_steps(df, "y", steps=5, rate=1.5, reg=0.1).collect()}

    used = [(t.split(), y) for _, t, y in rows if t is not None and y is not None]
    n = len(used)
    vocabulary = sorted({w for t, _ in used for w in t})
    idf = {w: math.log((n + 1) / (sum(w in t for t, _ in used) + 1)) for w in vocabulary}
    x = np.array([[t.count(w) * idf[w] for w in vocabulary] for t, _ in used])
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    y, w, b = np.array([y for _, y in used], float), np.zeros(len(vocabulary)), 0.0
    for _ in range(5):
        r = 1 / (1 + np.exp(-(x @ w + b))) - y
        w, b = w - 1.5 * (x.T @ r / n + 0.1 * w), b - 1.5 * r.mean()
    assert got == {None: pytest.approx(b), **{v: pytest.approx(z) for v, z in zip(vocabulary, w)}}


def test_logistic_steps_separate_classes(spark):
    rows = [(i, "good " * (1 + i % 3) + "news" if i % 2 else "bad " * (1 + i % 3) + "news", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, y int")
    w = {r.term: r.weight for r in C.fit_logistic_steps(df, "y").collect()}
    assert w["good"] > 0 > w["bad"] and abs(w["news"]) < 1e-9 and set(w) == {None, "good", "bad", "news"}


def test_weights_of_frequent_terms_stay_and_rare_ones_move(spark, monkeypatch):
    terms = [(1, 1, t, idf, w) for t, idf, w in (("the", 0.1, 0.5), ("cat", 1.0, -2.0), ("sat", 1.5, 3.0), ("rarely", 4.0, 1.0))]
    terms += [(m, st, t, 2 * idf, -w) for m, st in ((2, 1), (2, 2)) for _, _, t, idf, w in terms[:4] if t != "sat"]
    terms += [(m, st, None, None, b) for m, st, b in ((1, 1, 0.25), (2, 1, -0.5), (2, 2, 0.0))]
    weights = spark.createDataFrame(terms, "model_id long, stage int, term string, idf double, weight double")
    texts = {1: "the cat sat the cat", 2: "rarely the unknown word", 3: "unknown only", 4: "rarely rarely sat", 5: "the cat"}
    stories = spark.createDataFrame(list(texts.items()), "story_id long, story_text string")
    asked = [(1, 1, 1), (1, 2, 1), (1, 2, 2), (2, 1, 1), (3, 2, 1), (4, 2, 1), (4, 1, 1)]
    pairs = spark.createDataFrame(asked, "story_id long, model_id long, stage int")
    counts = C.term_counts(stories, "story_id", "story_text", pairs.select(F.col("story_id").alias("__id")).distinct())
    assert {r.story_id for r in counts.collect()} == {1, 2, 3, 4}      # the text of 5 is not asked for

    def plain(story, model, stage):
        known = {t: (idf, w) for m, st, t, idf, w in terms if (m, st) == (model, stage) and t is not None}
        bias = next(w for m, st, t, _, w in terms if (m, st, t) == (model, stage, None))
        v = [(known[t][0], known[t][1]) for t in texts[story].split() if t in known]
        tf = {k: v.count(k) for k in v}
        norm = math.sqrt(sum((n * k[0]) ** 2 for k, n in tf.items()))
        return 1 / (1 + math.exp(-(bias + (sum(n * k[0] * k[1] for k, n in tf.items()) / norm if norm else 0))))

    for size, in_head in ((1 << 20, 4), (250, 1), (10, 0)):     # all terms, one, none in the broadcast part
        monkeypatch.setattr(C, "HEAD_BYTES", size)
        head, tail = C.packed_terms(weights.filter("term IS NOT NULL"))
        assert head.count() == in_head and (tail is None if in_head == 4 else tail.count() == 4 - in_head)
        got = {(r.story_id, r.model_id, r.stage): r.p for r in C.stage_scores(pairs, counts, weights).collect()}
        assert set(got) == set(asked)
        for k in asked:
            assert got[k] == pytest.approx(plain(*k), abs=1e-12), (size, k)


def test_fit_is_the_same_however_many_terms_are_broadcast(spark, monkeypatch):
    train = spark.createDataFrame([(1, "the cat sat", 1, None), (2, "the dog sat sat", 0, 1), (3, "the bird", None, 0), (4, "cat dog the", 1, 1),
                                   (4, "the the owl", 0, 0), (5, None, 1, 1)], "doc_id long, text string, quality int, toxic int")
    fits = []
    for size in (1 << 20, 150, 10):
        monkeypatch.setattr(C, "HEAD_BYTES", size)
        fits.append({(r.stage, r.term): (r.idf, r.weight) for r in C.fit_naive_bayes_labels(train, {"quality": (1, 1), "toxic": (1, 2)}).collect()})
    assert len(fits[0]) == 13
    for other in fits[1:]:
        assert set(other) == set(fits[0])
        for k, (idf, weight) in fits[0].items():
            assert other[k][1] == pytest.approx(weight, abs=1e-12) and (idf is None or other[k][0] == pytest.approx(idf, abs=1e-12))
