"""The join-based matcher against the per-row builders, the weight-table
scorer against Spark ML, streams against their batch twins."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from vigil import schemas
from vigil.operators import classify as C
from vigil.operators import search as S
from vigil.plans import class_queries as CQ
from vigil.plans import feed_queries as FQ
from vigil.plans import search_queries as SQ
from vigil.plans import stream_queries as STQ
from vigil.sources import fixtures
from vigil.sources.tables import table


def test_matcher_equals_builders(spark):
    docs = SQ._docs(spark, SMALL)
    got = {(r.project_id, r.doc_id) for r in S.match_projects(docs, fixtures.project_terms(spark)).collect()}
    d = docs.withColumn("tokens", S.search_tokens()).withColumn("title_tokens", S.tokens(F.col("title")))
    preds = {
        0: S.all_of(S.term("thing"), S.any_of(S.term("erre"), S.term("eran"))),
        1: S.phrase("the thing"), 2: S.prefix("ered"),
        3: S.all_of(S.term("para"), S.term("las"), S.none_of(S.term("no"))),
        4: S.wildcard("er?e"), 5: S.all_of(S.term("le"), S.term("des")),
        6: S.any_of(S.term("der"), S.term("die")), 7: S.near("thing", "erre", 5),
        8: S.fuzzy("thong", 1), 9: S.term("the", on="title_tokens"),
    }
    want = set()
    for pid, p in preds.items():
        want |= {(pid, r.doc_id) for r in d.filter(p).select("doc_id").collect()}
    assert got == want and len(got) > 0


def test_fuzzy_two_edits(spark):
    docs = spark.createDataFrame([(1, "t", "the thong"), (2, "t", "thing"), (3, "t", "thinks"), (4, "t", "tango")],
                                 "doc_id long, title string, story_text string").withColumn("language", F.lit("en"))
    terms = spark.createDataFrame([(0, 1, False, "fuzzy2", "thong")], fixtures.schemas.PROJECT_TERMS)
    got = sorted(r.doc_id for r in S.match_projects(docs, terms).collect())
    want = sorted(r.doc_id for r in docs.withColumn("tokens", S.search_tokens())
                  .filter(S.fuzzy("thong", 2)).collect())
    assert got == want == [1, 2]


def test_naive_bayes_weights_equal_spark_ml(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IDF, CountVectorizer, Normalizer, RegexTokenizer
    train = CQ.training(spark, SMALL).filter(F.col("text").isNotNull())
    mt = C.fit_naive_bayes(train, "quality", model_id=1)
    stories = train.select(F.col("doc_id").alias("story_id"), F.col("text").alias("story_text"))
    counts = C.term_counts(stories, "story_id", "story_text")
    sm = stories.select("story_id", F.lit(1).cast("long").alias("model_id"), F.lit(1).alias("stage"))
    ours = {r.story_id: r.p for r in C.stage_scores(sm, counts, mt).collect()}
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="tok", gaps=False, pattern=r"[\p{L}\p{N}]{2,}"),
        CountVectorizer(inputCol="tok", outputCol="tf", vocabSize=1 << 18), IDF(inputCol="tf", outputCol="ti"),
        Normalizer(inputCol="ti", outputCol="x"),
        NaiveBayes(featuresCol="x", labelCol="label", smoothing=1.0, modelType="multinomial")])
    m = pipe.fit(train.withColumn("label", F.col("quality").cast("double")))
    ml = {r.doc_id: float(r.probability[1]) for r in m.transform(train).select("doc_id", "probability").collect()}
    assert set(ours) == set(ml)
    assert max(abs(ours[k] - ml[k]) for k in ours) < 1e-9


def test_logistic_regression_export_equals_pipeline(spark):
    train = CQ.training(spark, SMALL).filter(F.col("text").isNotNull())
    mt = C.fit_logistic_regression(train, "quality", model_id=5)
    stories = train.select(F.col("doc_id").alias("story_id"), F.col("text").alias("story_text"))
    counts = C.term_counts(stories, "story_id", "story_text")
    sm = stories.select("story_id", F.lit(5).cast("long").alias("model_id"), F.lit(1).alias("stage"))
    p = C.stage_scores(sm, counts, mt).collect()
    assert len(p) == train.count() and all(0.0 < r.p < 1.0 for r in p)


def test_chained_scores_multiply(spark):
    s = CQ.scored(spark, SMALL).collect()
    chained = [r for r in s if r.model_id == 3]
    single = [r for r in s if r.model_id != 3]
    assert chained and single
    assert all(abs(r.model_score - r.model_1_score * r.model_2_score) < 1e-12 for r in chained)
    assert all(r.model_1_score is None and r.model_2_score is None for r in single)


def test_stream_equals_batch(spark):
    batch = {(r.feed_pos, r.url) for r in FQ.deduped(spark, SMALL).select("feed_pos", "url").collect()}
    stream = {(r.feed_pos, r.url) for r in STQ.q_stream_replay_safe_log(spark, SMALL).collect()}
    assert batch == stream


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["project_id", "batch_no", "n_stories"]
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_edge_searches_equal_builders(spark):
    docs = spark.createDataFrame(
        [(1, "", "the big other thing"), (2, "", "big thing"), (3, "", "woman killed"), (4, "", "zebra a woman killed b"),
         (5, "", "killed x x x x x woman zebra"), (6, "", "axb (ban 12"), (7, "the the", "urban"), (8, None, None),
         (9, "", "the a the thing"), (10, "", "a " + " ".join(f"w{i}" for i in range(100)))],
        "doc_id long, title string, story_text string").withColumn("language", F.lit("en"))
    long_phrase = " ".join(f"w{i}" for i in range(100))
    cases = [
        ("near5", "woman killed zebra", S.near("woman", "killed", "zebra", 5)), ("near3", "the the thing", S.near("the", "the", "thing", 3)),
        ("near", "killed woman", S.near("killed", "woman", 1)), ("near5", "zebra", S.term("zebra")),
        ("wildcard", "*ban", S.wildcard("*ban")), ("wildcard", "*xb", S.wildcard("*xb")), ("wildcard", "*rb*", S.wildcard("*rb*")),
        ("wildcard", "*[xy]b", S.wildcard("*[xy]b")), ("wildcard", "*(ban", S.wildcard("*(ban")), ("wildcard", "*.b*", S.wildcard("*.b*")),
        ("wildcard", "??", S.wildcard("??")), ("wildcard", "*", S.wildcard("*")), ("prefix", "ur?", S.prefix("ur?")),
        ("prefix", "ur", S.prefix("ur")), ("term", "woman killed", S.term("woman killed")), ("phrase", long_phrase, S.phrase(long_phrase)),
        ("title:wildcard", "?he", S.wildcard("?he", on="title_tokens")), ("phrase", "--", S.phrase("--")),
    ]
    terms = [(i, 1, False, k, t) for i, (k, t, _) in enumerate(cases)]
    # alternatives of one clause never complete each other
    terms += [(100, 1, False, "phrase", "big thing"), (100, 1, False, "phrase", "the other"), (100, 1, False, "phrase", "big thing")]
    got = {(r.project_id, r.doc_id) for r in S.match_projects(docs, spark.createDataFrame(terms, fixtures.schemas.PROJECT_TERMS)).collect()}
    d = docs.withColumn("tokens", S.search_tokens()).withColumn("title_tokens", S.tokens(F.coalesce("title", F.lit(""))))
    want = {(100, 2)}
    for i, (_, _, pred) in enumerate(cases):
        want |= {(i, r.doc_id) for r in d.filter(pred).select("doc_id").collect()}
    assert got == want
    assert {x for x in got if x[0] in (0, 1, 4, 15)} == {(0, 4), (1, 7), (1, 9), (4, 6), (4, 7), (15, 10)} - {(1, 7)}


def test_unknown_clause_kind_is_an_error(spark):
    docs = spark.createDataFrame([(1, "t", "x", "en")], "doc_id long, title string, story_text string, language string")
    with pytest.raises(ValueError):
        S.match_projects(docs, spark.createDataFrame([(0, 1, False, "regex", "x")], fixtures.schemas.PROJECT_TERMS))


def test_a_phrase_of_frequent_words_moves_one_row_per_document(spark):
    """Occurrences of a phrase's and a near clause's words do not leave their document."""
    rows = [(0, 1, False, "phrase", " ".join(["the thing"] * 50)), (1, 1, False, "near8", "the the thing"), (2, 1, False, "title:wildcard", "*e")]
    terms = spark.createDataFrame(rows, schemas.PROJECT_TERMS)
    docs = spark.createDataFrame([(1, "en", "no", " ".join(["the thing"] * 300)), (2, "en", "one", "the thing the x thing"),
                                  (3, "en", "no", "the " + "x " * 9 + "the thing one")], "doc_id long, doc_lang string, title string, text string")
    meta = S.search_meta(terms)
    toks = S._tokenised(docs, "title", "text", meta)
    index = S.clause_index(toks, S.clause_keys(terms, meta["edits"]), meta)
    got = sorted((r.project_id, r.doc_id) for r in S._hits(toks, index).collect())
    assert got == [(0, 1), (1, 1), (1, 2), (2, 2)]


def test_equal_rows_of_one_id_count_their_words_together(spark):
    terms = spark.createDataFrame([(0, 1, False, "near3", "the the thing")], schemas.PROJECT_TERMS)
    docs = spark.createDataFrame([(1, "a thing the"), (1, "a thing the"), (2, "a thing the"), (3, "the the thing")], "doc_id long, text string")
    docs = docs.select("doc_id", F.lit("en").alias("language"), F.lit("").alias("title"), F.col("text").alias("story_text"))
    assert sorted(r.doc_id for r in S.match_projects(docs, terms).collect()) == [1, 3]
