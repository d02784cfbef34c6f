"""Classification: vectorise -> linear model -> probability -> chain (H1-H8).

Every supported model is linear in its features followed by a sigmoid:
multinomial naive Bayes on TF-IDF, logistic regression on TF-IDF, and a
linear model on embedding vectors.  So a model is a table of weights
(``model_terms``: model_id, stage, term, idf, weight; the row with a NULL
term holds the bias), and scoring is a join of story term counts with that
table followed by a grouped sum -- the same plan for one project or ten
thousand, with no model object shipped to executors and no Python per row.

A stage's features are term counts (TF-IDF) or a vector per story
(embeddings): ``score`` dispatches every stage to its own kind, in one plan,
and chained models may mix them.  Embedding weights are packed, one array per
(model, stage), so that a story's score is one ``zip_with`` / ``aggregate``
over its vector.  A caller's own model takes part as a function over Arrow
batches (``scorers``).

TF-IDF (fixed once, both engines): tokens ``[\\p{L}\\p{N}]{2,}`` lower-cased;
``tf`` raw count; ``idf = ln((N+1)/(df+1))`` over the training documents;
L2-normalised over in-vocabulary terms (a zero vector stays zero).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.text import FEATURE_TOKEN, tokens
from vigil.operators.common import bounded_broadcast, store, unbounded
from vigil.session import checkpoint_dir

MODEL_TYPES = ("lr", "nb")
VECTORIZER_TYPES = ("tfidf", "embeddings")


# A row per training document (id and numbers only) is broadcast up to this size.
NORM_BYTES = 64 * 1024 * 1024
# The weights of the most frequent terms are broadcast up to this size.
HEAD_BYTES = 64 * 1024 * 1024
RARITY_STEPS = 4096     # idf is told apart in steps of 1/64 when the most frequent terms are chosen


class ModelConfigError(RuntimeError):
    pass


# ---------------------------------------------------------------------------
# Features (H1)
# ---------------------------------------------------------------------------
def term_counts(df: DataFrame, id_col: str, text_col: str, asked: DataFrame | None = None) -> DataFrame:
    """``(id, term, tf)``: raw counts of feature tokens per document, of those
    only whose id is in ``asked`` (``__id``, distinct) if it is given.

    Texts are hash-partitioned by document id *before* tokenising: a text is
    smaller than its rows of distinct terms (a 2.5 KB story has ~150 of them
    at ~40 bytes each), so moving texts once is cheaper than shuffling term
    counts, and the counts come out partitioned by id -- per-document norms
    and the join with (story, model) pairs then need no further shuffle of
    the big side.
    """
    # tokenising is CPU-bound while AQE sizes shuffles by bytes, so the
    # partition count is set from the cluster: never fewer than twice its cores
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    rows = df.select(id_col, text_col).repartition(n, id_col)
    if asked is not None:
        # ids are hashed where the texts are (which are not sorted); an inner
        # join, because a semi-join would be planned below the repartition
        rows = rows.join(asked.hint("shuffle_hash"), F.col(id_col) == F.col("__id"))
    return (rows.select(id_col, F.explode(tokens(F.col(text_col), FEATURE_TOKEN)).alias("term"))
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def by_frequency(terms: DataFrame, idf: Column, row_bytes: Column, max_bytes: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """A stored table with a row per ``term``, in two parts: the most frequent
    terms (lowest ``idf``), as many as fit into ``max_bytes`` (``HEAD_BYTES``) in
    an executor's memory, and all others (None: there are none).  By far the most
    occurrences are of the former, whose rows may be broadcast."""
    left = HEAD_BYTES if max_bytes is None else max_bytes
    step = F.least(F.greatest(F.floor(F.coalesce(idf, F.lit(0.0)) * 64), F.lit(0)), F.lit(RARITY_STEPS - 1))
    sizes = terms.groupBy(step.alias("step")).agg(F.sum(F.octet_length("term") + row_bytes + 32).alias("n"))
    fits = -1
    for r in sizes.orderBy("step").collect():       # at most RARITY_STEPS rows
        left -= r.n
        if left < 0:
            return terms.filter(step <= fits), terms.filter(step > fits)
        fits = r.step
    return terms, None


def fit_idf(counts: DataFrame, n_docs: int, id_col: str) -> DataFrame:
    """``(term, idf)`` with ``idf = ln((N+1)/(df+1))``."""
    return (counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            .select("term", F.log((F.lit(n_docs) + 1.0) / (F.col("df") + 1.0)).alias("idf")))


def tfidf(counts: DataFrame, idf: DataFrame, id_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(id, [keys], term, x)``: L2-normalised TF-IDF over in-vocabulary terms."""
    v = counts.join(idf, [*keys, "term"]).withColumn("v", F.col("tf") * F.col("idf"))
    norm = v.groupBy(id_col, *keys).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    return (v.join(norm, [id_col, *keys])
            .select(id_col, *keys, "term", F.coalesce(F.col("v") / F.nullif("norm", F.lit(0.0)), F.lit(0.0)).alias("x")))


# ---------------------------------------------------------------------------
# Fitting (H8): naive Bayes by counting; logistic regression by gradient steps
# over grouped sums, or with Spark ML
# ---------------------------------------------------------------------------
def fit_naive_bayes(train: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
                    model_id: int = 1, stage: int = 1, smoothing: float = 1.0) -> DataFrame:
    """Multinomial naive Bayes on TF-IDF as weights (one binary label)."""
    return fit_naive_bayes_labels(train, {label_col: (model_id, stage)}, id_col, text_col, smoothing)


def fit_naive_bayes_labels(train: DataFrame, labels: dict[str, tuple[int, int]], id_col: str = "doc_id",
                           text_col: str = "text", smoothing: float = 1.0) -> DataFrame:
    """Multinomial naive Bayes on TF-IDF for several binary labels at once.

    For two classes the posterior is ``sigmoid(bias + sum_j x_j w_j)`` with
    ``w = ln(S1+a) - ln(T1+aV) - ln(S0+a) + ln(T0+aV)`` (S = per-class feature
    sum, T = its total, V = vocabulary size) and ``bias = ln(n1+a) - ln(n0+a)``;
    the same numbers Spark ML's NaiveBayes computes, found with aggregations.

    ``labels`` maps a label column to the ``(model_id, stage)`` its weights
    are written as.  The training texts are tokenised once; every label's
    training set is the rows where that label is not NULL, and each label gets
    its own document frequencies, norms and sums through conditional
    aggregates in the same passes.
    """
    names = list(labels)
    train = train.filter(F.col(text_col).isNotNull())
    y = train.select(id_col, *[F.col(c).alias(f"__y{i}") for i, c in enumerate(names)])
    stats = train.agg(*[a for i, c in enumerate(names) for a in (
        F.count(F.col(c)).alias(f"n{i}"), F.count_if(F.col(c) == 1).alias(f"p{i}"),
        F.count_if(F.col(c) == 0).alias(f"q{i}"))]).first()
    # three consumers (document frequencies, norms, sums): tokenise the
    # training texts once and read the counts back from the shared folder
    known = [F.col(f"__y{i}").isNotNull() for i in range(len(names))]
    # (the labels are hashed where the counts are, which are not sorted)
    counts = store(term_counts(train, id_col, text_col).join(y.hint("shuffle_hash"), id_col), "nb-counts")
    # document frequency over each label's own training rows
    idf = store(counts.groupBy("term").agg(*[a for i in range(len(names)) for a in (
        F.log((F.lit(stats[f"n{i}"]) + 1.0) / (F.count(F.col(f"__y{i}")) + 1.0)).alias(f"__idf{i}"),
        F.max(known[i].cast("int")).alias(f"__in{i}"))]), "nb-idf")
    # for the norms only the counts of rare terms move to their idf; x = tf *
    # idf / norm, so a term's sum of x is its idf times a sum of tf / norm,
    # which is taken where the counts are
    tfs = counts.select(id_col, "term", *[F.when(k, F.col("tf")).alias(f"__tf{i}") for i, k in enumerate(known)])
    head, tail = by_frequency(idf, reduce(F.least, [F.col(f"__idf{i}") for i in range(len(names))]), F.lit(16 * len(names)))
    v = tfs.join(F.broadcast(head), "term")
    if tail is not None:
        v = v.unionByName(tfs.join(F.broadcast(head.select("term")), "term", "left_anti").join(unbounded(tail), "term"))
    norms = v.groupBy(id_col).agg(*[F.sqrt(F.sum(F.pow(F.col(f"__tf{i}") * F.col(f"__idf{i}"), F.lit(2)))).alias(f"__n{i}")
                                    for i in range(len(names))])
    x = counts.join(bounded_broadcast(store(norms, "nb-norms"), NORM_BYTES), id_col)
    aggs = []
    for i in range(len(names)):
        xi = F.coalesce(F.col("tf") / F.nullif(F.col(f"__n{i}"), F.lit(0.0)), F.lit(0.0))
        aggs += [F.sum(F.when(F.col(f"__y{i}") == 1, xi).otherwise(0.0)).alias(f"__p{i}"),
                 F.sum(F.when(F.col(f"__y{i}") == 0, xi).otherwise(0.0)).alias(f"__q{i}")]
    sums = x.groupBy("term").agg(*aggs).join(unbounded(idf), "term")
    for i in range(len(names)):
        sums = (sums.withColumn(f"__s1_{i}", F.col(f"__p{i}") * F.col(f"__idf{i}"))
                .withColumn(f"__s0_{i}", F.col(f"__q{i}") * F.col(f"__idf{i}")).drop(f"__p{i}", f"__q{i}"))
    # the per-term sums are the fitted state: write them once too, so the
    # totals below and every later use read them instead of re-running the fit
    sums = store(sums, "nb-sums")
    tot = sums.agg(*[a for i in range(len(names)) for a in (
        F.sum(F.col(f"__s1_{i}") * F.col(f"__in{i}")).alias(f"t1_{i}"),
        F.sum(F.col(f"__s0_{i}") * F.col(f"__in{i}")).alias(f"t0_{i}"),
        F.sum(f"__in{i}").alias(f"v{i}"))]).first()
    a = smoothing
    out = None
    for i, c in enumerate(names):
        model_id, stage = labels[c]
        t1, t0, vsize = tot[f"t1_{i}"] or 0.0, tot[f"t0_{i}"] or 0.0, tot[f"v{i}"] or 0
        weight = (F.log(F.col(f"__s1_{i}") + a) - F.log(F.lit(t1 + a * vsize))
                  - F.log(F.col(f"__s0_{i}") + a) + F.log(F.lit(t0 + a * vsize)))
        bias = math.log(stats[f"p{i}"] + a) - math.log(stats[f"q{i}"] + a)
        terms = sums.filter(F.col(f"__in{i}") == 1).select(
            F.lit(model_id).cast("long").alias("model_id"), F.lit(stage).cast("int").alias("stage"),
            "term", F.col(f"__idf{i}").alias("idf"), weight.alias("weight"))
        bias_row = train.sparkSession.range(1).select(
            F.lit(model_id).cast("long").alias("model_id"), F.lit(stage).cast("int").alias("stage"),
            F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("idf"),
            F.lit(bias).alias("weight"))
        part = terms.unionByName(bias_row)
        out = part if out is None else out.unionByName(part)
    return out


def fit_logistic_regression(train: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
                            model_id: int = 1, stage: int = 1, reg_param: float = 0.01,
                            max_iter: int = 50, max_terms: int = 1 << 22) -> DataFrame:
    """Logistic regression on the same TF-IDF features, fitted with a Spark ML
    pipeline (distributed L-BFGS), exported as ``model_terms`` rows.  Every
    term of the training texts is a feature; more than ``max_terms`` distinct
    terms are an error, never a cut."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, CountVectorizer, Normalizer, RegexTokenizer

    train = train.filter(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()) \
        .select(F.col(text_col).alias("__text"), F.col(label_col).cast("double").alias("__label"))
    tokenizer = RegexTokenizer(inputCol="__text", outputCol="__tok", gaps=False, pattern=FEATURE_TOKEN, toLowercase=True)
    n_terms = tokenizer.transform(train).select(F.explode("__tok")).distinct().count()
    if n_terms > max_terms:
        raise ValueError(f"{n_terms} distinct terms; the weights of a fitted model pass through the driver, at most {max_terms} may")
    pipe = Pipeline(stages=[
        tokenizer,
        CountVectorizer(inputCol="__tok", outputCol="__tf", vocabSize=max(n_terms, 1)),
        IDF(inputCol="__tf", outputCol="__tfidf"),
        Normalizer(inputCol="__tfidf", outputCol="__x", p=2.0),
        LogisticRegression(featuresCol="__x", labelCol="__label", regParam=reg_param, maxIter=max_iter),
    ])
    fitted = pipe.fit(train)
    vocab = fitted.stages[1].vocabulary
    idf = fitted.stages[2].idf.toArray().tolist()
    lr = fitted.stages[4]
    coef = lr.coefficients.toArray().tolist()
    import pandas as pd
    spark = train.sparkSession
    # a fitted Spark ML model lives on the driver; its (at most max_terms) weights
    # are handed back as a table through Arrow
    pdf = pd.DataFrame({"model_id": model_id, "stage": stage, "term": list(vocab) + [None],
                        "idf": idf + [None], "weight": coef + [float(lr.intercept)]})
    schema = "model_id long, stage int, term string, idf double, weight double"
    return spark.createDataFrame(pdf, schema)


INTERCEPT = -1         # the number of the term every document has once; tokens count from 0


def fit_logistic_steps(train: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", model_id: int = 1,
                       stage: int = 1, steps: int = 8, rate: float = 2.0, reg: float = 0.01) -> DataFrame:
    """H8: logistic regression on the TF-IDF features by ``steps`` full-batch
    gradient steps, as ``model_terms`` rows.

    ``x = tf * idf / norm``, so the rows that a step reads are (id, t, tf),
    ``t`` being the term's number; idf is multiplied into the weights and the
    norm into the residuals.  A step is two joins and two grouped sums: the
    documents' margins under the current weights, for which the rows move to
    their terms, then per term the sum of residual times x, for which the
    residuals, a number per document, go to the rows (broadcast within
    ``NORM_BYTES``).  The weights are a table per step in the shared folder;
    neither they nor the features pass through the driver, and every term of
    the training texts has a weight.  Each ``x`` row is at most 1 long
    (normalised), so the loss is 0.5-smooth and steps below 4 descend.
    """
    train = train.filter(F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
    y = store(train.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")), "lr-labels")
    counts = store(term_counts(train, id_col, text_col).withColumnRenamed(id_col, "id"), "lr-counts")
    n = y.count()
    # terms are numbered once (the table is written, so the numbers stay)
    idf = store(fit_idf(counts, n, "id").withColumn("t", F.monotonically_increasing_id()), "lr-idf")
    rows = store(counts.join(unbounded(idf), "term").select("id", "t", F.col("tf").cast("int").alias("tf"), "idf"), "lr-features")
    v = F.col("tf") * F.col("idf")
    norm = rows.groupBy("id").agg(F.sqrt(F.sum(v * v)).alias("norm"))
    times = y.groupBy("id").agg(F.count(F.lit(1)).alias("times"))     # an id may have several rows
    docs = store(y.join(unbounded(times), "id").join(unbounded(norm), "id", "left").select(
        "id", "y", "times", F.coalesce(F.lit(1.0) / F.nullif("norm", F.lit(0.0)), F.lit(0.0)).alias("inv")), "lr-documents")
    rows = rows.drop("idf")
    start = F.lit(0.0).alias("weight")
    w = idf.select("t", "idf", start).unionByName(idf.sparkSession.range(1).select(
        F.lit(INTERCEPT).cast("long").alias("t"), F.lit(1.0).alias("idf"), start))
    for _ in range(steps):
        sums = rows.join(unbounded(w.select("t", (F.col("idf") * F.col("weight")).alias("c"))), "t").groupBy("id").agg(
            F.sum(F.col("tf") * F.col("c")).alias("s"))
        intercept = F.broadcast(w.filter(F.col("t") == INTERCEPT).select(F.col("weight").alias("b")))   # one row
        margin = F.coalesce(F.col("s"), F.lit(0.0)) * F.col("inv") + F.col("times") * F.col("b")
        residual = store(docs.join(unbounded(sums), "id", "left").crossJoin(intercept).withColumn("r", sigmoid(margin) - F.col("y")).select(
            "id", (F.col("r") * F.col("inv")).alias("q"), (F.col("r") * F.col("times")).alias("r")), "lr-residuals")
        slope = rows.join(bounded_broadcast(residual.select("id", "q"), NORM_BYTES), "id").groupBy("t").agg(F.sum(F.col("q") * F.col("tf")).alias("g"))
        slope = slope.unionByName(residual.agg(F.coalesce(F.sum("r"), F.lit(0.0)).alias("g")).select(F.lit(INTERCEPT).cast("long").alias("t"), "g"))
        g = F.col("idf") * F.col("g") / F.lit(float(max(n, 1)))
        shrink = F.when(F.col("t") == INTERCEPT, F.lit(0.0)).otherwise(F.lit(reg) * F.col("weight"))
        w = store(w.join(unbounded(slope), "t").select("t", "idf", (F.col("weight") - F.lit(rate) * (g + shrink)).alias("weight")), "lr-weights")
    w = w.drop("idf")
    return (w.join(unbounded(idf), "t", "left")
            .select(F.lit(model_id).cast("long").alias("model_id"), F.lit(stage).cast("int").alias("stage"), "term", "idf", "weight"))


def fit_centroid_embedding(train: DataFrame, label_col: str, vec_col: str = "embedding",
                           model_id: int = 1, stage: int = 1) -> DataFrame:
    """A linear model on embedding vectors: nearest class centroid,
    ``w = mu1 - mu0``, ``bias = (|mu0|^2 - |mu1|^2) / 2``.  One row per
    dimension (``term`` = the 1-based index as text) plus the bias row."""
    e = train.select(F.col(label_col).alias("y"), F.posexplode(vec_col).alias("i", "v"))
    mu = e.groupBy("i").agg(F.avg(F.when(F.col("y") == 1, F.col("v").cast("double"))).alias("m1"),
                            F.avg(F.when(F.col("y") == 0, F.col("v").cast("double"))).alias("m0"))
    dims = mu.select(F.lit(model_id).cast("long").alias("model_id"), F.lit(stage).cast("int").alias("stage"),
                     (F.col("i") + 1).cast("string").alias("term"), F.lit(None).cast("double").alias("idf"),
                     (F.col("m1") - F.col("m0")).alias("weight"),
                     ((F.col("m0") * F.col("m0") - F.col("m1") * F.col("m1")) / 2).alias("__b"))
    bias = dims.agg(F.sum("__b").alias("weight")).select(
        F.lit(model_id).cast("long").alias("model_id"), F.lit(stage).cast("int").alias("stage"),
        F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("idf"), "weight")
    return dims.drop("__b").unionByName(bias)


# ---------------------------------------------------------------------------
# Scoring (H2-H6)
# ---------------------------------------------------------------------------
def sigmoid(s: Column) -> Column:
    """H3: lr and nb are both a linear score followed by this for two classes."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-s))


def packed_terms(weights: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The weights packed, a row per term, as ``(term, weights)``: those of the
    most frequent terms, which may be broadcast, and the others (None: none)."""
    packed = store(weights.groupBy("term").agg(
        F.collect_list(F.struct("model_id", "stage", "idf", "weight")).alias("weights"), F.min("idf").alias("rarity")), "packed-weights")
    # a struct of the four numbers takes 48 bytes in an array of a row
    head, tail = by_frequency(packed, F.col("rarity"), F.size("weights") * 48)
    return head.drop("rarity"), None if tail is None else tail.drop("rarity")


def stage_scores(story_models: DataFrame, counts: DataFrame, model_terms: DataFrame,
                 id_col: str = "story_id") -> DataFrame:
    """``(id, model_id, stage, p)`` for TF-IDF stages.

    ``story_models`` = distinct (id, model_id, stage) to score; ``counts`` =
    (id, term, tf) computed once per story text and partitioned by id.  The
    weights of frequent terms are broadcast and summed up where the counts are;
    what a story has of other terms (few of its words, as term frequencies go)
    is written once and moves to the other weights, all stages of a term
    together.
    """
    weights = model_terms.filter(F.col("term").isNotNull())
    bias = model_terms.filter(F.col("term").isNull()).select("model_id", "stage", F.col("weight").alias("bias"))
    head, tail = packed_terms(weights)
    # a story's stages are few and stay on its partition: no sort of the counts
    wanted = story_models.groupBy(id_col).agg(F.collect_set(F.struct("model_id", "stage")).alias("wanted"))
    met = counts.join(wanted.hint("shuffle_hash"), id_col).join(F.broadcast(head), "term", "left")
    rare = F.when(F.col("weights").isNull(), F.col("term")) if tail is not None else F.lit(None).cast("string")
    v = F.col("tf") * F.col("idf")
    dot, square = F.sum(v * F.col("weight")).alias("dot"), F.sum(v * v).alias("square")
    stage_of = [id_col, "model_id", "stage"]
    sums = (met.select(id_col, "tf", rare.alias("rare"), "wanted", F.inline_outer("weights"))
            .filter(F.array_contains("wanted", F.struct("model_id", "stage")) | F.col("rare").isNotNull())
            .groupBy(*stage_of, "rare").agg(dot, square, F.sum("tf").alias("tf")))
    if tail is not None:
        sums = store(sums, "stage-sums")
        others = (sums.filter(F.col("rare").isNotNull()).select(id_col, F.col("rare").alias("term"), "tf").join(unbounded(tail), "term")
                  .select(id_col, "tf", F.inline("weights")).groupBy(*stage_of).agg(dot, square))
        sums = sums.filter(F.col("rare").isNull()).select(*stage_of, "dot", "square").unionByName(others)
    agg = sums.groupBy(*stage_of).agg(F.sum("dot").alias("dot"), F.sqrt(F.sum("square")).alias("norm"))
    # Scores attach by story id (a left join: stories without any known
    # term still get sigmoid(bias))
    out = (story_models.join(agg, [id_col, "model_id", "stage"], "left")
           .join(bounded_broadcast(bias), ["model_id", "stage"], "left"))
    s = F.coalesce(F.col("bias"), F.lit(0.0)) + F.coalesce(F.col("dot") / F.nullif("norm", F.lit(0.0)), F.lit(0.0))
    return out.select(id_col, "model_id", "stage", sigmoid(s).alias("p"))


def model_stages(models: DataFrame) -> DataFrame:
    """``(model_id, stage, vectorizer)``: one row per stage that a model runs."""
    stages = F.array(F.struct(F.lit(1).alias("stage"), F.col("vectorizer_type_1").alias("vectorizer")),
                     F.struct(F.lit(2).alias("stage"), F.col("vectorizer_type_2").alias("vectorizer")))
    return (models.select("model_id", F.coalesce("chained_models", F.lit(False)).alias("chained"), F.inline(stages))
            .filter((F.col("stage") == 1) | F.col("chained")).drop("chained"))


def pack_weights(model_terms: DataFrame) -> DataFrame:
    """``(model_id, stage, bias, weights)``: the dimensions of each embedding
    stage as one ``array<double>`` in their order (``term`` is the 1-based
    dimension).  A group is one model's vector."""
    dim = F.when(F.col("term").isNotNull(), F.struct(F.col("term").cast("int").alias("i"), F.col("weight").alias("w")))
    return model_terms.groupBy("model_id", "stage").agg(
        F.coalesce(F.max(F.when(F.col("term").isNull(), F.col("weight"))), F.lit(0.0)).alias("bias"),
        F.transform(F.array_sort(F.collect_list(dim)), lambda x: x["w"]).alias("weights"))


def vector_score(vector: Column, bias: Column, weights: Column) -> Column:
    """H2: ``sigmoid(bias + w . x)``; a vector of another length than the
    model's is an error, a NULL vector has no score."""
    dot = F.aggregate(F.zip_with(vector, weights, lambda x, w: x.cast("double") * w), F.lit(0.0), lambda acc, x: acc + x)
    wrong = F.raise_error(F.format_string("a vector of %d dimensions for a model of %d", F.size(vector), F.size(weights)))
    return F.when(vector.isNull(), F.lit(None).cast("double")).when(F.size(vector) == F.size(weights), sigmoid(bias + dot)).otherwise(
        wrong.cast("double"))


def embedding_scores(vectors: DataFrame, model_terms: DataFrame, model_id: int, stage: int = 1,
                     id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """H2: every vector scored by one embedding model (``embedding_stage_scores``
    with the same model for every row)."""
    pairs = vectors.select(F.col(id_col), F.col(vec_col).alias("__v"), F.lit(model_id).cast("long").alias("model_id"), F.lit(stage).alias("stage"))
    w = pack_weights(model_terms.filter((F.col("model_id") == model_id) & (F.col("stage") == stage)))
    return (pairs.join(bounded_broadcast(w), ["model_id", "stage"])
            .select(id_col, vector_score(F.col("__v"), F.col("bias"), F.col("weights")).alias("p")))


def embedding_stage_scores(story_models: DataFrame, vectors: DataFrame, model_terms: DataFrame, id_col: str = "story_id",
                           vec_col: str = "embedding") -> DataFrame:
    """``(id, model_id, stage, p)`` of embedding stages: the pairs meet their
    story's vector by id and their model's packed weights by broadcast (within
    its bound).  A story without a vector has no score."""
    v = vectors.select(F.col(id_col), F.col(vec_col).alias("__v"))
    return (story_models.join(unbounded(v), id_col).join(bounded_broadcast(pack_weights(model_terms)), ["model_id", "stage"])
            .select(id_col, "model_id", "stage", vector_score(F.col("__v"), F.col("bias"), F.col("weights")).alias("p")))


def _run_scorers(batches, scorers: dict, stage_features: list[str]):
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        out = np.full(batch.num_rows, np.nan)
        model, stage = batch.column("model_id").to_numpy(), batch.column("stage").to_numpy()
        for m, st in sorted(set(zip(model.tolist(), stage.tolist()))):
            at = np.flatnonzero((model == m) & (stage == st))
            p = np.asarray(scorers[m](int(st), batch.select(stage_features).take(pa.array(at))), dtype=float)
            if p.shape != at.shape:
                raise ValueError(f"the scorer of model {m} gave {p.shape} scores for {len(at)} stories")
            out[at] = p
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("model_id"), batch.column("stage"), pa.array(out, from_pandas=True)],
                                         ["id", "model_id", "stage", "p"])


def caller_stage_scores(story_models: DataFrame, features: DataFrame, scorers: dict, id_col: str = "story_id") -> DataFrame:
    """``(id, model_id, stage, p)`` by the caller's functions: ``scorers[model_id]
    (stage, batch)`` gets an Arrow batch of the features (``text`` and, if
    given, ``vector``) and returns one probability per row (NaN: no score).
    Stories travel to Python in batches, never row by row, and only those whose
    model is the caller's."""
    names = [c for c in features.columns if c != id_col]
    rows = features.withColumnRenamed(id_col, "id").join(story_models.withColumnRenamed(id_col, "id").hint("shuffle_hash"), "id").select("id", "model_id", "stage", *names)
    schema = T.StructType([*rows.schema.fields[:3], T.StructField("p", T.DoubleType())])
    return rows.mapInArrow(partial(_run_scorers, scorers=scorers, stage_features=names), schema).withColumnRenamed("id", id_col)


def validate_models(models: DataFrame) -> DataFrame:
    """H7: model configs that cannot run (unknown type or vectorizer, chained
    without a second stage), with the reason."""
    t1 = ~F.coalesce(F.col("model_type_1").isin(*MODEL_TYPES), F.lit(False))
    v1 = ~F.coalesce(F.col("vectorizer_type_1").isin(*VECTORIZER_TYPES), F.lit(False))
    ch = F.coalesce(F.col("chained_models"), F.lit(False))
    t2 = ch & ~F.coalesce(F.col("model_type_2").isin(*MODEL_TYPES), F.lit(False))
    v2 = ch & ~F.coalesce(F.col("vectorizer_type_2").isin(*VECTORIZER_TYPES), F.lit(False))
    reason = F.concat_ws("; ", F.when(t1, F.lit("unknown model_type_1")), F.when(v1, F.lit("unknown vectorizer_type_1")),
                         F.when(t2, F.lit("unknown model_type_2")), F.when(v2, F.lit("unknown vectorizer_type_2")))
    return models.filter(t1 | v1 | t2 | v2).select("model_id", reason.alias("reason"))


def with_model(projects: DataFrame, models: DataFrame, check: bool = True) -> DataFrame:
    """Project -> model by id (broadcast, config-sized); a project whose
    model is missing or invalid is an error."""
    m = models.select("model_id", "chained_models")
    if check:
        missing = projects.join(m, projects["language_model_id"] == m["model_id"], "left_anti") \
            .select(F.format_string("project %d: model %d not found", "project_id", "language_model_id").alias("p"))
        bad = validate_models(models).select(F.format_string("model %d: %s", "model_id", "reason").alias("p"))
        problems = [r.p for r in missing.unionByName(bad).limit(10).collect()]   # one small action
        if problems:
            raise ModelConfigError("model problems: " + "; ".join(problems))
    return projects.join(bounded_broadcast(m), projects["language_model_id"] == m["model_id"])


def require_weights(projects: DataFrame, models: DataFrame, model_terms: DataFrame, with_vectors: bool = False,
                    own_models: Sequence[int] = ()) -> list[str]:
    """The kinds of features that the projects' models need.  Stops when a
    stage that some project uses has no weights (no bias row), or needs vectors
    and none are given.  Models scored by the caller need no weights."""
    used = models.join(projects.select(F.col("language_model_id").alias("model_id")).distinct(), "model_id", "left_semi")
    used = model_stages(used.filter(~F.col("model_id").isin(list(own_models)) if own_models else F.lit(True)))
    fitted = model_terms.filter(F.col("term").isNull()).select("model_id", "stage", F.lit(True).alias("fitted")).distinct()
    unknown = F.lit(False) if with_vectors else F.col("vectorizer") == "embeddings"
    problem = (F.when(unknown, F.format_string("model %d stage %d: embeddings features, but no vectors", "model_id", "stage"))
               .when(F.col("fitted").isNull(), F.format_string("model %d stage %d: no weights", "model_id", "stage")))
    # config-sized: a row per stage of a used model
    rows = used.join(fitted, ["model_id", "stage"], "left").select("vectorizer", problem.alias("p")).distinct()
    found = rows.groupBy("vectorizer").agg(F.min("p").alias("p")).orderBy("vectorizer").collect()
    problems = [r.p for r in found if r.p]
    if problems:
        raise ModelConfigError("model problems: " + "; ".join(problems))
    return [r.vectorizer for r in found]


def score(stories: DataFrame, projects: DataFrame, models: DataFrame, model_terms: DataFrame,
          id_col: str = "story_id", text_col: str = "story_text", texts: DataFrame | None = None,
          vectors: DataFrame | None = None, vec_col: str = "embedding", scorers: dict | None = None) -> DataFrame:
    """H4-H6: every (story, project) row scored with its project's model.

    Adds ``model_id, model_1_score, model_2_score, model_score`` and
    ``confidence`` (= model_score).  Single models leave the partial scores
    NULL; chained models multiply the two stages, whatever features each uses.
    A story that lacks what a stage needs (text; vector) gets NULL scores (it
    is reported, not retried).  Term counts are computed once per story text
    however many projects share the story: pass ``texts`` (``id, text``, one
    row per story, e.g. the feed itself) so that texts are tokenised where they
    are read instead of shuffled to be de-duplicated; texts of stories that no
    project kept are dropped before they are tokenised.
    ``vectors`` (``id, embedding``, one row per story) are the features of
    embedding stages; ``scorers`` (model_id -> function over Arrow batches, see
    ``caller_stage_scores``) are the caller's own models.
    """
    own = sorted(scorers or {})
    pm = with_model(projects, models).select("project_id", "model_id", "chained_models")
    kinds = require_weights(projects, models, model_terms, vectors is not None, own)
    sp = stories.join(bounded_broadcast(pm), "project_id")
    if texts is None:
        texts = stories.select(id_col, text_col).dropDuplicates([id_col])
    texts = texts.filter(F.col(text_col).isNotNull())
    stages = model_stages(models).withColumn("kind", F.when(F.col("model_id").isin(own), F.lit("own")).otherwise(F.col("vectorizer"))
                                             if own else F.col("vectorizer"))
    pairs = sp.select(id_col, "model_id").distinct().join(bounded_broadcast(stages.select("model_id", "stage", "kind")), "model_id")
    of_kind = lambda k: pairs.filter(F.col("kind") == k).select(id_col, "model_id", "stage")
    by_kind = {k: model_terms.join(stages.filter(F.col("kind") == k).select("model_id", "stage"), ["model_id", "stage"], "left_semi") for k in kinds}
    parts = []
    if "tfidf" in kinds:
        # NULL texts get NULL scores: keep only ids that have a text (ids only move)
        known = (sp.filter(F.col(text_col).isNotNull()).select(id_col).distinct() if text_col in sp.columns else texts.select(id_col))
        asked = of_kind("tfidf").select(F.col(id_col).alias("__id")).distinct()
        parts.append(stage_scores(of_kind("tfidf").join(known, id_col, "left_semi"), term_counts(texts, id_col, text_col, asked),
                                  by_kind["tfidf"] if len(kinds) > 1 else model_terms, id_col))
    if "embeddings" in kinds:
        parts.append(embedding_stage_scores(of_kind("embeddings"), vectors.select(F.col(id_col), F.col(vec_col)), by_kind["embeddings"],
                                            id_col, vec_col))
    if own:
        features = texts.select(id_col, F.col(text_col).alias("text"))
        if vectors is not None:
            features = features.join(unbounded(vectors.select(id_col, F.col(vec_col).alias("vector"))), id_col, "left")
        parts.append(caller_stage_scores(of_kind("own"), features, scorers, id_col))
    if not parts:       # no project, so no model and no row
        parts.append(of_kind("none").withColumn("p", F.lit(None).cast("double")))
    p = reduce(DataFrame.unionByName, parts)
    wide = p.groupBy(id_col, "model_id").agg(
        F.max(F.when(F.col("stage") == 1, F.col("p"))).alias("p1"),
        F.max(F.when(F.col("stage") == 2, F.col("p"))).alias("p2"))
    out = sp.join(wide, [id_col, "model_id"], "left")
    # H5: chained models multiply the two stage probabilities
    chained = F.coalesce(F.col("chained_models"), F.lit(False))
    return (out.withColumn("model_1_score", F.when(chained, F.col("p1")))
            .withColumn("model_2_score", F.when(chained, F.col("p2")))
            .withColumn("model_score", F.when(chained, F.col("p1") * F.col("p2")).otherwise(F.col("p1")))
            .withColumn("confidence", F.col("model_score"))
            .drop("p1", "p2", "chained_models"))


def unscorable(stories: DataFrame, texts: DataFrame | None = None, id_col: str = "story_id",
               text_col: str = "story_text") -> DataFrame:
    """Q10: (story, project) rows that cannot be scored because the story has
    no text -- reported as a `bad` output instead of failing the batch."""
    if text_col in stories.columns:
        return stories.filter(F.col(text_col).isNull())
    missing = texts.filter(F.col(text_col).isNull()).select(id_col)
    return stories.join(missing, id_col, "left_semi")


def above_threshold(scored: DataFrame, projects: DataFrame) -> DataFrame:
    """Keep ``confidence >= coalesce(min_confidence, 0)`` (inclusive)."""
    t = projects.select("project_id", F.coalesce("min_confidence", F.lit(0.0)).alias("__min"))
    return (scored.join(bounded_broadcast(t), "project_id")
            .filter(F.col("confidence") >= F.col("__min")).drop("__min"))
