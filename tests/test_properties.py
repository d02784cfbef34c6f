"""Properties from the test strategy: dedupe keeps exactly the distinct keys,
batches partition the rows, retention splits the log without loss."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.functions.urls import normalize_url
from vigil.operators import dedupe as D
from vigil.operators.log import retain

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

urls = st.sampled_from(["https://a.org/x", "http://a.org/x/", "https://www.a.org/x?utm_source=m", "https://a.org/y",
                        "https://b.org/x#top", "https://b.org/x", "https://b.org/x?id=2"])
feeds = st.lists(st.tuples(st.integers(0, 3), urls), min_size=1, max_size=40)


@SETTINGS
@given(feeds)
def test_dedupe_keeps_distinct_keys(spark, rows):
    df = spark.createDataFrame([(i, p, u) for i, (p, u) in enumerate(rows)], "pos long, project_id long, url string")
    kept = D.dedupe(df, "pos")
    keys = df.select("project_id", F.coalesce(normalize_url("url"), F.col("url")).alias("k")).distinct().count()
    assert kept.count() == keys
    # first wins: every kept row is the smallest position of its key
    first = (df.withColumn("k", F.coalesce(normalize_url("url"), F.col("url")))
             .groupBy("project_id", "k").agg(F.min("pos").alias("pos")))
    assert sorted(r.pos for r in kept.collect()) == sorted(r.pos for r in first.collect())


@SETTINGS
@given(st.lists(st.integers(0, 2), min_size=1, max_size=60), st.integers(1, 7))
def test_batches_partition_rows(spark, projects, size):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(projects)], "pos long, project_id long")
    out = D.batch_numbers(df, ["pos"], size=size).collect()
    assert sorted(r.pos for r in out) == list(range(len(projects)))
    per = {}
    for r in out:
        per.setdefault((r.project_id, r.batch_no), []).append(r.pos)
    assert all(len(v) <= size for v in per.values())
    for p in set(projects):
        n = sum(1 for x in projects if x == p)
        assert sorted(b for (q, b) in per if q == p) == list(range((n + size - 1) // size))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 90)), min_size=1, max_size=40), st.integers(0, 80))
def test_retention_splits_without_loss(spark, ages, keep_days):
    as_of = dt.datetime(2024, 3, 31)
    rows = [(i, None if a is None else as_of - dt.timedelta(days=a, hours=1)) for i, a in enumerate(ages)]
    log = spark.createDataFrame(rows, "id long, queued_date timestamp")
    kept, deleted = retain(log, keep_days, as_of)
    k, d = {r.id for r in kept.collect()}, {r.id for r in deleted.collect()}
    assert k | d == set(range(len(ages))) and not (k & d)
    assert all(ages[i] is None or ages[i] < keep_days for i in k)
