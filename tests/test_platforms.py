"""The runs whose text arrives in the middle: where each listed story ends."""

from __future__ import annotations

import datetime as dt
import json

from tests.test_scoring import MODELS, WORDS
from vigil import schemas
from vigil.plans import platforms
from vigil.sources.config import literal_table

AS_OF = dt.datetime(2024, 6, 10, 12)
DAY = dt.timedelta(days=1)


def parts(spark):
    projects = literal_table(spark, [(p, f"p{p}", lang, None, None, None, None, 0.6, 1) for p, lang in ((1, "en"), (2, None))], schemas.PROJECT)
    terms = literal_table(spark, [(1, 1, False, "term", "good"), (2, 1, False, "phrase", "good news"), (2, 2, True, "term", "bad")], schemas.PROJECT_TERMS)
    weights = literal_table(spark, [(1, 1, t, idf, w) for t, idf, w in WORDS], schemas.MODEL_TERMS)
    history = literal_table(spark, [], schemas.HISTORY)
    log = spark.createDataFrame([(1, "https://a.org/old", "a.org/old", AS_OF - 3 * DAY, AS_OF - 3 * DAY), (2, "https://a.org/waiting", "a.org/waiting", AS_OF - DAY, None)],
                                "project_id long, url string, normalized_url string, queued_date timestamp, processed_date timestamp")
    return projects, terms, literal_table(spark, MODELS[:1], schemas.MODEL), weights, history, log, AS_OF


ROWS = [  # project, address, days before now, text
    (1, "https://a.org/1", 1, "good good"), (2, "https://a.org/1", 1, "good good"),
    (1, "https://www.a.org/1/", 1, "good good"),                  # the same story again
    (1, "https://b.org/2", 2, "good news bad"), (2, "https://b.org/2", 2, "good news bad"),
    (1, "https://a.org/late", 9, "good"), (1, "https://a.org/old", 1, "good"), (2, "https://a.org/old", 1, "good news"),
    (2, "https://a.org/waiting", 1, "good news"),                 # logged, not processed: fetched, then known to the log
    (1, "https://c.org/none", 1, None), (2, "https://c.org/3", 1, "Good news!"), (1, None, 1, None),
]


def feed(spark):
    rows = [(i, p, u, "en", AS_OF - d * DAY, u and f"https://x.org/{u}") for i, (p, u, d, _) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "feed_pos long, project_id long, url string, language string, publish_date timestamp, extracted_content_url string")


def outcome(spark, run, f):
    got = {r.project_id: tuple(r)[1:] for r in run.summary(f).select("project_id", "listed", "late", "skipped", "no_text", "found", "kept", "above").collect()}
    kept = sorted((r.project_id, r.url) for r in run.result.kept.collect())
    return got, kept, sorted(r.url for r in run.to_fetch.select("url").distinct().collect())


def test_search_platform(spark):
    f = feed(spark)
    texts = {u: t for _, u, _, t in ROWS if t}
    pages = spark.createDataFrame([(u, f"<title>news</title><p>{t}</p>") for u, t in texts.items()] + [("https://z.org/unasked", "good")], "original_url string, content string")
    run = platforms.run_search_platform(f, pages, *parts(spark), parser=lambda c: platforms.TX.html_to_text(c))
    got, kept, fetched = outcome(spark, run, f)
    assert got == {1: (7, 1, 1, 2, 3, 2, 1), 2: (5, 0, 0, 0, 3, 2, 2)}
    assert kept == [(1, "https://a.org/1"), (1, "https://b.org/2"), (2, "https://a.org/old"), (2, "https://c.org/3")]
    assert "https://a.org/late" not in fetched and "https://c.org/none" in fetched and len(fetched) == len(set(fetched))
    hosts = {r.host: r.batch for r in run.to_fetch.collect()}
    assert set(hosts) == {"a.org", "www.a.org", "b.org", "c.org"}
    marks = {r.project_id: r.latest_date for r in run.history.collect()}
    assert marks == {1: AS_OF - DAY, 2: AS_OF - DAY}


def test_webarchive_platform_with_domains_and_broken_content(spark):
    f = feed(spark)
    contents = [(f"https://x.org/{u}", json.dumps({"snippet": t, "title": "t"}) if "b.org" not in u else "{broken") for _, u, _, t in ROWS if t]
    contents = spark.createDataFrame(contents + contents[:1], "original_url string, content string")       # one address fetched twice
    domains = spark.createDataFrame([(1, "a.org"), (1, "b.org"), (2, "www.c.org")], "project_id long, domain string")
    late = [(i, p, u, "en", AS_OF - 5 * DAY, e) for i, p, u, _, _, e in map(tuple, f.collect())]
    f = spark.createDataFrame(late, f.schema)
    run = platforms.run_webarchive_platform(f, contents, *parts(spark), domains=domains)
    got, kept, fetched = outcome(spark, run, f)
    assert got == {1: (7, 0, 1, 1, 3, 2, 2), 2: (5, 0, 0, 0, 1, 1, 1)}
    assert kept == [(1, "https://a.org/1"), (1, "https://a.org/late"), (2, "https://c.org/3")]
    assert all(u.startswith("https://x.org/") for u in fetched)


def test_a_run_without_stories(spark):
    f = feed(spark).limit(0)
    run = platforms.run_search_platform(f, spark.createDataFrame([], "original_url string, content string"), *parts(spark))
    assert run.summary(f).collect() == [] and run.result.batches.collect() == [] and run.to_fetch.collect() == []
