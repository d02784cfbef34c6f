"""Mappings from the driver's generic tables to this domain.

The test data has no story log, feeds or projects, so fixed mappings derive
them from ``events``, ``pages`` and ``documents``.  Each mapping is written
once here and once as SQL in the DuckDB twins (``vigil/plans/*_queries.py``), and
the two must agree row for row.  All work grows with the input tables: the
mappings are narrow projections (no joins, no driver data).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions import urls as U
from vigil.functions.dates import ts_lit
from vigil.sources.config import literal_table

# Fixed clock of the fixtures: events span 2024-01-01 .. 2024-01-30.
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


def _event_source(event_type: Column) -> Column:
    return (F.when(event_type == "click", "media-cloud")
            .when(event_type == "view", "newscatcher")
            .when(event_type == "purchase", "wayback-machine")
            .when(event_type == "signup", "google-alerts")
            .otherwise("media-cloud"))


def story_log_from_events(events: DataFrame) -> DataFrame:
    """The story log (one row per logged story) derived from ``events``."""
    ts = F.col("ts").cast("timestamp")
    is_error = F.col("event_type") == "error"
    base = events.select(
        F.col("event_id").alias("id"),
        (F.col("user_id") % 10).alias("project_id"),
        (F.col("user_id") % 3 + 1).alias("model_id"),
        _event_source(F.col("event_type")).alias("source"),
        (ts - F.make_dt_interval(days=(F.col("event_id") % 4).cast("int"))).alias("published_date"),
        ts.alias("queued_date"),
        F.when(is_error, F.lit(None).cast("timestamp"))
        .otherwise(ts + F.make_dt_interval(hours=(F.col("user_id") % 48).cast("int")))
        .alias("processed_date"),
        F.when(is_error, F.lit(None).cast("double"))
        .otherwise(F.least(F.col("value") / F.lit(200.0), F.lit(1.0)))
        .alias("model_score"),
    )
    # decimal literals, as in SQL, so that e.g. 0.2 + 0.05 * 2 is exactly 0.30
    threshold = F.expr("0.2 + 0.05 * (project_id % 4)")
    above = F.col("model_score") >= threshold
    return base.select(
        "*",
        F.coalesce(above, F.lit(False)).alias("above_threshold"),
        F.when(above & (F.col("id") % 10 != 0),
               F.col("processed_date") + F.make_dt_interval(hours=F.lit(1)))
        .alias("posted_date"),
    )


FEED_VARIANTS = [0, 1, 2, 3, 10, 11]


def feed_from_pages(pages: DataFrame) -> DataFrame:
    """A story feed with realistic URL duplicates, derived from ``pages``.

    Variants 10 and 11 land in the same project as 0 and 1 and so are true
    duplicates; the others are the same URL in other projects.  ``feed_pos``
    is the input order (first wins).  Variants are an ``explode`` of a fixed
    six-element array: a narrow operation, no join.
    """
    v = F.col("v")
    has_q = F.col("url").contains("#") | F.col("url").contains("?")
    url = (F.when(v == 0, F.col("url"))
           .when(v == 1, F.concat(F.col("url"), F.when(has_q, "").otherwise("/")))
           .when(v == 2, F.concat(F.col("url"), F.when(has_q, "").otherwise("?utm_source=mail")))
           .otherwise(F.replace(F.col("url"), F.lit("http://"), F.lit("https://"))))
    return (pages.select("page_id", "url",
                         F.explode(F.array(*[F.lit(x) for x in FEED_VARIANTS])).alias("v"))
            .select((F.col("page_id") * 100 + v).alias("feed_pos"),
                    "page_id",
                    ((F.col("page_id") + v) % 10).alias("project_id"),
                    url.alias("url")))


def stories_from_documents(documents: DataFrame) -> DataFrame:
    """Canonical story rows (no project yet) from ``documents``.

    title = first line of the text; url and dates are derived from the id.
    """
    return documents.select(
        F.col("doc_id").alias("story_id"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/story/"),
                 F.col("doc_id").cast("string")).alias("url"),
        F.substring_index(F.col("text"), "\n", 1).alias("title"),
        F.col("text").alias("story_text"),
        F.col("lang").alias("language"),
        F.col("source").alias("media_name"),
        (ts_lit(AS_OF)
         - F.make_dt_interval(days=(F.col("doc_id") % 30).cast("int"),
                              hours=(F.col("doc_id") % 24).cast("int"))).alias("indexed_date"),
    )


# ---------------------------------------------------------------------------
# Small configuration tables (fixed literal rows, as a project list would be)
# ---------------------------------------------------------------------------
# project_id, title, language, search_terms, collections, country, start_date, min_confidence, model
PROJECT_ROWS = [
    (0, "Thing watch", "en", 'thing AND (erre OR eran)', [0, 1], "US", "2023-12-01T00:00:00Z", 0.5, 1),
    (1, "Phrase watch", "en", '"the thing"', [1, 2], "GB", "2023-12-01T00:00:00Z", 0.4, 2),
    (2, "Stem watch", "en", 'ered*', [2], None, "2024-01-20T00:00:00Z", 0.6, 3),
    (3, "Spanish watch", "es", 'para AND las NOT no', [3], "MX", None, 0.3, 1),
    (4, "Wildcard watch", "en", 'er?e', [4, 0], "usa", "not a date", 0.5, 2),
    (5, "French watch", "fr", 'le AND des', [0], "FR", "2023-11-01T00:00:00Z", 0.55, 1),
    (6, "German watch", "de", 'der OR die', [1], "DE", "2023-11-01T00:00:00Z", 0.45, 2),
    (7, "Near watch", "en", '"thing erre"~5', [2, 3], "CA", "2023-11-01T00:00:00Z", 0.5, 3),
    (8, "Fuzzy watch", "en", 'thong~', [3, 4], "AU", "2023-11-01T00:00:00Z", 0.35, 1),
    (9, "Title watch", "en", 'title: the', [4], "NZ", "2023-11-01T00:00:00Z", None, 3),
]

# model_id, name, prefix, type1, vec1, chained, type2, vec2
MODEL_ROWS = [
    (1, "quality-nb", "quality_nb", "nb", "tfidf", False, None, None),
    (2, "toxic-nb", "toxic_nb", "nb", "tfidf", False, None, None),
    (3, "quality-then-toxic", "chain_nb", "nb", "tfidf", True, "nb", "tfidf"),
]

# The standing searches above, given as structured clauses (no string parser):
# project_id, clause_id, negated, kind, term.  All positive clauses must hold
# (AND); terms of one clause are alternatives (OR); any negated hit excludes.
PROJECT_TERM_ROWS = [
    (0, 1, False, "term", "thing"), (0, 2, False, "term", "erre"), (0, 2, False, "term", "eran"),
    (1, 1, False, "phrase", "the thing"),
    (2, 1, False, "prefix", "ered"),
    (3, 1, False, "term", "para"), (3, 2, False, "term", "las"), (3, 3, True, "term", "no"),
    (4, 1, False, "wildcard", "er?e"),
    (5, 1, False, "term", "le"), (5, 2, False, "term", "des"),
    (6, 1, False, "term", "der"), (6, 1, False, "term", "die"),
    (7, 1, False, "near5", "thing erre"),
    (8, 1, False, "fuzzy1", "thong"),
    (9, 1, False, "title:term", "the"),
]


def projects(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PROJECT_ROWS, schemas.PROJECT)


def models(spark: SparkSession) -> DataFrame:
    return literal_table(spark, MODEL_ROWS, schemas.MODEL)


def project_terms(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PROJECT_TERM_ROWS, schemas.PROJECT_TERMS)


def collection_sources(pages: DataFrame) -> DataFrame:
    """Media sources per collection, derived from ``pages``: the host of each
    page is a source in collection ``page_id % 5``; every seventh page's source
    is a URL-search source (``url_search_string`` set), every eleventh has no
    name -- both are excluded from domain lists."""
    host = U.host("url")
    return pages.select(
        (F.col("page_id") % 5).alias("collection_id"),
        F.when(F.col("page_id") % 11 == 0, F.lit(None).cast("string")).otherwise(host).alias("name"),
        F.when(F.col("page_id") % 7 == 0, F.lit("/section/*")).alias("url_search_string"),
    )
