"""Registered queries: the runs of the search and web-archive platforms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions import text as TX
from vigil.plans import class_queries as CQ
from vigil.plans import feed_queries as FQ
from vigil.plans import pipeline_queries as PQ
from vigil.plans import platforms
from vigil.plans.log_queries import LOG_CTE
from vigil.plans.registry import query
from vigil.plans.search_queries import TOKEN_SQL, _project_sql
from vigil.sources import feeds as FD
from vigil.sources import fixtures
from vigil.sources.config import literal_table
from vigil.sources.tables import table

AS_OF = fixtures.AS_OF
LANGUAGE = "/(en|es|de|fr)/"
# Searches over the pages' text: project_id, clause_id, negated, kind, term.
TERM_ROWS = [
    (0, 1, False, "term", "the"), (1, 1, False, "prefix", "th"), (2, 1, False, "phrase", "the the"), (2, 1, False, "wildcard", "*ing"),
    (3, 1, False, "term", "para"), (3, 1, False, "term", "las"), (4, 1, False, "wildcard", "er*"), (4, 2, True, "term", "zzz"),
    (5, 1, False, "term", "le"), (5, 2, False, "term", "des"), (6, 1, False, "term", "der"), (6, 1, False, "term", "die"),
    (7, 1, False, "near5", "and the"), (8, 1, False, "fuzzy1", "thet"), (9, 1, False, "title:wildcard", "*e*"),
]


def _feed(spark, sf_dir):
    """The platforms' lists: every variant of a page's address, published in
    the nine days before the clock."""
    f = fixtures.feed_from_pages(table(spark, sf_dir, "pages"))
    back = F.make_dt_interval(days=(F.col("page_id") % 9).cast("int"), hours=(F.col("page_id") % 24).cast("int"))
    return f.select("feed_pos", "page_id", "project_id", "url", F.regexp_extract("url", LANGUAGE, 1).alias("language"),
                    (F.lit(f"{AS_OF:%Y-%m-%d %H:%M:%S}").cast("timestamp") - back).alias("publish_date"),
                    F.concat(F.lit("https://archive.example.org/"), F.col("page_id").cast("string")).alias("extracted_content_url"))


def _config(spark, sf_dir):
    # a history in which only the odd projects have rows so far
    history = PQ.history_before(spark, sf_dir).filter("project_id % 2 = 1")
    return (fixtures.projects(spark), literal_table(spark, TERM_ROWS, schemas.PROJECT_TERMS), fixtures.models(spark),
            CQ.model_terms(spark, sf_dir), history, FQ.prior_log(spark, sf_dir), AS_OF)


def _cte(source: str, text_sql: str, title_sql: str, fetch: str, addresses: str, from_pages: str) -> str:
    """``listed`` .. ``kept`` and the ``texts`` of a platform's run."""
    off, win = schemas.PLATFORM_WINDOWS[source]
    day = lambda n: f"CAST({PQ._ts(AS_OF - dt.timedelta(days=n))} AS DATE)"
    found = "\nUNION ALL\n".join(
        f"SELECT CAST({r[0]} AS BIGINT) AS project_id, story_id FROM d WHERE {_project_sql(r[0], TERM_ROWS)}"
        + (f" AND lower(lang) = '{r[2]}'" if r[2] else "") for r in fixtures.PROJECT_ROWS)
    return f"""{LOG_CTE.strip()[len("WITH "):]}{PQ.HIST_SQL.replace("GROUP BY 1, 2)", "AND project_id % 2 = 1 GROUP BY 1, 2)")},
{FQ.FEED_CTE.strip()[len("WITH "):]},
{from_pages}
listed AS (SELECT feed_pos, page_id, project_id, url, normalized_url, regexp_extract(url, '{LANGUAGE}', 1) AS language,
                  {PQ._ts(AS_OF)} - INTERVAL '1' DAY * (page_id % 9) - INTERVAL '1' HOUR * (page_id % 24) AS publish_date,
                  {fetch} AS fetch_url FROM feed),
w AS ({PQ._windows_sql(source, True)}),
judged AS (SELECT l.*, coalesce(publish_date > start_date AND publish_date <= {PQ._ts(AS_OF)}
                  AND CAST(publish_date AS DATE) BETWEEN {day(off + win)} AND {day(off)}, false) AS ok FROM listed l LEFT JOIN w USING (project_id)),
inside AS (SELECT j.*, EXISTS (SELECT 1 FROM prior_log p WHERE p.project_id = j.project_id AND p.processed_date IS NOT NULL
                  AND coalesce(p.normalized_url, p.url) = coalesce(j.normalized_url, j.url)
                  AND p.queued_date > {PQ._ts(AS_OF - dt.timedelta(days=14))}) AS recent FROM judged j WHERE ok),
fresh AS (SELECT * FROM inside WHERE NOT recent),
asked AS (SELECT fetch_url AS story_id, arg_min(language, feed_pos) AS lang FROM fresh GROUP BY 1),
texts AS (SELECT * FROM (SELECT a.story_id, a.lang, {title_sql} AS title, {text_sql} AS text,
                 row_number() OVER (PARTITION BY a.story_id ORDER BY length({text_sql}) DESC, {text_sql} DESC, {title_sql} DESC) AS rn
          FROM asked a JOIN {addresses}) WHERE text IS NOT NULL AND rn = 1),
d AS (SELECT story_id, lang, {TOKEN_SQL.format(c="concat_ws(' ', title, text)")} AS toks, {TOKEN_SQL.format(c="title")} AS ttoks FROM texts),
hits AS ({found}),
found AS (SELECT f.*, f.fetch_url AS story_id FROM fresh f JOIN hits h ON h.project_id = f.project_id AND h.story_id = f.fetch_url),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY project_id, coalesce(normalized_url, url) ORDER BY feed_pos) AS rn FROM found) k
         WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM prior_log p WHERE p.project_id = k.project_id
                                      AND coalesce(p.normalized_url, p.url) = coalesce(k.normalized_url, k.url)))"""


def _summary_sql(cte: str) -> str:
    stories = "SELECT k.story_id, k.project_id, t.text AS story_text FROM kept k JOIN texts t USING (story_id)"
    # a story's rows in one project share its address, so scores are counted by address
    return CQ.score_cte(stories, cte) + """
, n AS (SELECT project_id, count(*) AS listed, count(*) FILTER (WHERE NOT ok) AS late FROM judged GROUP BY 1),
s AS (SELECT project_id, count(*) AS skipped FROM inside WHERE recent GROUP BY 1),
x AS (SELECT project_id, count(*) AS no_text FROM fresh WHERE fetch_url NOT IN (SELECT story_id FROM texts) GROUP BY 1),
f AS (SELECT project_id, count(*) AS found FROM found GROUP BY 1),
k AS (SELECT project_id, count(*) AS kept FROM kept GROUP BY 1),
best AS (SELECT DISTINCT story_id, project_id, model_score FROM scored),
a AS (SELECT k.project_id, count(*) AS above FROM kept k JOIN best b USING (project_id, story_id) JOIN proj p USING (project_id)
      WHERE b.model_score >= coalesce(p.min_confidence, 0) GROUP BY 1)
SELECT project_id, listed, late, coalesce(skipped, 0) AS skipped, coalesce(no_text, 0) AS no_text, coalesce(found, 0) AS found,
       coalesce(kept, 0) AS kept, coalesce(above, 0) AS above
FROM n LEFT JOIN s USING (project_id) LEFT JOIN x USING (project_id) LEFT JOIN f USING (project_id) LEFT JOIN k USING (project_id)
LEFT JOIN a USING (project_id)"""


SEARCH_CTE = _cte(schemas.SOURCE_NEWSCATCHER, "main", FQ._title_sql("html"), "url", "m ON m.url = a.story_id", FQ.main_text_cte("m", "pages") + ",")
ARCHIVE_CTE = _cte(schemas.SOURCE_WAYBACK_MACHINE, "CASE WHEN page_id % 13 <> 0 THEN main END", FQ._title_sql("html"),
                   "concat('https://archive.example.org/', page_id)", "m ON concat('https://archive.example.org/', m.page_id) = a.story_id",
                   FQ.main_text_cte("m", "pages") + ",")


@query("run_search_platform", sql=_summary_sql(SEARCH_CTE))
def q_run_search_platform(spark, sf_dir):
    """Windows, recent stories, fetched pages, search, scores: what became of
    the rows that a search API listed."""
    feed = _feed(spark, sf_dir)
    pages = FD.read_pages(table(spark, sf_dir, "pages"))
    run = platforms.run_search_platform(feed, pages, *_config(spark, sf_dir))
    return run.summary(feed)


def _contents(spark, sf_dir):
    """Extracted content of the archive; every thirteenth document is cut off."""
    page = table(spark, sf_dir, "pages")
    whole = F.to_json(F.struct(TX.main_text("html").alias("snippet"), TX.html_title("html").alias("title")))
    return page.select(F.concat(F.lit("https://archive.example.org/"), F.col("page_id").cast("string")).alias("original_url"),
                       F.when(F.col("page_id") % 13 == 0, F.lit('{"snippet": "cut')).otherwise(whole).alias("content"))


@query("run_webarchive_platform", sql=_summary_sql(ARCHIVE_CTE))
def q_run_webarchive_platform(spark, sf_dir):
    """The same for a web archive, whose extracted content is fetched."""
    feed = _feed(spark, sf_dir)
    run = platforms.run_webarchive_platform(feed, _contents(spark, sf_dir), *_config(spark, sf_dir))
    return run.summary(feed)
