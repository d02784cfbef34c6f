"""Runs of the platforms whose text arrives in the middle of the run.

A search API or a web archive lists stories per project, without their text:

feed -> window of the project (others: ``late``) -> not processed lately
(others: ``skipped``) -> distinct addresses to fetch, dealt to fetchers by
host -> the fetched text joined back (missing: ``no_text``) -> every project's
search over the texts -> de-duplication, cap, scores, threshold and batches as
in ``pipeline.run``.

Stories of several projects share one address: it is fetched, parsed, searched
and scored once.  Its text is stored once in the shared folder; de-duplication
and windows move keys only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions import text as TX
from vigil.functions.urls import normalize_url
from vigil.operators import dedupe as D
from vigil.operators import fetch as FE
from vigil.operators import search as S
from vigil.operators import windows as W
from vigil.operators.common import store, unbounded
from vigil.plans import pipeline
from vigil.sources import feeds as FD


@dataclass
class PlatformRun:
    late: DataFrame        # feed rows outside their project's window
    skipped: DataFrame     # per project: feed rows processed in the last two weeks
    to_fetch: DataFrame    # (url, host, batch): each address once, hosts dealt to fetchers
    no_text: DataFrame     # per project: feed rows whose address gave no text
    history: DataFrame     # the new marks
    result: pipeline.RunResult

    def summary(self, feed: DataFrame) -> DataFrame:
        """Per project of the feed: what became of its rows."""
        out = feed.groupBy("project_id").agg(F.count(F.lit(1)).alias("listed"))
        counts = {"late": self.late.groupBy("project_id").agg(F.count(F.lit(1)).alias("late")),
                  "skipped": self.skipped.withColumnRenamed("skipped_dupes", "skipped"), "no_text": self.no_text,
                  **{name: df.groupBy("project_id").agg(F.count(F.lit(1)).alias(name)) for name, df in (
                      ("found", self.result.found), ("kept", self.result.stored), ("above", self.result.above))}}
        for name, df in counts.items():
            out = out.join(df, "project_id", "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))
        return out


def _run(feed: DataFrame, texts_of: Callable[[DataFrame], DataFrame], fetch_col: str, projects: DataFrame, project_terms: DataFrame,
         models: DataFrame, model_terms: DataFrame, history: DataFrame, log: DataFrame, source: str, as_of: dt.datetime,
         fetchers: int, cap: int | None, recent_days: int, **scoring) -> PlatformRun:
    windows = W.query_windows(projects, history, source, as_of)
    # these platforms know when a story was published, not when it was indexed
    late = W.late_rows(feed, windows, "publish_date", "publish_date")
    inside = W.in_window(feed, windows, "publish_date", "publish_date").withColumn("normalized_url", normalize_url("url"))
    skipped = D.skipped_counts(inside, log, as_of, recent_days)
    # keys and dates only; the fetch list, the missing texts and the matches read them
    fresh = store(D.drop_recently_processed(inside, log, as_of, recent_days), "platform-fresh")
    asked = (fresh.filter(F.col(fetch_col).isNotNull()).groupBy(F.col(fetch_col).alias("story_id"))
             .agg(F.min("feed_pos").alias("feed_pos"), F.min_by("language", "feed_pos").alias("language")))
    to_fetch = FE.host_batches(asked.select(F.col("story_id").alias("url"), "feed_pos"), "feed_pos", fetchers).select("url", "host", "batch")
    texts = texts_of(asked.select("story_id")).filter(F.col("story_text").isNotNull())
    # an address that was fetched twice: its longest text, ties by the text itself
    one = F.max(F.struct(F.length("story_text").alias("n"), "story_text", "title"))
    docs = store(texts.groupBy("story_id").agg(one.alias("t")).select("story_id", "t.title", "t.story_text").join(
        unbounded(asked.select("story_id", "language")), "story_id"), "platform-texts")
    rows = fresh.withColumn("story_id", F.col(fetch_col))
    no_text = (rows.join(unbounded(docs.select("story_id")), "story_id", "left_anti").groupBy("project_id").agg(F.count(F.lit(1)).alias("no_text")))
    matches = S.match_projects(docs, project_terms, projects, doc_id="story_id")
    found = (rows.drop("title").join(unbounded(matches), ["project_id", "story_id"])
             .join(unbounded(docs.select("story_id", "title")), "story_id"))
    marks = W.advance_history(history, found, source, as_of, "publish_date")
    result = pipeline.after_search(found, log, cap, [F.desc_nulls_last("publish_date"), F.col("url")], order_by="feed_pos").result(
        None, marks, docs.select("story_id", "story_text"), projects, models, model_terms, source, **scoring)
    return PlatformRun(late, skipped, to_fetch, no_text, marks, result)


def run_search_platform(feed: DataFrame, pages: DataFrame, projects: DataFrame, project_terms: DataFrame, models: DataFrame,
                        model_terms: DataFrame, history: DataFrame, log: DataFrame, as_of: dt.datetime,
                        source: str = schemas.SOURCE_NEWSCATCHER, parser: Callable[[Column], Column] = TX.main_text, fetchers: int = 4,
                        cap: int | None = None, recent_days: int = 14, **scoring) -> PlatformRun:
    """Platform 2: a search API lists stories (``feed``: unique ``feed_pos``,
    ``project_id, url, language, publish_date``); their pages (``pages``:
    ``original_url, content``) are fetched by the story's own address."""
    def texts_of(asked: DataFrame) -> DataFrame:
        return FE.attach_text(asked, pages, story_url="story_id", parser=parser).select("story_id", F.col("page_title").alias("title"), "story_text")
    return _run(feed, texts_of, "url", projects, project_terms, models, model_terms, history, log, source, as_of, fetchers, cap, recent_days, **scoring)


def run_webarchive_platform(feed: DataFrame, contents: DataFrame, projects: DataFrame, project_terms: DataFrame, models: DataFrame,
                            model_terms: DataFrame, history: DataFrame, log: DataFrame, as_of: dt.datetime,
                            domains: DataFrame | None = None, source: str = schemas.SOURCE_WAYBACK_MACHINE, field: str = "snippet",
                            fetchers: int = 4, cap: int | None = None, recent_days: int = 14, **scoring) -> PlatformRun:
    """Platform 3: a web archive lists stories with the address of their
    extracted content (``extracted_content_url``), which is fetched instead of
    the page: JSON documents (``contents``: ``original_url, content``) with the
    text in ``field``; one that does not parse gives no text.  ``domains``
    (project_id, domain) limit each project to its media."""
    if domains is not None:
        feed = FD.filter_domains(feed, domains)

    def texts_of(asked: DataFrame) -> DataFrame:
        wanted = contents.withColumnRenamed("original_url", "story_id").join(unbounded(asked), "story_id", "left_semi")
        ok, _ = FD.parse_extracted(wanted, field=field)
        return ok.select("story_id", TX.json_field("content", "title").alias("title"), "story_text")
    return _run(feed, texts_of, "extracted_content_url", projects, project_terms, models, model_terms, history, log, source, as_of,
                fetchers, cap, recent_days, **scoring)
