"""Query windows and high-water marks.

Per project and platform: which publication days and which indexing period
to ask for, derived from the project's start date and the history of what was
already fetched.  Projects and history are config-sized; everything here is
a projection or a small join over them plus one aggregation over the feed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions.dates import parse_start_date, ts_lit
from vigil.operators.common import bounded_broadcast


def ensure_history(projects: DataFrame, history: DataFrame, source: str, as_of: dt.datetime) -> DataFrame:
    """A history row for every project that has none for ``source``
    (rows to append; ``latest_date`` NULL, ``updated_at`` = as_of)."""
    h = history.filter(F.col("source") == source).select("project_id")
    return (projects.select("project_id").join(h, "project_id", "left_anti")
            .select("project_id", F.lit(source).alias("source"),
                    F.lit(None).cast("timestamp").alias("latest_date"), ts_lit(as_of).alias("updated_at")))


def query_windows(projects: DataFrame, history: DataFrame, source: str, as_of: dt.datetime,
                  respect_project_start: bool = True) -> DataFrame:
    """``(project_id, start_date, end_date)`` for one platform, and the
    ranges a story must lie in (B4): ``indexed_to`` = now (a story is indexed
    after ``start_date``), ``published_from`` / ``published_to`` = the days
    ``now-(offset+window)d`` and ``now-offset d``, whatever the mark.

    * no history row: ``start = now-(offset+window)d``, raised to the project's
      start date when that parses and is later; ``end = now-offset d``.
    * history row, archive platform: ``start = latest_date``, or the default
      start when it is NULL.
    * history row, other platforms: ``start = now-(offset+window+1)d``.
    """
    offset, window = schemas.PLATFORM_WINDOWS[source]
    default_start = ts_lit(as_of - dt.timedelta(days=offset + window))
    end = ts_lit(as_of - dt.timedelta(days=offset))
    psd = parse_start_date("start_date")
    first_start = F.greatest(default_start, psd) if respect_project_start else default_start
    first_start = F.coalesce(first_start, default_start)
    h = history.filter(F.col("source") == source).select("project_id", "latest_date", F.lit(True).alias("__h"))
    if source == schemas.SOURCE_MEDIA_CLOUD:
        hist_start = F.coalesce(F.col("latest_date"), default_start)
    else:
        hist_start = ts_lit(as_of - dt.timedelta(days=offset + window + 1))
    return (projects.join(bounded_broadcast(h), "project_id", "left")
            .select("project_id",
                    F.when(F.col("__h").isNotNull(), hist_start).otherwise(first_start).alias("start_date"),
                    end.alias("end_date"), ts_lit(as_of).alias("indexed_to"),
                    F.to_date(default_start).alias("published_from"), F.to_date(end).alias("published_to")))


def _ranges(windows: DataFrame) -> DataFrame:
    return windows.select("project_id", F.col("start_date").alias("__s"), F.col("indexed_to").alias("__e"),
                          F.col("published_from").alias("__pf"), F.col("published_to").alias("__pt"))


def _window_ok(indexed_col: str, published_col: str):
    return ((F.col(indexed_col) > F.col("__s")) & (F.col(indexed_col) <= F.col("__e"))
            & F.to_date(published_col).between(F.col("__pf"), F.col("__pt")))


def in_window(stories: DataFrame, windows: DataFrame, indexed_col: str = "indexed_date",
              published_col: str = "publish_date") -> DataFrame:
    """Keep stories indexed in ``(start_date, indexed_to]`` of their
    project's window and published on a day in ``[published_from, published_to]``."""
    return (stories.join(bounded_broadcast(_ranges(windows)), "project_id")
            .filter(_window_ok(indexed_col, published_col)).drop("__s", "__e", "__pf", "__pt"))


def late_rows(stories: DataFrame, windows: DataFrame, indexed_col: str = "indexed_date",
              published_col: str = "publish_date") -> DataFrame:
    """The complement of ``in_window`` (stories of projects without a
    window included) -- the `late` output, never silently dropped."""
    return (stories.join(bounded_broadcast(_ranges(windows)), "project_id", "left")
            .filter(~F.coalesce(_window_ok(indexed_col, published_col), F.lit(False)))
            .drop("__s", "__e", "__pf", "__pt"))


def advance_history(history: DataFrame, found: DataFrame, source: str, as_of: dt.datetime,
                    date_col: str = "indexed_date") -> DataFrame:
    """New high-water mark per project = greatest(old, newest found,
    floor), the floor being 2 weeks (archive) or 50 weeks (others) before
    ``as_of``; never moves backwards.  An empty batch leaves the old mark."""
    floor_days = 14 if source == schemas.SOURCE_MEDIA_CLOUD else 50 * 7
    floor = ts_lit(as_of - dt.timedelta(days=floor_days))
    newest = found.groupBy("project_id").agg(F.max(date_col).alias("__new"))
    old = history.filter(F.col("source") == source).select("project_id", F.col("latest_date").alias("__old"))
    both = old.join(newest, "project_id", "full")
    latest = F.greatest(F.col("__old"), F.col("__new"), floor)
    return both.select("project_id", F.lit(source).alias("source"),
                       F.when(F.col("__new").isNull(), F.col("__old")).otherwise(latest).alias("latest_date"),
                       ts_lit(as_of).alias("updated_at"))
