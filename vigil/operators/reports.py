"""Reports on the story log.

The monitored system answers these per project with one SQL string each; here
every report answers for all projects at once (``project_id`` is a grouping
column), so one scan serves every project.  All aggregations are
``groupBy``/``agg`` with map-side partial aggregation: a project holding a third
of the log is pre-aggregated in every task before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions.dates import day, day_floor_before, days_before, day_text
from vigil.operators.common import top_k


def _filters(project_id=None, platform=None, above_threshold=None, is_posted=None) -> list[Column]:
    out = []
    if project_id is not None:
        out.append(F.col("project_id") == F.lit(project_id))
    if platform is not None:
        if platform not in schemas.PLATFORMS:
            raise ValueError(f"unknown platform {platform!r}")
        out.append(F.col("source") == F.lit(platform))
    if above_threshold is not None:
        out.append(F.col("above_threshold") == F.lit(bool(above_threshold)))
    if is_posted is not None:
        out.append(F.col("posted_date").isNotNull() if is_posted else F.col("posted_date").isNull())
    return out


def daily_counts(log: DataFrame, date_col: str, as_of: dt.datetime, days: int = 30,
                 by: Sequence[str] = (), project_id=None, platform=None,
                 above_threshold=None, is_posted=None) -> DataFrame:
    """Stories per day of ``date_col`` over the last ``days`` days.

    Keeps ``date_col IS NOT NULL AND date_col >= date(as_of) - days``; ``by``
    adds grouping columns (e.g. ``project_id``) so all projects come at once.
    """
    cond = F.col(date_col).isNotNull() & (F.col(date_col) >= day_floor_before(as_of, days))
    for c in _filters(project_id, platform, above_threshold, is_posted):
        cond = cond & c
    return (log.filter(cond)
            .groupBy(*by, day(date_col).alias("day"))
            .agg(F.count(F.lit(1)).alias("stories"))
            .withColumn("day", day_text("day"))
            .orderBy(*by, F.desc("day")))


def stories_by_posted_day(log, as_of, days=45, by=("project_id",), **filters):
    """Groups by *processed* day (kept as in the system), above threshold by default."""
    filters.setdefault("above_threshold", True)
    return daily_counts(log, "processed_date", as_of, days, by, **filters)


def stories_by_processed_day(log, as_of, days=45, by=("project_id", "source"), **filters):
    """E3."""
    return daily_counts(log, "processed_date", as_of, days, by, **filters)


def stories_by_published_day(log, as_of, days=30, by=("project_id", "source"), **filters):
    """E4."""
    return daily_counts(log, "published_date", as_of, days, by, **filters)


def posted_above_count(log: DataFrame, as_of: dt.datetime | None = None,
                       since_days: int | None = None) -> DataFrame:
    """E5: per project, stories above threshold that were posted (optionally
    posted within the last ``since_days`` days)."""
    cond = F.col("above_threshold") & F.col("posted_date").isNotNull()
    if since_days:
        cond = cond & (F.col("posted_date") >= day_floor_before(as_of, since_days))
    return log.groupBy("project_id").agg(F.count_if(F.coalesce(cond, F.lit(False))).alias("stories"))


def unposted_above_count(log: DataFrame) -> DataFrame:
    """Per project, above threshold but never posted (should be zero)."""
    cond = F.col("above_threshold") & F.col("posted_date").isNull()
    return log.groupBy("project_id").agg(F.count_if(F.coalesce(cond, F.lit(False))).alias("stories"))


def below_count(log: DataFrame) -> DataFrame:
    """Per project, not above threshold (includes rows not yet scored)."""
    return log.groupBy("project_id").agg(
        F.count_if(F.coalesce(~F.col("above_threshold"), F.lit(False))).alias("stories"))


def project_story_counts(log: DataFrame) -> DataFrame:
    """E5-E7 in one pass: one scan, three conditional counts per project."""
    above = F.coalesce(F.col("above_threshold"), F.lit(False))
    posted = F.col("posted_date").isNotNull()
    return log.groupBy("project_id").agg(
        F.count_if(above & posted).alias("posted_above"),
        F.count_if(above & ~posted).alias("unposted_above"),
        F.count_if(F.coalesce(~F.col("above_threshold"), F.lit(False))).alias("below"),
        F.count(F.lit(1)).alias("total"))


def score_histogram(log: DataFrame) -> DataFrame:
    """Model scores per project in 0.1 bins by *numeric* rounding
    (half away from zero on the decimal value), NULL scores left out."""
    value = F.round(F.col("model_score").cast("decimal(38,18)"), 1).cast("double")
    return (log.filter(F.col("model_score").isNotNull())
            .groupBy("project_id", value.alias("value"))
            .agg(F.count(F.lit(1)).alias("frequency"))
            .orderBy("project_id", "value"))


def processed_total(log: DataFrame, as_of: dt.datetime, days: int = 4) -> DataFrame:
    """One row, stories processed since ``as_of - days``."""
    return (log.filter(F.col("processed_date") >= days_before(as_of, days))
            .agg(F.count(F.lit(1)).alias("total_stories")))


def volume_alert(totals: DataFrame, days: int = schemas.STORY_COUNT_WINDOW_SIZE,
                 threshold: int = schemas.STORY_COUNT_THRESHOLD) -> DataFrame:
    """Average per day = total / days; alert when strictly below threshold.

    The average is shown with one decimal, rounding half to even as Python's
    ``%.1f`` does on these exact quarter values.
    """
    avg = F.col("total_stories") / F.lit(days)
    shown = F.format_string("%.1f", F.bround(avg, 1))
    alert = avg < F.lit(threshold)
    msg = F.format_string(
        "Warning: Average stories per day in the last %d days is %s, "
        "which is far below the expected value of >= %d.", F.lit(days), shown, F.lit(threshold))
    return totals.select(
        F.col("total_stories").cast("long").alias("total_stories"),
        F.lit(days).cast("long").alias("days"),
        avg.alias("average_per_day"),
        alert.alias("alert"),
        F.when(alert, msg).alias("message"))


def backlog_by_day(log: DataFrame) -> DataFrame:
    """Unprocessed stories by queued day, newest first."""
    return (log.filter(F.col("processed_date").isNull())
            .groupBy(day("queued_date").alias("day"))
            .agg(F.count(F.lit(1)).alias("stories"))
            .withColumn("day", day_text("day"))
            .orderBy(F.desc("day")))


def by_day_threshold(log: DataFrame) -> DataFrame:
    """Per processed day and threshold flag."""
    return (log.groupBy(day("processed_date").alias("day"), "above_threshold")
            .agg(F.count(F.lit(1)).alias("stories"))
            .withColumn("day", day_text("day"))
            .orderBy(F.desc("above_threshold"), F.desc("day")))


def above_by_published_day(log: DataFrame, newest: int = 10) -> DataFrame:
    """Per project, above-threshold stories by published day, the newest
    ``newest`` days (the top-k is the report)."""
    daily = (log.filter(F.col("above_threshold"))
             .groupBy("project_id", day("published_date").alias("day"))
             .agg(F.count(F.lit(1)).alias("stories")))
    return top_k(daily, ["project_id"], [F.desc_nulls_last("day")], newest) \
        .withColumn("day", day_text("day"))


def sent_by_day_source(log: DataFrame, as_of: dt.datetime, days: int = 45) -> DataFrame:
    """Above-threshold stories per processed day and source."""
    cond = (F.col("processed_date").isNotNull() & F.col("above_threshold")
            & (F.col("processed_date") >= day_floor_before(as_of, days)))
    return (log.filter(cond)
            .groupBy(day("processed_date").alias("day"), "source")
            .agg(F.count(F.lit(1)).alias("stories"))
            .withColumn("day", day_text("day"))
            .orderBy(F.desc("day"), "source"))


def platform_pivot(log: DataFrame, date_col: str = "queued_date") -> DataFrame:
    """Stories discovered per day, one column per platform (fixed list,
    so the pivot needs no extra pass to find its values)."""
    pivot = (log.groupBy(day(date_col).alias("day"))
             .pivot("source", schemas.PLATFORMS)
             .agg(F.count(F.lit(1))))
    return pivot.select(day_text("day").alias("day"), *[F.coalesce(F.col(p), F.lit(0)).cast("long").alias(p.replace("-", "_"))
                                 for p in schemas.PLATFORMS]).orderBy(F.desc("day"))


def fetched_by_day(log: DataFrame) -> DataFrame:
    """Per project, above-threshold stories per processed day."""
    return (log.filter(F.col("above_threshold"))
            .groupBy("project_id", day("processed_date").alias("day"))
            .agg(F.count(F.lit(1)).alias("stories"))
            .withColumn("day", day_text("day"))
            .orderBy("project_id", F.desc("day")))


def recent_sample(log: DataFrame, as_of: dt.datetime, n: int = 5, seed: int = 0,
                  days: int = 7) -> DataFrame:
    """per project and threshold flag, ``n`` stories picked at random
    among those published after ``date(as_of) - days``.

    "Random" is a seeded hash order (md5 of seed and id) so that every engine
    and every retry picks the same rows; ``row_number <= n`` limits each task
    before the shuffle.
    """
    recent = log.filter(F.col("published_date") > day_floor_before(as_of, days))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string")))
    return top_k(recent, ["project_id", "above_threshold"], [key], n).select(
        "project_id", "above_threshold", "id", "published_date", "model_score")


def latest_above(log: DataFrame, n: int = 20) -> DataFrame:
    """per project, the latest ``n`` above-threshold stories."""
    return top_k(log.filter(F.col("above_threshold")), ["project_id"],
                 [F.desc_nulls_last("published_date"), F.col("id")], n, rank_col="rank") \
        .select("project_id", "rank", "id", "published_date", "above_threshold")


def unposted_stories(log: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    """above-threshold stories never posted, processed in the last ``days``
    days (the system's literal predicate is always empty; this is its intent)."""
    cond = (F.col("above_threshold") & F.col("posted_date").isNull()
            & (F.col("processed_date") >= day_floor_before(as_of, days)))
    return log.filter(cond).select("id", "project_id", "processed_date", "model_score")


def posted_above(log: DataFrame) -> DataFrame:
    """posted above-threshold rows."""
    return log.filter(F.col("above_threshold") & F.col("posted_date").isNotNull()) \
        .select("id", "project_id", "source", "processed_date", "posted_date", "model_score")
