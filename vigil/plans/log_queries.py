"""Registered report queries over the story log (derived from ``events``)."""

from __future__ import annotations

import datetime as dt

from vigil.operators import log as logops
from vigil.operators import reports as R
from vigil.plans.registry import query
from vigil.sources import fixtures
from vigil.sources.tables import table

AS_OF = fixtures.AS_OF


def _d(days: int) -> str:
    return f"DATE '{(AS_OF.date() - dt.timedelta(days=days)).isoformat()}'"


def _t(days: int) -> str:
    return f"TIMESTAMP '{(AS_OF - dt.timedelta(days=days)).strftime('%Y-%m-%d %H:%M:%S')}'"


# The story-log mapping, as a CTE (FIXTURES §4.1); the Spark side is
# fixtures.story_log_from_events.
LOG_CTE = """
WITH base AS (
  SELECT event_id AS id, user_id % 10 AS project_id, user_id % 3 + 1 AS model_id,
         CASE event_type WHEN 'click' THEN 'media-cloud' WHEN 'view' THEN 'newscatcher'
              WHEN 'purchase' THEN 'wayback-machine' WHEN 'signup' THEN 'google-alerts'
              ELSE 'media-cloud' END AS source,
         ts - INTERVAL '1' DAY * (event_id % 4) AS published_date,
         ts AS queued_date,
         CASE WHEN event_type = 'error' THEN NULL ELSE ts + INTERVAL '1' HOUR * (user_id % 48) END AS processed_date,
         CASE WHEN event_type = 'error' THEN NULL ELSE least(value / 200.0, 1.0) END AS model_score
  FROM events),
story_log AS (
  SELECT base.*, coalesce(model_score >= 0.2 + 0.05 * (project_id % 4), false) AS above_threshold,
         CASE WHEN model_score >= 0.2 + 0.05 * (project_id % 4) AND id % 10 <> 0
              THEN processed_date + INTERVAL '1' HOUR END AS posted_date
  FROM base)
"""


def story_log(spark, sf_dir):
    return fixtures.story_log_from_events(table(spark, sf_dir, "events"))


@query("story_log", sql=LOG_CTE + "SELECT * FROM story_log")
def q_story_log(spark, sf_dir):
    return story_log(spark, sf_dir)


@query("daily_posted_unposted_above", sql=LOG_CTE + f"""
SELECT project_id, strftime(CAST(processed_date AS DATE), '%Y-%m-%d') AS day, count(*) AS stories FROM story_log
WHERE processed_date IS NOT NULL AND processed_date >= {_d(30)}
  AND above_threshold = true AND posted_date IS NULL
GROUP BY 1, 2""")
def q_daily_counts(spark, sf_dir):
    return R.daily_counts(story_log(spark, sf_dir), "processed_date", AS_OF, 30, by=["project_id"],
                          above_threshold=True, is_posted=False)


@query("stories_by_posted_day", sql=LOG_CTE + f"""
SELECT project_id, strftime(CAST(processed_date AS DATE), '%Y-%m-%d') AS day, count(*) AS stories FROM story_log
WHERE processed_date IS NOT NULL AND processed_date >= {_d(45)} AND above_threshold = true
GROUP BY 1, 2""")
def q_by_posted_day(spark, sf_dir):
    return R.stories_by_posted_day(story_log(spark, sf_dir), AS_OF)


@query("stories_by_processed_day", sql=LOG_CTE + f"""
SELECT project_id, source, strftime(CAST(processed_date AS DATE), '%Y-%m-%d') AS day, count(*) AS stories FROM story_log
WHERE processed_date IS NOT NULL AND processed_date >= {_d(45)}
GROUP BY 1, 2, 3""")
def q_by_processed_day(spark, sf_dir):
    return R.stories_by_processed_day(story_log(spark, sf_dir), AS_OF)


@query("stories_by_published_day", sql=LOG_CTE + f"""
SELECT project_id, source, strftime(CAST(published_date AS DATE), '%Y-%m-%d') AS day, count(*) AS stories FROM story_log
WHERE published_date IS NOT NULL AND published_date >= {_d(30)}
GROUP BY 1, 2, 3""")
def q_by_published_day(spark, sf_dir):
    return R.stories_by_published_day(story_log(spark, sf_dir), AS_OF)


@query("posted_above_count", sql=LOG_CTE + """
SELECT project_id, count(*) FILTER (WHERE above_threshold AND posted_date IS NOT NULL) AS stories
FROM story_log GROUP BY 1""")
def q_posted_above_count(spark, sf_dir):
    return R.posted_above_count(story_log(spark, sf_dir))


@query("posted_above_count_10d", sql=LOG_CTE + f"""
SELECT project_id, count(*) FILTER (WHERE above_threshold AND posted_date IS NOT NULL
                                    AND posted_date >= {_d(10)}) AS stories
FROM story_log GROUP BY 1""")
def q_posted_above_count_10d(spark, sf_dir):
    return R.posted_above_count(story_log(spark, sf_dir), AS_OF, since_days=10)


@query("unposted_above_count", sql=LOG_CTE + """
SELECT project_id, count(*) FILTER (WHERE above_threshold AND posted_date IS NULL) AS stories
FROM story_log GROUP BY 1""")
def q_unposted_above_count(spark, sf_dir):
    return R.unposted_above_count(story_log(spark, sf_dir))


@query("below_count", sql=LOG_CTE + """
SELECT project_id, count(*) FILTER (WHERE NOT above_threshold) AS stories
FROM story_log GROUP BY 1""")
def q_below_count(spark, sf_dir):
    return R.below_count(story_log(spark, sf_dir))


@query("project_story_counts", sql=LOG_CTE + """
SELECT project_id,
       count(*) FILTER (WHERE above_threshold AND posted_date IS NOT NULL) AS posted_above,
       count(*) FILTER (WHERE above_threshold AND posted_date IS NULL) AS unposted_above,
       count(*) FILTER (WHERE NOT above_threshold) AS below,
       count(*) AS total
FROM story_log GROUP BY 1""")
def q_project_story_counts(spark, sf_dir):
    return R.project_story_counts(story_log(spark, sf_dir))


@query("score_histogram", sql=LOG_CTE + """
SELECT project_id, CAST(round(CAST(model_score AS DECIMAL(38,18)), 1) AS DOUBLE) AS value,
       count(*) AS frequency
FROM story_log WHERE model_score IS NOT NULL GROUP BY 1, 2""")
def q_score_histogram(spark, sf_dir):
    return R.score_histogram(story_log(spark, sf_dir))


@query("processed_total", sql=LOG_CTE + f"""
SELECT count(*) AS total_stories FROM story_log WHERE processed_date >= {_t(4)}""")
def q_processed_total(spark, sf_dir):
    return R.processed_total(story_log(spark, sf_dir), AS_OF, 4)


@query("volume_alert", sql=LOG_CTE + f"""
, t AS (SELECT count(*) AS total_stories FROM story_log WHERE processed_date >= {_t(4)})
SELECT CAST(total_stories AS BIGINT) AS total_stories, CAST(4 AS BIGINT) AS days,
       total_stories / 4.0 AS average_per_day,
       total_stories / 4.0 < 40000 AS alert,
       CASE WHEN total_stories / 4.0 < 40000 THEN
         'Warning: Average stories per day in the last 4 days is '
         || printf('%.1f', round_even(total_stories / 4.0, 1))
         || ', which is far below the expected value of >= 40000.' END AS message
FROM t""")
def q_volume_alert(spark, sf_dir):
    return R.volume_alert(R.processed_total(story_log(spark, sf_dir), AS_OF, 4))


@query("backlog_by_day", sql=LOG_CTE + """
SELECT strftime(CAST(queued_date AS DATE), '%Y-%m-%d') AS day, count(*) AS stories FROM story_log
WHERE processed_date IS NULL GROUP BY 1""")
def q_backlog_by_day(spark, sf_dir):
    return R.backlog_by_day(story_log(spark, sf_dir))


@query("by_day_threshold", sql=LOG_CTE + """
SELECT strftime(CAST(processed_date AS DATE), '%Y-%m-%d') AS day, above_threshold, count(*) AS stories FROM story_log
GROUP BY 1, 2""")
def q_by_day_threshold(spark, sf_dir):
    return R.by_day_threshold(story_log(spark, sf_dir))


@query("above_by_published_day", sql=LOG_CTE + """
, d AS (SELECT project_id, strftime(CAST(published_date AS DATE), '%Y-%m-%d') AS day, count(*) AS stories
        FROM story_log WHERE above_threshold GROUP BY 1, 2)
SELECT project_id, day, stories FROM (
  SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY day DESC NULLS LAST) AS rn FROM d)
WHERE rn <= 10""")
def q_above_by_published_day(spark, sf_dir):
    return R.above_by_published_day(story_log(spark, sf_dir), 10)


@query("sent_by_day_source", sql=LOG_CTE + f"""
SELECT strftime(CAST(processed_date AS DATE), '%Y-%m-%d') AS day, source, count(*) AS stories FROM story_log
WHERE processed_date IS NOT NULL AND above_threshold AND processed_date >= {_d(45)}
GROUP BY 1, 2""")
def q_sent_by_day_source(spark, sf_dir):
    return R.sent_by_day_source(story_log(spark, sf_dir), AS_OF, 45)


@query("platform_pivot", sql=LOG_CTE + """
SELECT strftime(CAST(queued_date AS DATE), '%Y-%m-%d') AS day,
       count(*) FILTER (WHERE source = 'google-alerts') AS google_alerts,
       count(*) FILTER (WHERE source = 'media-cloud') AS media_cloud,
       count(*) FILTER (WHERE source = 'newscatcher') AS newscatcher,
       count(*) FILTER (WHERE source = 'wayback-machine') AS wayback_machine
FROM story_log GROUP BY 1""")
def q_platform_pivot(spark, sf_dir):
    return R.platform_pivot(story_log(spark, sf_dir))


@query("fetched_by_day", sql=LOG_CTE + """
SELECT project_id, strftime(CAST(processed_date AS DATE), '%Y-%m-%d') AS day, count(*) AS stories FROM story_log
WHERE above_threshold GROUP BY 1, 2""")
def q_fetched_by_day(spark, sf_dir):
    return R.fetched_by_day(story_log(spark, sf_dir))


@query("recent_sample", sql=LOG_CTE + f"""
SELECT project_id, above_threshold, id, published_date, model_score FROM (
  SELECT *, row_number() OVER (PARTITION BY project_id, above_threshold
                               ORDER BY md5(concat_ws('|', '0', CAST(id AS VARCHAR)))) AS rn
  FROM story_log WHERE published_date > {_d(7)})
WHERE rn <= 5""")
def q_recent_sample(spark, sf_dir):
    return R.recent_sample(story_log(spark, sf_dir), AS_OF, n=5, seed=0)


@query("latest_above", sql=LOG_CTE + """
SELECT project_id, rank, id, published_date, above_threshold FROM (
  SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY published_date DESC NULLS LAST, id) AS rank
  FROM story_log WHERE above_threshold)
WHERE rank <= 20""")
def q_latest_above(spark, sf_dir):
    return R.latest_above(story_log(spark, sf_dir), 20)


@query("unposted_stories", sql=LOG_CTE + f"""
SELECT id, project_id, processed_date, model_score FROM story_log
WHERE above_threshold AND posted_date IS NULL AND processed_date >= {_d(20)}""")
def q_unposted_stories(spark, sf_dir):
    return R.unposted_stories(story_log(spark, sf_dir), AS_OF, 20)


@query("posted_above", sql=LOG_CTE + """
SELECT id, project_id, source, processed_date, posted_date, model_score FROM story_log
WHERE above_threshold AND posted_date IS NOT NULL""")
def q_posted_above(spark, sf_dir):
    return R.posted_above(story_log(spark, sf_dir))


@query("retained_log", sql=LOG_CTE + f"""
SELECT * FROM story_log WHERE queued_date IS NULL OR queued_date >= {_t(20)}""")
def q_retained_log(spark, sf_dir):
    kept, _ = logops.retain(story_log(spark, sf_dir), age_days=20, as_of=AS_OF)
    return kept


@query("retention_deleted_by_day", sql=LOG_CTE + f"""
SELECT strftime(CAST(queued_date AS DATE), '%Y-%m-%d') AS day, count(*) AS deleted FROM story_log
WHERE queued_date < {_t(20)} GROUP BY 1""")
def q_retention_deleted(spark, sf_dir):
    _, deleted = logops.retain(story_log(spark, sf_dir), age_days=20, as_of=AS_OF)
    return logops.deleted_by_day(deleted)
