"""Registered queries: query windows, history, lifecycle state, whole run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vigil import schemas
from vigil.operators import log as logops
from vigil.operators import windows as W
from vigil.plans import class_queries as CQ
from vigil.plans import lifecycle, pipeline
from vigil.plans.log_queries import LOG_CTE, story_log
from vigil.plans.registry import query
from vigil.sources import fixtures
from vigil.sources.tables import table
from vigil.streaming import ingest as J

AS_OF = fixtures.AS_OF
PLATFORMS3 = [schemas.SOURCE_MEDIA_CLOUD, schemas.SOURCE_NEWSCATCHER, schemas.SOURCE_WAYBACK_MACHINE]
SPLIT_DAYS = 10   # history = what was queued before as_of - 10 days


def _ts(d: dt.datetime) -> str:
    return f"TIMESTAMP '{d:%Y-%m-%d %H:%M:%S}'"


def history_before(spark, sf_dir):
    """High-water marks as they stood ``SPLIT_DAYS`` ago, from the log."""
    cut = AS_OF - dt.timedelta(days=SPLIT_DAYS)
    log = story_log(spark, sf_dir)
    return (log.filter(F.col("queued_date") < F.lit(f"{cut:%Y-%m-%d %H:%M:%S}").cast("timestamp"))
            .groupBy("project_id", "source").agg(F.max("queued_date").alias("latest_date"))
            .withColumn("updated_at", F.lit(f"{cut:%Y-%m-%d %H:%M:%S}").cast("timestamp")))


HIST_SQL = f"""
, hist AS (SELECT project_id, source, max(queued_date) AS latest_date FROM story_log
           WHERE queued_date < {_ts(AS_OF - dt.timedelta(days=SPLIT_DAYS))} GROUP BY 1, 2)"""


def _projects_sql() -> str:
    def q(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    rows = ", ".join(f"({r[0]}, {q(r[6])})" for r in fixtures.PROJECT_ROWS)
    return f"(SELECT CAST(a AS BIGINT) AS project_id, b AS start_date FROM (VALUES {rows}) AS t(a, b))"


def _english_ids() -> str:
    return ", ".join(str(r[0]) for r in fixtures.PROJECT_ROWS if r[2] == "en")


# A project per customer; start dates that are missing, unreadable, early and late.
START_DATES = [None, "not a date", "2023-11-01T00:00:00Z", "2024-01-20T00:00:00Z", "2024-01-29T12:00:00Z"]
MANY_PROJECTS_SQL = ("(SELECT c_custkey AS project_id, ['" + "', '".join(d or "" for d in START_DATES) + "'][c_custkey % 5 + 1] AS start_date FROM customer)")


def many_projects(spark, sf_dir):
    start = F.element_at(F.array(*[F.lit(d) for d in START_DATES]), (F.col("c_custkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("project_id"), start.alias("start_date"))


def _windows_sql(source: str, with_history: bool, projects: str | None = None) -> str:
    off, win = schemas.PLATFORM_WINDOWS[source]
    default = _ts(AS_OF - dt.timedelta(days=off + win))
    end = _ts(AS_OF - dt.timedelta(days=off))
    first = f"coalesce(greatest({default}, TRY_CAST(replace(p.start_date, 'Z', '') AS TIMESTAMP)), {default})"
    if source == schemas.SOURCE_MEDIA_CLOUD:
        hist_start = f"coalesce(h.latest_date, {default})"
    else:
        hist_start = _ts(AS_OF - dt.timedelta(days=off + win + 1))
    if not with_history:
        return f"SELECT p.project_id, '{source}' AS source, {first} AS start_date, {end} AS end_date FROM {projects or _projects_sql()} p"
    return (f"SELECT p.project_id, '{source}' AS source, CASE WHEN h.project_id IS NOT NULL THEN {hist_start} "
            f"ELSE {first} END AS start_date, {end} AS end_date FROM {_projects_sql()} p "
            f"LEFT JOIN (SELECT * FROM hist WHERE source = '{source}') h USING (project_id)")


def windows(spark, projects, hist):
    out = None
    for s in PLATFORMS3:
        w = W.query_windows(projects, hist, s, AS_OF).withColumn("source", F.lit(s))
        out = w if out is None else out.unionByName(w)
    return out.select("project_id", "source", "start_date", "end_date")


@query("query_windows", sql=LOG_CTE + HIST_SQL + "\n"
       + "\nUNION ALL\n".join(_windows_sql(s, True) for s in PLATFORMS3))
def q_query_windows(spark, sf_dir):
    return windows(spark, fixtures.projects(spark), history_before(spark, sf_dir))


@query("query_windows_first_run", sql="\nUNION ALL\n".join(_windows_sql(s, False, MANY_PROJECTS_SQL) for s in PLATFORMS3))
def q_query_windows_first(spark, sf_dir):
    """B3 without any history, for as many projects as there are customers."""
    return windows(spark, many_projects(spark, sf_dir), spark.createDataFrame([], schemas.HISTORY))


@query("ensure_history", sql=LOG_CTE + HIST_SQL + f"""
SELECT p.project_id, 'google-alerts' AS source, CAST(NULL AS TIMESTAMP) AS latest_date, {_ts(AS_OF)} AS updated_at
FROM {_projects_sql()} p WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.project_id = p.project_id
                                          AND h.source = 'google-alerts' AND h.project_id IN ({_english_ids()}))""")
def q_ensure_history(spark, sf_dir):
    # a history in which only the English projects have rows so far
    english = fixtures.projects(spark).filter(F.col("language") == "en").select("project_id")
    hist = history_before(spark, sf_dir).join(english, "project_id", "left_semi")
    return W.ensure_history(fixtures.projects(spark), hist, schemas.SOURCE_GOOGLE_ALERTS, AS_OF)


@query("advance_history", sql=LOG_CTE + HIST_SQL + f"""
, found AS (SELECT project_id, source, max(queued_date) AS new_date FROM story_log
            WHERE queued_date >= {_ts(AS_OF - dt.timedelta(days=SPLIT_DAYS))} GROUP BY 1, 2),
both_ AS (SELECT coalesce(h.project_id, f.project_id) AS project_id, coalesce(h.source, f.source) AS source,
                 h.latest_date AS old_date, f.new_date FROM hist h FULL JOIN found f USING (project_id, source))
SELECT project_id, source,
       CASE WHEN new_date IS NULL THEN old_date
            ELSE greatest(old_date, new_date, CASE WHEN source = 'media-cloud'
                 THEN {_ts(AS_OF - dt.timedelta(days=14))} ELSE {_ts(AS_OF - dt.timedelta(days=350))} END) END AS latest_date,
       {_ts(AS_OF)} AS updated_at
FROM both_ WHERE source IN ('media-cloud', 'newscatcher', 'wayback-machine')""")
def q_advance_history(spark, sf_dir):
    log = story_log(spark, sf_dir)
    cut = F.lit(f"{AS_OF - dt.timedelta(days=SPLIT_DAYS):%Y-%m-%d %H:%M:%S}").cast("timestamp")
    found = log.filter(F.col("queued_date") >= cut)
    hist = history_before(spark, sf_dir)
    out = None
    for s in PLATFORMS3:
        a = W.advance_history(hist, found.filter(F.col("source") == s), s, AS_OF, date_col="queued_date")
        out = a if out is None else out.unionByName(a)
    return out


def _archive_stories(spark, sf_dir):
    d = fixtures.stories_from_documents(table(spark, sf_dir, "documents"))
    return d.select((F.col("story_id") % 10).alias("project_id"), "story_id", "url", "indexed_date",
                    (F.col("indexed_date") - F.make_dt_interval(days=(F.col("story_id") % 3).cast("int")))
                    .alias("publish_date"))


_OFFSET, _WINDOW = schemas.PLATFORM_WINDOWS[schemas.SOURCE_MEDIA_CLOUD]
ARCHIVE_CTE = f"""s AS (SELECT doc_id % 10 AS project_id, doc_id AS story_id,
                  concat('https://', source, '.example.org/story/', CAST(doc_id AS VARCHAR)) AS url,
                  {_ts(AS_OF)} - INTERVAL '1' DAY * (doc_id % 30) - INTERVAL '1' HOUR * (doc_id % 24) AS indexed_date
           FROM documents),
s2 AS (SELECT *, indexed_date - INTERVAL '1' DAY * (story_id % 3) AS publish_date FROM s),
w AS (<windows>),
j AS (SELECT s2.*, w.start_date, w.end_date,
             (indexed_date > start_date AND indexed_date <= {_ts(AS_OF)}
              AND CAST(publish_date AS DATE) BETWEEN CAST({_ts(AS_OF - dt.timedelta(days=_OFFSET + _WINDOW))} AS DATE)
                                                 AND CAST({_ts(AS_OF - dt.timedelta(days=_OFFSET))} AS DATE)) AS ok
      FROM s2 LEFT JOIN w USING (project_id))
"""
ARCHIVE_SQL = "WITH " + ARCHIVE_CTE.replace("<windows>", _windows_sql(schemas.SOURCE_MEDIA_CLOUD, False))


@query("in_window", sql=ARCHIVE_SQL + "SELECT project_id, story_id, url FROM j WHERE ok")
def q_in_window(spark, sf_dir):
    w = W.query_windows(fixtures.projects(spark), spark.createDataFrame([], schemas.HISTORY),
                        schemas.SOURCE_MEDIA_CLOUD, AS_OF)
    return W.in_window(_archive_stories(spark, sf_dir), w).select("project_id", "story_id", "url")


@query("late_rows", sql=ARCHIVE_SQL + "SELECT project_id, story_id, url FROM j WHERE NOT coalesce(ok, false)")
def q_late_rows(spark, sf_dir):
    w = W.query_windows(fixtures.projects(spark), spark.createDataFrame([], schemas.HISTORY),
                        schemas.SOURCE_MEDIA_CLOUD, AS_OF)
    return W.late_rows(_archive_stories(spark, sf_dir), w).select("project_id", "story_id", "url")


def _daily_windows(spark, sf_dir):
    return W.query_windows(fixtures.projects(spark), history_before(spark, sf_dir), schemas.SOURCE_MEDIA_CLOUD, AS_OF)


_DAILY_SQL = LOG_CTE + HIST_SQL + ", " + ARCHIVE_CTE.replace("<windows>", _windows_sql(schemas.SOURCE_MEDIA_CLOUD, True))


@query("in_window_with_history", sql=_DAILY_SQL + "SELECT project_id, story_id, url FROM j WHERE ok")
def q_in_window_with_history(spark, sf_dir):
    """B4 on a later run: indexed since the project's mark, published in the day range."""
    return W.in_window(_archive_stories(spark, sf_dir), _daily_windows(spark, sf_dir)).select("project_id", "story_id", "url")


@query("late_rows_with_history", sql=_DAILY_SQL + "SELECT project_id, story_id, url FROM j WHERE NOT coalesce(ok, false)")
def q_late_rows_with_history(spark, sf_dir):
    return W.late_rows(_archive_stories(spark, sf_dir), _daily_windows(spark, sf_dir)).select("project_id", "story_id", "url")


def lifecycle_of(log):
    """(inserts, events) whose fold is the log: what was known when a story was
    queued, and its scored, above and posted events."""
    inserts = log.select("id", "project_id", "model_id", "source", "published_date", "queued_date",
                         F.lit(None).cast("timestamp").alias("processed_date"),
                         F.lit(None).cast("double").alias("model_score"),
                         F.lit(False).alias("above_threshold"),
                         F.lit(None).cast("timestamp").alias("posted_date"))
    scored = log.filter(F.col("processed_date").isNotNull()).select(
        "id", "model_score", "processed_date", F.lit(None).cast("boolean").alias("above_threshold"),
        F.lit(None).cast("timestamp").alias("posted_date"), F.col("processed_date").alias("event_time"))
    flagged = log.filter(F.col("above_threshold")).select(
        "id", F.lit(None).cast("double").alias("model_score"), F.lit(None).cast("timestamp").alias("processed_date"),
        F.lit(True).alias("above_threshold"), F.lit(None).cast("timestamp").alias("posted_date"),
        F.col("processed_date").alias("event_time"))
    posted = log.filter(F.col("posted_date").isNotNull()).select(
        "id", F.lit(None).cast("double").alias("model_score"), F.lit(None).cast("timestamp").alias("processed_date"),
        F.lit(None).cast("boolean").alias("above_threshold"), "posted_date",
        F.col("posted_date").alias("event_time"))
    return inserts, scored.unionByName(flagged).unionByName(posted)


@query("log_state", sql=LOG_CTE + "SELECT * FROM story_log")
def q_log_state(spark, sf_dir):
    """The log rebuilt from insert rows plus lifecycle events equals the log."""
    log = story_log(spark, sf_dir)
    return logops.log_state(*lifecycle_of(log)).select(*log.columns)


SNAPSHOTS = [10, 17, 24, 60]     # days of the fixture's month after which its log is compacted


@query("log_state_incremental", sql=LOG_CTE + "SELECT * FROM story_log")
def q_log_state_incremental(spark, sf_dir):
    """The same state over snapshots, each folded from the one before and
    the inserts and events since then."""
    log = story_log(spark, sf_dir)
    inserts, events = lifecycle_of(log)
    path, start = J.run_dir(spark, "snapshots"), dt.datetime(2024, 1, 1)
    since = None
    for days in SNAPSHOTS:
        upto = start + dt.timedelta(days=days)
        snapshot = logops.compact(spark, path, inserts, events, upto, since)
        since = upto
    return logops.state_of(snapshot).select(*log.columns)


def _deleted_folders(spark, sf_dir):
    path = J.run_dir(spark, "retention")
    log = story_log(spark, sf_dir)
    logops.append_log(log, path)
    return log, path, logops.delete_old_days(spark, path, 20, AS_OF)


@query("deleted_day_folders", sql=LOG_CTE + f"""
SELECT strftime(CAST(queued_date AS DATE), '%Y-%m-%d') AS day, count(*) AS deleted FROM story_log
WHERE CAST(queued_date AS DATE) < CAST({_ts(AS_OF - dt.timedelta(days=20))} AS DATE) GROUP BY 1""")
def q_deleted_day_folders(spark, sf_dir):
    """The log's day folders that retention deletes, with their rows."""
    return _deleted_folders(spark, sf_dir)[2]


@query("log_after_retention", sql=LOG_CTE + f"""
SELECT * FROM story_log WHERE queued_date IS NULL OR queued_date >= {_ts(AS_OF - dt.timedelta(days=20))}""")
def q_log_after_retention(spark, sf_dir):
    """What is left of a log on disk when its old day folders are gone."""
    log, path, _ = _deleted_folders(spark, sf_dir)
    kept, _ = logops.retain(spark.read.parquet(path), 20, AS_OF)
    return kept.select(*log.columns)


def run(spark, sf_dir):
    stories = fixtures.stories_from_documents(table(spark, sf_dir, "documents")).withColumn(
        "publish_date", F.col("indexed_date") - F.make_dt_interval(days=(F.col("story_id") % 3).cast("int")))
    return pipeline.run(stories, fixtures.projects(spark), fixtures.project_terms(spark),
                        fixtures.models(spark), CQ.model_terms(spark, sf_dir), AS_OF)


def _pipeline_sql() -> str:
    from vigil.plans.search_queries import _match_sql
    match = _match_sql(True).strip()
    assert match.startswith("WITH ")
    match = match[len("WITH "):]
    found = f"""found AS (
  SELECT m.project_id, m.doc_id AS story_id, x.url, regexp_replace(x.url, '^https?://', '') AS normalized_url,
         x.indexed_date
  FROM m JOIN (SELECT doc_id, concat('https://', source, '.example.org/story/', CAST(doc_id AS VARCHAR)) AS url,
                      {_ts(AS_OF)} - INTERVAL '1' DAY * (doc_id % 30) - INTERVAL '1' HOUR * (doc_id % 24) AS indexed_date
               FROM documents) x USING (doc_id)),
dedup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY project_id, coalesce(normalized_url, url)
                                                      ORDER BY story_id) AS rn FROM found) WHERE rn = 1),
kept AS (SELECT * EXCLUDE (rn) FROM dedup)"""
    stories = "SELECT k.story_id, k.project_id, d.text AS story_text FROM kept k JOIN documents d ON d.doc_id = k.story_id"
    return CQ.score_cte(stories, match + ",\n" + found)


_ABOVE_SQL = """
, above AS (
  SELECT s.project_id, sha256(concat_ws('|', CAST(s.project_id AS VARCHAR), coalesce(k.normalized_url, k.url))) AS log_db_id
  FROM scored s JOIN proj p USING (project_id) JOIN kept k ON k.story_id = s.story_id AND k.project_id = s.project_id
  WHERE s.model_score >= coalesce(p.min_confidence, 0)),
numbered AS (SELECT project_id, (row_number() OVER (PARTITION BY project_id ORDER BY log_db_id) - 1) // 100 AS batch_no
             FROM above)
"""


@query("pipeline_batches", sql=_pipeline_sql() + _ABOVE_SQL + """
SELECT project_id, batch_no, count(*) AS n_stories FROM numbered GROUP BY 1, 2""")
def q_pipeline_batches(spark, sf_dir):
    return run(spark, sf_dir).batches.select("project_id", "batch_no", "n_stories")


def _summary_sql() -> str:
    titles = ", ".join(f"({r[0]}, '{r[1]}')" for r in fixtures.PROJECT_ROWS)
    cap = schemas.PLATFORM_CAPS[schemas.SOURCE_MEDIA_CLOUD]
    return _pipeline_sql() + f"""
, pt AS (SELECT CAST(a AS BIGINT) AS project_id, b AS title FROM (VALUES {titles}) AS t(a, b)),
f AS (SELECT project_id, count(*) AS found FROM found GROUP BY 1),
k AS (SELECT project_id, count(*) AS kept, count(DISTINCT url) AS unique_urls FROM kept GROUP BY 1),
per AS (SELECT pt.project_id, pt.title, coalesce(found, 0) AS found, coalesce(kept, 0) AS kept,
               coalesce(unique_urls, 0) AS unique_urls FROM pt LEFT JOIN f USING (project_id) LEFT JOIN k USING (project_id))
SELECT project_id, title, CAST(found AS BIGINT) AS found, CAST(kept AS BIGINT) AS kept,
       CAST(unique_urls AS BIGINT) AS unique_urls, kept > {cap * schemas.BROAD_QUERY_FRACTION} AS too_broad,
       printf('Project %d - %s: %d stories', project_id, title, kept) AS line FROM per"""


def _total_sql() -> str:
    return _summary_sql().rsplit("SELECT project_id, title,", 1)[0] + """
SELECT CAST(sum(found) AS BIGINT) AS found, CAST(sum(kept) AS BIGINT) AS kept,
       CAST(sum(unique_urls) AS BIGINT) AS unique_urls,
       printf('Done - pulled %d stories.', CAST(sum(kept) AS BIGINT)) AS line FROM per"""


def _summary(spark, sf_dir):
    from vigil.operators.output import run_summary
    r = run(spark, sf_dir)
    return run_summary(r.found, r.kept, fixtures.projects(spark), schemas.PLATFORM_CAPS[schemas.SOURCE_MEDIA_CLOUD])


@query("pipeline_summary", sql=_summary_sql())
def q_pipeline_summary(spark, sf_dir):
    """E11 per-project rows of the run summary."""
    return _summary(spark, sf_dir).filter(F.col("project_id").isNotNull())


@query("pipeline_total", sql=_total_sql())
def q_pipeline_total(spark, sf_dir):
    """E11 grand-total row of the same rollup."""
    return _summary(spark, sf_dir).filter(F.col("project_id").isNull()) \
        .select("found", "kept", "unique_urls", "line")


@query("pipeline_log_rows", sql=_pipeline_sql() + f"""
SELECT sha256(concat_ws('|', CAST(k.project_id AS VARCHAR), coalesce(k.normalized_url, k.url))) AS id,
       k.project_id, p.model_id, k.url, k.normalized_url, k.indexed_date - INTERVAL '1' DAY * (k.story_id % 3) AS published_date,
       {_ts(AS_OF)} AS queued_date, false AS above_threshold, 'media-cloud' AS source
FROM kept k JOIN proj p USING (project_id)""")
def q_pipeline_log_rows(spark, sf_dir):
    """A10: the log rows a run inserts (one per kept story, keyed by I16)."""
    kept = run(spark, sf_dir).kept
    models = fixtures.projects(spark).select("project_id", F.col("language_model_id").alias("model_id"))
    rows = logops.log_rows(kept.join(models, "project_id"),
                           queued_at=F.lit(f"{AS_OF:%Y-%m-%d %H:%M:%S}").cast("timestamp"),
                           source=schemas.SOURCE_MEDIA_CLOUD)
    return rows.select("id", "project_id", "model_id", "url", "normalized_url", "published_date",
                       "queued_date", "above_threshold", "source")


PROCESSED_AT, POSTED_AT = AS_OF + dt.timedelta(hours=1), AS_OF + dt.timedelta(hours=2)


@query("run_state", sql=_pipeline_sql() + f"""
SELECT sha256(concat_ws('|', CAST(k.project_id AS VARCHAR), coalesce(k.normalized_url, k.url))) AS id, k.project_id, p.model_id,
       round(s.model_score, 6) AS model_score, round(s.model_1_score, 6) AS model_1_score, round(s.model_2_score, 6) AS model_2_score,
       k.indexed_date - INTERVAL '1' DAY * (k.story_id % 3) AS published_date, {_ts(AS_OF)} AS queued_date,
       CASE WHEN s.model_score IS NOT NULL THEN {_ts(PROCESSED_AT)} END AS processed_date,
       CASE WHEN s.model_score >= coalesce(p.min_confidence, 0) THEN {_ts(POSTED_AT)} END AS posted_date,
       coalesce(s.model_score >= coalesce(p.min_confidence, 0), false) AS above_threshold, 'media-cloud' AS source, k.url, k.normalized_url
FROM kept k JOIN proj p USING (project_id) JOIN scored s ON s.story_id = k.story_id AND s.project_id = k.project_id""")
def q_run_state(spark, sf_dir):
    """The log as one committed run leaves it."""
    path = J.run_dir(spark, "lifecycle")
    lifecycle.commit_run(spark, run(spark, sf_dir), path, "first", AS_OF, PROCESSED_AT, POSTED_AT)
    state = lifecycle.run_state(spark, path)
    return state.select(*[F.round(c, 6).alias(c) if c.endswith("_score") else c for c in state.columns])
