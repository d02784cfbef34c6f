"""Registered queries: Structured Streaming runs over the test tables.

Each runs a stream with ``trigger(availableNow=True)`` from the table's
directory into files under the shared checkpoint folder and returns the
written result read back as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions.urls import normalize_url
from vigil.plans import class_queries as CQ
from vigil.plans.feed_queries import FEED_CTE
from vigil.plans.log_queries import LOG_CTE
from vigil.plans.pipeline_queries import ARCHIVE_SQL as PQ_ARCHIVE_SQL
from vigil.plans.registry import query
from vigil.sources import fixtures
from vigil.sources.tables import table
from vigil.sources.versions import file_system
from vigil.streaming import ingest as J


def _stream(spark, sf_dir, name):
    """A table as a stream, whether it is one file or a folder of files."""
    schema = table(spark, sf_dir, name).schema
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    fs, p = file_system(spark, path)
    if fs.getFileStatus(p).isDirectory():
        return J.read_stream(spark, path, schema, file_glob="*")
    return J.read_stream(spark, sf_dir, schema, file_glob=f"{name}.parquet")


def _log_stream(spark, sf_dir):
    return fixtures.story_log_from_events(_stream(spark, sf_dir, "events"))


def _sink_files(df, name, spark, mode="append"):
    d = J.run_dir(spark, name)
    J.run_available(df.writeStream.outputMode(mode).format("parquet").option("path", f"{d}/out"), f"{d}/ck")
    return spark.read.parquet(f"{d}/out")


@query("stream_daily_counts", sql=LOG_CTE + """
, m AS (SELECT max(queued_date) - INTERVAL '1' DAY AS wm FROM story_log)
SELECT strftime(date_trunc('day', queued_date), '%Y-%m-%d') AS day, source, count(*) AS stories
FROM story_log, m WHERE date_trunc('day', queued_date) + INTERVAL '1' DAY <= m.wm GROUP BY 1, 2""")
def q_stream_daily_counts(spark, sf_dir):
    out = _sink_files(J.daily_counts_stream(_log_stream(spark, sf_dir)), "daily", spark)
    return out.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "source", "stories")


@query("stream_volume_alert", sql=LOG_CTE + """
, m AS (SELECT max(processed_date) - INTERVAL '1' DAY AS wm, date_trunc('day', min(processed_date)) AS first,
               date_trunc('day', max(processed_date)) AS last FROM story_log),
w AS (SELECT unnest(generate_series(first - INTERVAL '3' DAY, last, INTERVAL '1' DAY)) AS wstart, wm FROM m),
c AS (SELECT w.wstart, count(l.processed_date) AS n FROM w LEFT JOIN story_log l
      ON l.processed_date >= w.wstart AND l.processed_date < w.wstart + INTERVAL '4' DAY
      WHERE w.wstart + INTERVAL '4' DAY <= w.wm GROUP BY 1)
SELECT strftime(wstart, '%Y-%m-%d') AS window_start, n AS total_stories, n / 4.0 AS average_per_day, n / 4.0 < 40000 AS alert FROM c""")
def q_stream_volume_alert(spark, sf_dir):
    """Every window of the log's calendar, with or without stories: the ticks
    of its days are a second stream."""
    d = J.run_dir(spark, "clock")
    log = fixtures.story_log_from_events(table(spark, sf_dir, "events"))
    J.calendar(log.agg(F.min("processed_date").alias("first"), F.max("processed_date").alias("last"))).write.parquet(f"{d}/ticks")
    clock = J.read_stream(spark, f"{d}/ticks", spark.read.parquet(f"{d}/ticks").schema)
    out = _sink_files(J.volume_alert_stream(_log_stream(spark, sf_dir), clock), "alert", spark)
    return out.select(F.date_format("window.start", "yyyy-MM-dd").alias("window_start"),
                      "total_stories", "average_per_day", "alert")


@query("stream_dedupe_keys", sql=FEED_CTE + """
SELECT DISTINCT project_id, coalesce(normalized_url, url) AS url_key FROM feed""")
def q_stream_dedupe(spark, sf_dir):
    feed = (fixtures.feed_from_pages(_stream(spark, sf_dir, "pages"))
            .withColumn("normalized_url", F.coalesce(normalize_url("url"), F.col("url")))
            .withColumn("queued_date", F.lit(f"{fixtures.AS_OF:%Y-%m-%d %H:%M:%S}").cast("timestamp")))
    out = _sink_files(J.dedupe_stream(feed), "dedupe", spark)
    return out.select("project_id", F.col("normalized_url").alias("url_key"))


@query("stream_high_water", sql=LOG_CTE + """
SELECT project_id, source, max(queued_date) AS latest_date FROM story_log GROUP BY 1, 2""")
def q_stream_high_water(spark, sf_dir):
    d = J.run_dir(spark, "hwm")
    agg = J.high_water_stream(_log_stream(spark, sf_dir))
    # the state is one row per (project, source); each batch is a new version
    J.run_available(agg.writeStream.outputMode("complete").foreachBatch(J.versioned_table_writer(f"{d}/out")), f"{d}/ck")
    return J.read_versioned(spark, f"{d}/out")


@query("stream_replay_safe_log", sql=FEED_CTE + "SELECT feed_pos, project_id, url, normalized_url FROM deduped")
def q_stream_replay_safe_log(spark, sf_dir):
    d = J.run_dir(spark, "log")
    feed = fixtures.feed_from_pages(_stream(spark, sf_dir, "pages")).withColumn("normalized_url", normalize_url("url"))
    J.run_available(feed.writeStream.foreachBatch(J.replay_safe_log_writer(f"{d}/log", "feed_pos")), f"{d}/ck")
    return spark.read.parquet(f"{d}/log").select("feed_pos", "project_id", "url", "normalized_url")


@query("stream_scores", sql=CQ.SCORE_CTE + """
SELECT story_id, project_id, model_id, round(model_1_score, 6) AS model_1_score,
       round(model_2_score, 6) AS model_2_score, round(model_score, 6) AS model_score FROM scored""")
def q_stream_scores(spark, sf_dir):
    from vigil.operators import classify as C
    d = J.run_dir(spark, "scores")
    weights = CQ.model_terms(spark, sf_dir)
    projects, models = fixtures.projects(spark), fixtures.models(spark)
    stories = _stream(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("story_id"), (F.col("doc_id") % 10).alias("project_id"), F.col("text").alias("story_text"))

    def scoring(batch):
        return C.score(batch, projects, models, weights).select(
            "story_id", "project_id", "model_id", F.round("model_1_score", 6).alias("model_1_score"),
            F.round("model_2_score", 6).alias("model_2_score"), F.round("model_score", 6).alias("model_score"))
    J.run_available(stories.writeStream.foreachBatch(J.foreach_batch_writer(scoring, f"{d}/out")), f"{d}/ck")
    return spark.read.parquet(f"{d}/out").drop("run", "batch_id")


def _late_split(spark, sf_dir):
    from vigil import schemas
    from vigil.operators import windows as W
    d = J.run_dir(spark, "late")
    w = W.query_windows(fixtures.projects(spark), spark.createDataFrame([], schemas.HISTORY),
                        schemas.SOURCE_MEDIA_CLOUD, fixtures.AS_OF)
    docs = _stream(spark, sf_dir, "documents")
    stories = fixtures.stories_from_documents(docs).select(
        (F.col("story_id") % 10).alias("project_id"), "story_id", "url", "indexed_date",
        (F.col("indexed_date") - F.make_dt_interval(days=(F.col("story_id") % 3).cast("int"))).alias("publish_date"))
    J.run_available(stories.writeStream.foreachBatch(J.split_late_writer(w, f"{d}/out")), f"{d}/ck")
    return d


@query("stream_in_window", sql=PQ_ARCHIVE_SQL + "SELECT project_id, story_id, url FROM j WHERE ok")
def q_stream_in_window(spark, sf_dir):
    d = _late_split(spark, sf_dir)
    return spark.read.parquet(f"{d}/out/kept").select("project_id", "story_id", "url")


@query("stream_late_rows", sql=PQ_ARCHIVE_SQL + "SELECT project_id, story_id, url FROM j WHERE NOT coalesce(ok, false)")
def q_stream_late_rows(spark, sf_dir):
    d = _late_split(spark, sf_dir)
    return spark.read.parquet(f"{d}/out/late").select("project_id", "story_id", "url")
