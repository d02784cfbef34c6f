"""Structured Streaming: incremental ingest, stateful de-duplication,
replay-safe logging, stream scoring, running high-water marks, daily counts
and the low-volume alert (J1-J8).

Every stateful operator is bounded: de-duplication and windows forget state
behind a watermark; the high-water mark keeps one row per (project, source).
Windows of an alert follow a clock, a stream of ticks merged with the log, so
that a silent stretch, or a total outage, has windows too.  A log written here
is laid out by hash buckets of its keys, so that a micro-batch looks up its
stories in the buckets they fall in.  A table that is rewritten whole is kept
in versions with a commit marker each: readers see the last whole one.
Sinks are files under the shared checkpoint folder; a micro-batch writes its
own directory named by the query and the batch id, so a retried batch replaces
its own output instead of adding rows, and a query that starts again with a
fresh checkpoint (its batches count from 0) never overwrites earlier rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import schemas
from vigil.operators import dedupe as D
from vigil.session import checkpoint_dir
from vigil.sources.versions import file_system, run_of, read_versioned, versioned_table_writer  # noqa: F401


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run (output + its checkpoint)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex[:12]}"


def read_stream(spark: SparkSession, directory: str, schema: T.StructType, file_glob: str = "*.parquet",
                fmt: str = "parquet", max_files_per_trigger: int = 1000) -> DataFrame:
    """New files of a directory as an unbounded table (explicit schema,
    bounded micro-batches)."""
    return (spark.readStream.format(fmt).schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("pathGlobFilter", file_glob).load(directory))


def dedupe_stream(stories: DataFrame, event_time: str = "queued_date", delay: str = "30 days",
                  keys: tuple[str, ...] = ("project_id", "normalized_url")) -> DataFrame:
    """Drop a story whose (project, URL key) was seen within the watermark."""
    return stories.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_counts_stream(log: DataFrame, event_time: str = "queued_date", delay: str = "1 day",
                        by: tuple[str, ...] = ("source",)) -> DataFrame:
    """Per day and group, emitted once the day is behind the watermark."""
    return (log.withWatermark(event_time, delay)
            .groupBy(F.window(event_time, "1 day"), *by).agg(F.count(F.lit(1)).alias("stories")))


def clock_stream(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """``tick``: the wall clock as a stream (the rate source)."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load().select(F.col("timestamp").alias("tick"))


def calendar(bounds: DataFrame, step: str = "1 day") -> DataFrame:
    """``tick``: every step from the day of ``first`` to the day of ``last``
    (``bounds``: one row), the clock of a replay."""
    days = F.sequence(F.date_trunc("day", "first"), F.date_trunc("day", "last"), F.expr(f"INTERVAL {step}"))
    return bounds.filter("first IS NOT NULL").select(F.explode(days).alias("tick"))


def volume_alert_stream(log: DataFrame, clock: DataFrame, event_time: str = "processed_date", delay: str = "1 day",
                        days: int = schemas.STORY_COUNT_WINDOW_SIZE,
                        threshold: int = schemas.STORY_COUNT_THRESHOLD) -> DataFrame:
    """The low-volume alert on a sliding ``days``-day window advanced daily.

    Ticks of the ``clock`` (one a day at least) join the log's stories with
    weight 0, before the watermark: every window that the clock passes exists
    and closes as the clock moves on, also when no story arrives any more."""
    rows = (log.select(F.col(event_time).alias("at"), F.lit(1).alias("stories"))
            .unionByName(clock.select(F.col("tick").cast("timestamp").alias("at"), F.lit(0).alias("stories"))))
    counts = (rows.withWatermark("at", delay).groupBy(F.window("at", f"{days} days", "1 day"))
              .agg(F.sum("stories").alias("total_stories")))
    avg = F.col("total_stories") / F.lit(days)
    return counts.select("window", "total_stories", avg.alias("average_per_day"),
                         (avg < F.lit(threshold)).alias("alert"))


def high_water_stream(log: DataFrame, date_col: str = "queued_date") -> DataFrame:
    """Running latest date per (project, source); state is one row per key."""
    return log.groupBy("project_id", "source").agg(F.max(date_col).alias("latest_date"))


def _batch_path(path: str, run: str, batch_id: int) -> str:
    return f"{path}/run={run}/batch_id={batch_id}"


KEY_BUCKETS = 256      # of a log written by ``replay_safe_log_writer``


def key_bucket(df: DataFrame, keys: Sequence[str] = ("project_id",), buckets: int = KEY_BUCKETS) -> Column:
    """The bucket of a story's key: the same for every spelling of its URL."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], D.dedupe_key(df)), F.lit(buckets)).cast("int")


def seen_in_buckets(log: DataFrame, batch: DataFrame, keys: Sequence[str] = ("project_id",), buckets: int = KEY_BUCKETS) -> DataFrame:
    """The part of a bucketed log that may hold the batch's keys: the folders
    of the buckets the batch falls in (at most ``buckets`` numbers come to the
    driver), whatever the size of the log."""
    touched = [r.b for r in batch.select(key_bucket(batch, keys, buckets).alias("b")).distinct().collect()]
    return log.filter(F.col("bucket").isin(touched))


def replay_safe_log_writer(log_path: str, order_by: str, key_cols: tuple[str, ...] = ("project_id",),
                           run_id: str | None = None, buckets: int = KEY_BUCKETS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that appends only stories not yet in the
    log; the batch is written to ``run=<run>/batch_id=<id>/bucket=<b>`` with
    overwrite, so a retried batch replaces its own rows and never duplicates
    them.  Known keys are looked up in the batch's own buckets only."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_of(batch, run_id)
        fresh = D.dedupe(batch, order_by=order_by, keys=key_cols)
        if _exists(spark, log_path):
            # all other batches: a replay of this batch must not see itself
            seen = seen_in_buckets(spark.read.parquet(log_path), batch, key_cols, buckets)
            others = (F.col("run") != run) | (F.col("batch_id") != batch_id)
            fresh = D.dedupe_against_log(fresh, seen.filter(others).drop("run", "batch_id", "bucket"))
        bucketed = fresh.withColumn("bucket", key_bucket(fresh, key_cols, buckets))
        bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(_batch_path(log_path, run, batch_id))
    return write


def foreach_batch_writer(transform: Callable[[DataFrame], DataFrame], out_path: str,
                         run_id: str | None = None) -> Callable[[DataFrame, int], None]:
    """Apply a batch transformation (e.g. scoring against static model
    weights) to each micro-batch and write it under its batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(_batch_path(out_path, run_of(batch, run_id), batch_id))
    return write


def split_late_writer(windows: DataFrame, out_path: str, indexed_col: str = "indexed_date",
                      published_col: str = "publish_date", run_id: str | None = None
                      ) -> Callable[[DataFrame, int], None]:
    """Each micro-batch is split by the query windows into ``kept`` and
    ``late`` outputs (both written, per batch id, so replays replace)."""
    from vigil.operators.windows import in_window, late_rows

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch, run_id)
        in_window(batch, windows, indexed_col, published_col).write.mode("overwrite") \
            .parquet(_batch_path(f"{out_path}/kept", run, batch_id))
        late_rows(batch, windows, indexed_col, published_col).write.mode("overwrite") \
            .parquet(_batch_path(f"{out_path}/late", run, batch_id))
    return write


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a log yet; one that cannot be read stays an error."""
    fs, p = file_system(spark, path)
    return fs.exists(p)


def run_available(stream_writer, checkpoint: str):
    """Run a stream over everything available now, then stop (batch-like
    scheduling with streaming state and exactly-once checkpoints)."""
    q = stream_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def path_join(*parts: str) -> str:
    return os.path.join(*parts)
