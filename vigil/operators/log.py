"""The story log: insert, lifecycle state, retention.

Plain Parquet has no UPDATE, so the log is append-only: inserts plus
lifecycle events (scored, above threshold, posted).  The current state of a
story is the fold of its events (``max_by`` per key) -- one aggregation with
map-side partial combine.  Snapshots keep the state up to a time, so that a
fold starts from the last one instead of the whole history.  Writes go to new
directories, never over the one being read; retention deletes whole day
folders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.dates import day, day_text, days_before, lenient_timestamp, ts_lit
from vigil.operators.common import unbounded
from vigil.sources.versions import file_system, read_versioned, versioned_table_writer


def story_key(project_id: Column | str, url_key: Column | str) -> Column:
    """I16: stable story id, ``sha2(project_id | key)`` -- the same on every
    retry, so re-running a batch cannot create a second row."""
    p = F.col(project_id) if isinstance(project_id, str) else project_id
    u = F.col(url_key) if isinstance(url_key, str) else url_key
    return F.sha2(F.concat_ws("|", p.cast("string"), u), 256)


def retain(log: DataFrame, age_days: int, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Split the log into (kept, deleted) at ``as_of - age_days``.

    A row with NULL ``queued_date`` is kept (``NULL < x`` deletes nothing).
    Write ``kept`` to a new location; on a log partitioned by ``queued_day``
    the same predicate prunes whole partitions instead.
    """
    cutoff = days_before(as_of, age_days)
    deleted_pred = F.coalesce(F.col("queued_date") < cutoff, F.lit(False))
    kept, deleted = log.filter(~deleted_pred), log.filter(deleted_pred)
    if "queued_day" in log.columns:
        # implied bounds on the partition column, so whole day directories
        # are skipped instead of read and filtered
        day_cut = F.to_date(cutoff)
        kept = kept.filter(F.col("queued_day").isNull() | (F.col("queued_day") >= day_cut))
        deleted = deleted.filter(F.col("queued_day") <= day_cut)
    return kept, deleted


def deleted_by_day(deleted: DataFrame) -> DataFrame:
    return (deleted.groupBy(day("queued_date").alias("day")).agg(F.count(F.lit(1)).alias("deleted"))
            .withColumn("day", day_text("day")))


def log_rows(stories: DataFrame, queued_at: dt.datetime | Column, source: str | Column | None = None) -> DataFrame:
    """A10: turn accepted stories (already de-duplicated, with ``project_id``,
    ``model_id``, ``url``, ``normalized_url``, ``publish_date``) into log rows.
    A missing or unreadable publication date becomes the queueing time."""
    q = queued_at if isinstance(queued_at, Column) else F.lit(queued_at).cast("timestamp")
    src = F.col("source") if source is None else (source if isinstance(source, Column) else F.lit(source))
    key = F.coalesce(F.col("normalized_url"), F.col("url"))
    return stories.select(
        story_key("project_id", key).alias("id"),
        F.col("project_id").cast("long"),
        F.col("model_id").cast("long"),
        F.lit(None).cast("double").alias("model_score"),
        F.lit(None).cast("double").alias("model_1_score"),
        F.lit(None).cast("double").alias("model_2_score"),
        lenient_timestamp(F.col("publish_date").cast("string"), q).alias("published_date"),
        q.alias("queued_date"),
        F.lit(None).cast("timestamp").alias("processed_date"),
        F.lit(None).cast("timestamp").alias("posted_date"),
        F.lit(False).alias("above_threshold"),
        src.alias("source"),
        F.col("url"),
        F.col("normalized_url"),
    )


def append_log(rows: DataFrame, path: str) -> None:
    """A10 sink: append, partitioned by queued day so retention and day
    reports prune whole directories."""
    (rows.withColumn("queued_day", day("queued_date"))
     .write.mode("append").partitionBy("queued_day").parquet(path))


def log_state(inserts: DataFrame, events: DataFrame) -> DataFrame:
    """Current state of each story = insert row updated by its lifecycle
    events.

    ``events`` has ``id`` and any of ``model_score, model_1_score,
    model_2_score, processed_date, above_threshold, posted_date`` plus
    ``event_time``; for each field the latest non-NULL event value wins.
    One ``groupBy(id)`` (partial aggregation first), then a left join back to
    the inserts on the id.
    """
    fields = [c for c in ("model_score", "model_1_score", "model_2_score", "processed_date",
                          "above_threshold", "posted_date") if c in events.columns]
    folded = events.groupBy("id").agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("event_time"))).alias(f"__{c}")
        for c in fields])
    out = inserts.join(folded, "id", "left")
    for c in fields:
        out = out.withColumn(c, F.coalesce(F.col(f"__{c}"), F.col(c))).drop(f"__{c}")
    return out.select(*inserts.columns)


# ---------------------------------------------------------------------------
# Snapshots: the log's state up to a time, folded onwards
# ---------------------------------------------------------------------------
LIFECYCLE = ("model_score", "model_1_score", "model_2_score", "processed_date", "above_threshold", "posted_date")


def fold_state(snapshot: DataFrame | None, inserts: DataFrame, events: DataFrame) -> DataFrame:
    """The next snapshot: ``snapshot`` (None: none yet) with the inserts and
    events that came since.

    A snapshot has the columns of the log and, for every lifecycle field, the
    time of the event that set it (``<field>_at``), so that an event that comes
    late, after a snapshot past its time, still loses to a later one: folding
    in any number of steps gives what ``log_state`` gives in one.  Work follows
    the snapshot and the new events, not the history of events.  An event of a
    story that no insert has named yet is lost; a story inserted again keeps
    its first row.
    """
    fields = [c for c in LIFECYCLE if c in inserts.columns]
    at = lambda c: f"{c}_at"
    fresh = inserts.dropDuplicates(["id"]).select("*", *[F.lit(None).cast("timestamp").alias(at(c)) for c in fields])
    if snapshot is not None:
        fresh = snapshot.unionByName(fresh.join(unbounded(snapshot.select("id")), "id", "left_anti").select(*snapshot.columns))
    given = [c for c in fields if c in events.columns]
    when = {c: F.when(F.col(c).isNotNull(), F.col("event_time")) for c in given}
    latest = events.groupBy("id").agg(*[x for c in given for x in (F.max_by(F.col(c), when[c]).alias(f"__{c}"), F.max(when[c]).alias(f"__{at(c)}"))])
    out = fresh.join(unbounded(latest), "id", "left")
    for c in given:
        newer = F.col(f"__{at(c)}").isNotNull() & (F.col(at(c)).isNull() | (F.col(f"__{at(c)}") >= F.col(at(c))))
        out = (out.withColumn(c, F.when(newer, F.col(f"__{c}")).otherwise(F.col(c)))
               .withColumn(at(c), F.when(newer, F.col(f"__{at(c)}")).otherwise(F.col(at(c)))))
    return out.select(*fresh.columns)


def state_of(snapshot: DataFrame) -> DataFrame:
    """The log's rows of a snapshot, without the times of their fields."""
    return snapshot.drop(*[f"{c}_at" for c in LIFECYCLE])


def compact(spark: SparkSession, path: str, inserts: DataFrame, events: DataFrame, upto: dt.datetime, since: dt.datetime | None = None) -> DataFrame:
    """Write the snapshot of everything before ``upto`` as the next version of
    the table at ``path`` and return it.  ``since``: the last snapshot's time;
    only inserts queued and events that happened from then on are read (their
    day folders, on a log partitioned by ``queued_day`` and ``event_day``)."""
    def between(df: DataFrame, col: str, day_col: str) -> DataFrame:
        cond = F.col(col) < ts_lit(upto)
        if since is not None:
            cond = cond & (F.col(col) >= ts_lit(since))
        if day_col in df.columns:
            cond = cond & (F.col(day_col) <= F.to_date(ts_lit(upto)))
            if since is not None:
                cond = cond & (F.col(day_col) >= F.to_date(ts_lit(since)))
        return df.filter(cond).drop(day_col)

    before = read_versioned(spark, path) if since is not None else None
    name = f"{upto:%Y%m%dT%H%M%S%f}"
    versioned_table_writer(path, run_id=name)(
        fold_state(before, between(inserts, "queued_date", "queued_day"), between(events, "event_time", "event_day")), 0)
    return read_versioned(spark, path)


# ---------------------------------------------------------------------------
# Retention that deletes
# ---------------------------------------------------------------------------
def day_folders(spark: SparkSession, path: str) -> dict[dt.date, str]:
    """The day folders of a log written by ``append_log``: one entry per day."""
    fs, root = file_system(spark, path)
    out = {}
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("queued_day=") and not name.endswith("__HIVE_DEFAULT_PARTITION__"):
            out[dt.date.fromisoformat(name.split("=", 1)[1])] = st.getPath().toString()
    return out


def delete_old_days(spark: SparkSession, path: str, age_days: int, as_of: dt.datetime) -> DataFrame:
    """Delete the day folders of the log that lie wholly before ``as_of -
    age_days`` and return ``(day, deleted)``, counted before.

    No row is rewritten: the day of the cutoff itself goes once it is past
    (``retain`` hides its older rows until then), rows without a queueing date
    stay.  A delete that is cut off leaves whole folders; the next call goes on.
    """
    cut = (as_of - dt.timedelta(days=age_days)).date()
    old = {d: p for d, p in day_folders(spark, path).items() if d < cut}
    log = spark.read.parquet(path)
    # a count per folder, from the files' footers; at most a row per day
    counts = log.filter(F.col("queued_day") < F.lit(cut)).groupBy("queued_day").agg(F.count(F.lit(1)).alias("deleted")).collect()
    for d in sorted(old):
        fs, p = file_system(spark, old[d])
        fs.delete(p, True)
    return spark.createDataFrame([(f"{r.queued_day:%Y-%m-%d}", r.deleted) for r in counts], "day string, deleted long")
