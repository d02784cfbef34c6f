"""What a run leaves in the log: its inserts and lifecycle events, committed
as one (A10, D7, E2).

A run writes its log rows and the events of its stories (scored, above the
threshold, posted) into a folder of its own and, as the last step, one commit
marker.  Readers take committed runs only: a run that is killed half-way
leaves nothing half-visible, and running it again under the same id replaces
what it had written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import schemas
from vigil.functions.dates import ts_lit
from vigil.operators.common import bounded_broadcast, store
from vigil.operators.log import log_rows, log_state
from vigil.plans.pipeline import RunResult
from vigil.sources.versions import file_system

EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("model_score", T.DoubleType()),
    T.StructField("model_1_score", T.DoubleType()),
    T.StructField("model_2_score", T.DoubleType()),
    T.StructField("processed_date", T.TimestampType()),
    T.StructField("above_threshold", T.BooleanType()),
    T.StructField("posted_date", T.TimestampType()),
])


def _events(rows: DataFrame, at: Column, **fields: Column) -> DataFrame:
    given = {"id": F.col("log_db_id"), "event_time": at, **fields}
    return rows.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT.fields])


def run_events(scored: DataFrame, above: DataFrame, processed_at: dt.datetime, posted_at: dt.datetime | None = None) -> DataFrame:
    """The events of a run: a story with a score was processed; one at or above
    its project's threshold is marked, and posted if the run posts.  A story
    without a score (no text, no vector) has no event yet."""
    done, posted = ts_lit(processed_at), ts_lit(posted_at) if posted_at else None
    has_score = scored.filter(F.col("model_score").isNotNull())
    out = _events(has_score, done, processed_date=done, **{c: F.col(c) for c in ("model_score", "model_1_score", "model_2_score")})
    out = out.unionByName(_events(above, done, above_threshold=F.lit(True)))
    return out if posted is None else out.unionByName(_events(above, posted, posted_date=posted))


def _marker(path: str, run_id: str) -> str:
    return f"{path}/_committed/{run_id}"


def commit_run(spark: SparkSession, result: RunResult, path: str, run_id: str, queued_at: dt.datetime, processed_at: dt.datetime,
               posted_at: dt.datetime | None = None) -> None:
    """Write a run's inserts and events below ``path`` and commit them.  A run
    that is committed already is left as it is."""
    fs, marker = file_system(spark, _marker(path, run_id))
    if fs.exists(marker):
        return
    models = result.projects.select("project_id", F.col("language_model_id").alias("model_id"))
    inserts = log_rows(result.stored.join(bounded_broadcast(models), "project_id"), ts_lit(queued_at), result.source)
    inserts.write.mode("overwrite").parquet(f"{path}/run={run_id}/inserts")
    # both kinds of event read the scores: they are computed once
    result.scored = store(result.scored, "scored")
    run_events(result.scored, result.above, processed_at, posted_at).write.mode("overwrite").parquet(f"{path}/run={run_id}/events")
    fs.create(marker, True).close()


def committed_runs(spark: SparkSession, path: str) -> list[str]:
    fs, folder = file_system(spark, f"{path}/_committed")
    return sorted(st.getPath().getName() for st in fs.listStatus(folder)) if fs.exists(folder) else []


def read_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(inserts, events) of all committed runs."""
    runs = committed_runs(spark, path)

    def read(kind: str, schema: T.StructType) -> DataFrame:
        if not runs:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{path}/run={r}/{kind}" for r in runs])
    return read("inserts", schemas.STORY_LOG), read("events", EVENT)


def run_state(spark: SparkSession, path: str) -> DataFrame:
    """The log's current state after its committed runs; a story that several
    runs inserted keeps its first queueing."""
    inserts, events = read_log(spark, path)
    columns = inserts.columns
    first = inserts.groupBy("id").agg(F.min_by(F.struct(*columns), "queued_date").alias("r")).select("r.*")
    return log_state(first, events).select(*columns)
