"""De-duplication, caps and batch numbering.

"First wins" needs an explicit order column: Spark rows have no order, so
callers name one (``feed_pos``, an ingest time, ...).  De-duplication is an
aggregation (``min_by``), not a window: it combines map-side, so a URL
repeated a million times is reduced in every task before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.dates import days_before
from vigil.functions.urls import normalize_url
from vigil.operators.common import number_rows, top_k, unbounded


def dedupe_key(df: DataFrame) -> Column:
    """``coalesce(normalized_url, url)``: both uniqueness rules in one key."""
    if "normalized_url" in df.columns:
        return F.coalesce(F.col("normalized_url"), F.col("url"))
    return F.coalesce(normalize_url("url"), F.col("url"))


def dedupe(df: DataFrame, order_by: str, keys: Sequence[str] = ("project_id",)) -> DataFrame:
    """per ``(keys, dedupe key)`` keep the first row in ``order_by`` order.

    The same URL in two projects is kept twice.  ``order_by`` must be unique
    within a key for the choice to be deterministic.
    """
    cols = df.columns
    keyed = df.withColumn("__k", dedupe_key(df))
    first = keyed.groupBy(*keys, "__k").agg(
        F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order_by)).alias("__row"))
    return first.select("__row.*")


def ignored_counts(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("project_id",)) -> DataFrame:
    """Rows dropped as duplicates per project (input - kept)."""
    b = before.groupBy(*keys).agg(F.count(F.lit(1)).alias("found"))
    a = after.groupBy(*keys).agg(F.count(F.lit(1)).alias("kept"))
    return (b.join(a, list(keys), "left")
            .select(*keys, "found", F.coalesce("kept", F.lit(0)).alias("kept"))
            .withColumn("ignored", F.col("found") - F.col("kept")))


def dedupe_against_log(df: DataFrame, log: DataFrame) -> DataFrame:
    """drop stories already in the log for the same project (any age)."""
    seen = log.select("project_id", dedupe_key(log).alias("__k"))
    return (df.withColumn("__k", dedupe_key(df))
            .join(unbounded(seen), ["project_id", "__k"], "left_anti").drop("__k"))


def _recent(log: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    since = days_before(as_of, days)
    cond = (F.col("queued_date") > since) & F.col("processed_date").isNotNull()
    if "queued_day" in log.columns:
        # implied bound on the partition column: older day folders are not read
        cond = cond & (F.col("queued_day") >= F.to_date(since))
    return log.filter(cond).select("project_id", dedupe_key(log).alias("__k"))


def drop_recently_processed(df: DataFrame, log: DataFrame, as_of: dt.datetime,
                            days: int = 14) -> DataFrame:
    """Skip URLs this project processed in the last ``days`` days."""
    return (df.withColumn("__k", dedupe_key(df))
            .join(unbounded(_recent(log, as_of, days)), ["project_id", "__k"], "left_anti").drop("__k"))


def skipped_counts(df: DataFrame, log: DataFrame, as_of: dt.datetime, days: int = 14) -> DataFrame:
    """Per project, how many rows D1 skipped (input rows, repeats included)."""
    hit = (df.withColumn("__k", dedupe_key(df))
           .join(unbounded(_recent(log, as_of, days)), ["project_id", "__k"], "left_semi"))
    return hit.groupBy("project_id").agg(F.count(F.lit(1)).alias("skipped_dupes"))


def cap_per_project(df: DataFrame, cap: int, order_by: Sequence[Column],
                    keys: Sequence[str] = ("project_id",)) -> DataFrame:
    """at most ``cap`` stories per project, newest first (callers pass
    e.g. ``[desc('indexed_date'), col('url')]``; the URL breaks ties).  The cap
    is exact and applied map-side first (partial window-group limit)."""
    return top_k(df, list(keys), list(order_by), cap)


def cut_by_cap(df: DataFrame, cap: int, order_by: Sequence[Column],
               keys: Sequence[str] = ("project_id",)) -> DataFrame:
    """The rows that ``cap_per_project`` with the same arguments leaves out."""
    kept = cap_per_project(df, cap, order_by, keys).select(
        *[F.col(k).alias(f"__{k}") for k in keys], dedupe_key(df).alias("__k"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], F.col("__dk").eqNullSafe(F.col("__k")))
    return df.withColumn("__dk", dedupe_key(df)).join(unbounded(kept), same, "left_anti").drop("__dk")


def batch_numbers(df: DataFrame, order_by: Sequence[str], size: int = 100,
                  keys: Sequence[str] = ("project_id",), out_col: str = "batch_no") -> DataFrame:
    """F8: ``floor((row_number - 1) / size)`` per project, computed with the
    skew-safe numbering (a hot project is spread over many tasks)."""
    numbered = number_rows(df, list(keys), list(order_by), out_col="__rn")
    return (numbered.withColumn(out_col, F.floor((F.col("__rn") - 1) / F.lit(size)).cast("long"))
            .withColumnRenamed("__rn", "batch_pos"))
