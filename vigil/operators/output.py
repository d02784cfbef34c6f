"""Output: entities, posting projection, result batches, run summary
(I10, D9, B9, A11, A12, E11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions.text import keep_entities
from vigil.operators.common import bounded_broadcast
from vigil.operators.dedupe import batch_numbers

POSTING_FIELDS = ["source", "language", "media_id", "media_url", "media_name", "publish_date", "story_tags",
                  "title", "url", "entities", "confidence", "log_db_id", "project_id", "language_model_id"]
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def attach_entities(stories: DataFrame, entities: DataFrame, url_col: str = "url") -> DataFrame:
    """Entities of each story (``entities``: url, ``array<struct<text,type>>``),
    filtered to the accepted types and lower-cased; NULL when extraction
    failed or returned nothing for the story (left join)."""
    e = entities.select(F.col(url_col).alias("__u"), keep_entities("entities").alias("entities"))
    s = stories.drop("entities") if "entities" in stories.columns else stories
    return s.join(e, s[url_col] == e["__u"], "left").drop("__u")


def prep_for_posting(stories: DataFrame, projects: DataFrame) -> DataFrame:
    """The fields sent for each story; optional ones are NULL when absent."""
    p = projects.select("project_id", "language_model_id")
    s = stories.drop("language_model_id") if "language_model_id" in stories.columns else stories
    j = s.join(bounded_broadcast(p), "project_id")
    cols = []
    for f in POSTING_FIELDS:
        if f in j.columns:
            cols.append(F.col(f))
        elif f == "story_tags":
            cols.append(F.lit(None).cast(schemas.STORY["story_tags"].dataType).alias(f))
        elif f == "entities":
            cols.append(F.lit(None).cast("array<string>").alias(f))
        else:
            cols.append(F.lit(None).cast("string" if f != "media_id" else "long").alias(f))
    return j.select(*cols)


def result_batches(prepped: DataFrame, projects: DataFrame, size: int = schemas.RESULTS_PER_BATCH,
                   order_by: str = "log_db_id") -> DataFrame:
    """One row per (project, batch) with the JSON payload
    ``{version, project, stories[]}``; at most ``size`` stories per batch and
    no batch for a project without stories.

    Batch numbers come from the skew-safe numbering, so a project with a
    third of all stories is numbered by many tasks; each collected group is
    bounded by ``size``.  Dates serialise as ``yyyy-MM-dd HH:mm:ss`` text.
    """
    numbered = batch_numbers(prepped, [order_by], size=size)
    story = F.struct(*[F.col(c) for c in POSTING_FIELDS])
    groups = (numbered.groupBy("project_id", "batch_no")
              .agg(F.array_sort(F.collect_list(F.struct(F.col("batch_pos"), story.alias("s")))).alias("__b")))
    proj = projects.select("project_id", F.struct(*[F.col(c) for c in projects.columns]).alias("project"))
    payload = F.to_json(F.struct(F.lit(schemas.OUTPUT_VERSION).alias("version"), F.col("project"),
                                 F.transform("__b", lambda x: x["s"]).alias("stories")),
                        {"timestampFormat": TIMESTAMP_FORMAT})
    return (groups.join(bounded_broadcast(proj), "project_id")
            .select("project_id", "batch_no", F.size("__b").cast("long").alias("n_stories"),
                    payload.alias("payload")))


def write_batches(batches: DataFrame, path: str) -> None:
    """A11 sink: payloads as JSON-lines text files, one directory per run
    (never over a directory being read)."""
    batches.select("payload").write.mode("errorifexists").text(path)


def run_summary(found: DataFrame, kept: DataFrame, projects: DataFrame, cap: int) -> DataFrame:
    """Per project ``found`` (before de-duplication), ``kept``,
    distinct URLs, the summary line and the "too broad" flag; plus a grand
    total row (``project_id`` NULL) from a rollup."""
    f = found.groupBy("project_id").agg(F.count(F.lit(1)).alias("found"))
    k = kept.groupBy("project_id").agg(F.count(F.lit(1)).alias("kept"),
                                       F.count_distinct("url").alias("unique_urls"))
    per = (projects.select("project_id", "title").join(f, "project_id", "left").join(k, "project_id", "left")
           .select("project_id", "title", F.coalesce("found", F.lit(0)).alias("found"),
                   F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("unique_urls", F.lit(0)).alias("unique_urls")))
    total = (per.rollup("project_id")
             .agg(F.max("title").alias("title"), F.sum("found").alias("found"), F.sum("kept").alias("kept"),
                  F.sum("unique_urls").alias("unique_urls"), F.grouping("project_id").alias("__g"))
             .withColumn("title", F.when(F.col("__g") == 0, F.col("title"))))
    broad = F.col("kept") > F.lit(cap * schemas.BROAD_QUERY_FRACTION)
    text = F.when(F.col("__g") == 1, F.format_string("Done - pulled %d stories.", F.col("kept"))) \
        .otherwise(F.format_string("Project %d - %s: %d stories", F.col("project_id"), F.col("title"), F.col("kept")))
    return total.select("project_id", "title", F.col("found").cast("long"), F.col("kept").cast("long"),
                        F.col("unique_urls").cast("long"),
                        F.when(F.col("__g") == 0, broad).alias("too_broad"),
                        text.alias("line"))
