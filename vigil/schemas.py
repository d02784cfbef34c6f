"""Canonical schemas and fixed values.

Every input is read with an explicit schema; a missing optional field is a
NULL column, never a missing key.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the monitored system's values for equal results)
# ---------------------------------------------------------------------------
# Platform names, as stored in the log's `source` column.
PLATFORMS = ["google-alerts", "media-cloud", "newscatcher", "wayback-machine"]
SOURCE_GOOGLE_ALERTS, SOURCE_MEDIA_CLOUD, SOURCE_NEWSCATCHER, SOURCE_WAYBACK_MACHINE = PLATFORMS

# Entity types kept when entities are attached to a story.
ACCEPTED_ENTITY_TYPES = ["PERSON", "PER", "GPE", "LOC", "FAC", "DATE", "TIME",
                         "C_DATE", "C_AGE", "PS", "DT", "TI", "LC"]

# Per-platform query windows in days: (offset, window).
PLATFORM_WINDOWS = {SOURCE_MEDIA_CLOUD: (1, 4), SOURCE_NEWSCATCHER: (0, 4),
                    SOURCE_WAYBACK_MACHINE: (4, 4)}
# Per-project story caps for one run.
PLATFORM_CAPS = {SOURCE_MEDIA_CLOUD: 5000, SOURCE_NEWSCATCHER: 3000,
                 SOURCE_WAYBACK_MACHINE: 3000}
STORY_COUNT_WINDOW_SIZE = 4          # days averaged by the low-volume alert
STORY_COUNT_THRESHOLD = 40000        # stories per day; alert when strictly below
RESULTS_PER_BATCH = 100              # stories per posted batch
RECENT_PROCESSED_DAYS = 14           # skip URLs processed this recently
RETENTION_DAYS_DEFAULT = 62
RETENTION_DAYS_SCHEDULED = 30
BROAD_QUERY_FRACTION = 0.8           # "query might be too broad" above this share of the cap
OUTPUT_VERSION = "4.6.6"
# ---------------------------------------------------------------------------

TAG = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("tag", T.StringType()),
    T.StructField("tag_set", T.StringType()),
    T.StructField("tag_sets_id", T.LongType()),
    T.StructField("tags_id", T.LongType()),
])

PROJECT = T.StructType([
    T.StructField("project_id", T.LongType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("search_terms", T.StringType()),
    T.StructField("media_collections", T.ArrayType(T.LongType())),
    T.StructField("newscatcher_country", T.StringType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("min_confidence", T.DoubleType()),
    T.StructField("language_model_id", T.LongType()),
])

MODEL = T.StructType([
    T.StructField("model_id", T.LongType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("filename_prefix", T.StringType()),
    T.StructField("model_type_1", T.StringType()),
    T.StructField("vectorizer_type_1", T.StringType()),
    T.StructField("chained_models", T.BooleanType()),
    T.StructField("model_type_2", T.StringType()),
    T.StructField("vectorizer_type_2", T.StringType()),
])

STORY = T.StructType([
    T.StructField("project_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("normalized_url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("story_text", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("publish_date", T.TimestampType()),
    T.StructField("source_publish_date", T.StringType()),
    T.StructField("indexed_date", T.TimestampType()),
    T.StructField("media_id", T.LongType()),
    T.StructField("media_url", T.StringType()),
    T.StructField("media_name", T.StringType()),
    T.StructField("authors", T.ArrayType(T.StringType())),
    T.StructField("story_tags", T.ArrayType(TAG)),
    T.StructField("extracted_content_url", T.StringType()),
    T.StructField("archived_url", T.StringType()),
])

STORY_LOG = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("project_id", T.LongType()),
    T.StructField("model_id", T.LongType()),
    T.StructField("model_score", T.DoubleType()),
    T.StructField("model_1_score", T.DoubleType()),
    T.StructField("model_2_score", T.DoubleType()),
    T.StructField("published_date", T.TimestampType()),
    T.StructField("queued_date", T.TimestampType()),
    T.StructField("processed_date", T.TimestampType()),
    T.StructField("posted_date", T.TimestampType()),
    T.StructField("above_threshold", T.BooleanType()),
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("normalized_url", T.StringType()),
])

HISTORY = T.StructType([
    T.StructField("project_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("latest_date", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

MODEL_TERMS = T.StructType([
    T.StructField("model_id", T.LongType()),
    T.StructField("stage", T.IntegerType()),
    T.StructField("term", T.StringType()),
    T.StructField("idf", T.DoubleType()),
    T.StructField("weight", T.DoubleType()),
])

PROJECT_TERMS = T.StructType([
    T.StructField("project_id", T.LongType()),
    T.StructField("clause_id", T.IntegerType()),
    T.StructField("negated", T.BooleanType()),
    T.StructField("kind", T.StringType()),
    T.StructField("term", T.StringType()),
])

PAGE = T.StructType([
    T.StructField("content", T.StringType()),
    T.StructField("final_url", T.StringType()),
    T.StructField("original_url", T.StringType()),
])

ENTITY = T.StructType([T.StructField("text", T.StringType()), T.StructField("type", T.StringType())])
