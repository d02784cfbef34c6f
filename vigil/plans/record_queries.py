"""Registered queries: configuration records, small row rules, payloads.

Project and model lists of any length are derived from ``customer`` and
``part`` (a project or model per row), written as the JSON lists the readers
take, and read back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions import dates as DT
from vigil.functions import text as TX
from vigil.functions import urls as U
from vigil.operators import classify as C
from vigil.operators import output as O
from vigil.operators import search as S
from vigil.plans import pipeline
from vigil.plans import class_queries as CQ
from vigil.plans import pipeline_queries as PQ
from vigil.plans.registry import query
from vigil.plans.search_queries import DOCS_CTE, _clause_sql, _docs
from vigil.sources import feeds as FD
from vigil.sources import fixtures
from vigil.sources.tables import table
from vigil.streaming import ingest as J

AS_OF = fixtures.AS_OF

# ---------------------------------------------------------------------------
# Projects and models as JSON lists
# ---------------------------------------------------------------------------
COUNTRIES = ["US", "GB", "usa", None, "FR", "MX"]
PROJECTS_CTE = """
WITH projects AS (SELECT c_custkey AS project_id, c_name AS title, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'en' END AS language,
    '"' || c_name || '" OR ' || c_mktsegment AS search_terms, [c_nationkey, c_custkey % 5] AS media_collections,
    ['US', 'GB', 'usa', NULL, 'FR', 'MX'][c_custkey % 6 + 1] AS newscatcher_country, c_custkey % 100 / 100.0 AS min_confidence,
    c_custkey % 3 + 1 AS language_model_id FROM customer)
"""


def _projects(spark, sf_dir):
    """A project per customer, through the JSON reader; half of the records
    are keyed by ``id``, half by ``project_id``, and the search terms come with
    curly quotes and no-break spaces."""
    path = J.run_dir(spark, "projects")
    c, by_id = table(spark, sf_dir, "customer"), F.col("c_custkey") % 2 == 0
    c.select(
        F.when(by_id, F.col("c_custkey")).alias("id"), F.when(~by_id, F.col("c_custkey")).alias("project_id"), F.col("c_name").alias("title"),
        F.when(F.col("c_custkey") % 3 != 0, F.lit("en")).alias("language"),
        F.concat(F.lit("“"), "c_name", F.lit("” OR "), "c_mktsegment").alias("search_terms"),
        F.array(F.col("c_nationkey").cast("long"), F.col("c_custkey") % 5).alias("media_collections"),
        F.element_at(F.array(*[F.lit(x) for x in COUNTRIES]), (F.col("c_custkey") % 6 + 1).cast("int")).alias("newscatcher_country"),
        (F.col("c_custkey") % 100 / 100).alias("min_confidence"), (F.col("c_custkey") % 3 + 1).alias("language_model_id"),
    ).write.json(path)
    # written as JSON lines: the list is split over files and tasks
    return FD.read_projects(spark, path, multi_line=False)


PROJECT_FIELDS = ["project_id", "title", "language", "search_terms", "media_collections", "newscatcher_country", "min_confidence", "language_model_id"]


@query("config_projects", sql=PROJECTS_CTE + "SELECT * FROM projects")
def q_config_projects(spark, sf_dir):
    """A1, C18, I5."""
    return _projects(spark, sf_dir).select(*PROJECT_FIELDS)


@query("projects_with_country", sql=PROJECTS_CTE + "SELECT project_id, newscatcher_country FROM projects WHERE length(newscatcher_country) = 2")
def q_projects_with_country(spark, sf_dir):
    """B1."""
    return FD.with_countries(_projects(spark, sf_dir)).select("project_id", "newscatcher_country")


@query("remapped_collections", sql=PROJECTS_CTE + """
SELECT project_id, list_transform(media_collections, lambda c: CASE c WHEN 1 THEN 101 WHEN 3 THEN 303 ELSE c END) AS media_collections FROM projects""")
def q_remapped_collections(spark, sf_dir):
    """B5."""
    return FD.remap_collections(_projects(spark, sf_dir), {1: 101, 3: 303}).select("project_id", "media_collections")


@query("stories_in_country", sql=PROJECTS_CTE + """
, s AS (SELECT event_id AS story_id, user_id AS project_id, ['us', 'GB', 'FR', NULL][event_id % 4 + 1] AS country FROM events)
SELECT s.story_id, s.project_id, s.country FROM s JOIN projects p USING (project_id) WHERE upper(s.country) = upper(p.newscatcher_country)""")
def q_stories_in_country(spark, sf_dir):
    """B6."""
    country = F.element_at(F.array(F.lit("us"), F.lit("GB"), F.lit("FR"), F.lit(None)), (F.col("event_id") % 4 + 1).cast("int"))
    s = table(spark, sf_dir, "events").select(F.col("event_id").alias("story_id"), F.col("user_id").alias("project_id"), country.alias("country"))
    return FD.filter_country(s, _projects(spark, sf_dir)).select("story_id", "project_id", "country")


MODELS_CTE = """
WITH models AS (SELECT p_partkey AS model_id, p_name AS name, ['nb', 'lr', 'svm'][p_partkey % 3 + 1] AS model_type_1,
    ['tfidf', 'embeddings', NULL, 'bow'][p_partkey % 4 + 1] AS vectorizer_type_1, p_partkey % 2 = 0 AS chained_models,
    ['nb', NULL, 'lr'][p_partkey % 3 + 1] AS model_type_2, ['embeddings', 'tfidf', 'x', NULL, 'tfidf'][p_partkey % 5 + 1] AS vectorizer_type_2 FROM part)
"""


def _pick(values, key, n):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % n + 1).cast("int"))


def _models(spark, sf_dir):
    path = J.run_dir(spark, "models")
    table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), _pick(["nb", "lr", "svm"], "p_partkey", 3).alias("model_type_1"),
        _pick(["tfidf", "embeddings", None, "bow"], "p_partkey", 4).alias("vectorizer_type_1"), (F.col("p_partkey") % 2 == 0).alias("chained_models"),
        _pick(["nb", None, "lr"], "p_partkey", 3).alias("model_type_2"),
        _pick(["embeddings", "tfidf", "x", None, "tfidf"], "p_partkey", 5).alias("vectorizer_type_2")).write.json(path)
    return FD.read_models(spark, path, multi_line=False)


@query("config_models", sql=MODELS_CTE + "SELECT * FROM models")
def q_config_models(spark, sf_dir):
    """A2."""
    return _models(spark, sf_dir).select("model_id", "name", "model_type_1", "vectorizer_type_1", "chained_models", "model_type_2", "vectorizer_type_2")


@query("invalid_models", sql=MODELS_CTE + """
, r AS (SELECT model_id, concat_ws('; ',
    CASE WHEN coalesce(model_type_1 NOT IN ('lr', 'nb'), true) THEN 'unknown model_type_1' END,
    CASE WHEN coalesce(vectorizer_type_1 NOT IN ('tfidf', 'embeddings'), true) THEN 'unknown vectorizer_type_1' END,
    CASE WHEN chained_models AND coalesce(model_type_2 NOT IN ('lr', 'nb'), true) THEN 'unknown model_type_2' END,
    CASE WHEN chained_models AND coalesce(vectorizer_type_2 NOT IN ('tfidf', 'embeddings'), true) THEN 'unknown vectorizer_type_2' END) AS reason FROM models)
SELECT model_id, reason FROM r WHERE reason <> ''""")
def q_invalid_models(spark, sf_dir):
    """H7."""
    return C.validate_models(_models(spark, sf_dir))


# ---------------------------------------------------------------------------
# Row rules
# ---------------------------------------------------------------------------
@query("stories_of_projects", sql="SELECT event_id AS story_id, user_id AS project_id FROM events WHERE user_id % 7 <> 0")
def q_stories_of_projects(spark, sf_dir):
    """Rows without a project do no work."""
    s = table(spark, sf_dir, "events").select(F.col("event_id").alias("story_id"), F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("project_id"))
    return FD.drop_empty(s)


@query("preferred_dates", sql="""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) ELSE ts - INTERVAL '1' DAY END AS publish_date FROM events""")
def q_preferred_dates(spark, sf_dir):
    """The platform's own date where it is one."""
    given = (F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(F.col("event_id") % 3 == 1, F.lit("not a date")))
    return table(spark, sf_dir, "events").select("event_id", DT.prefer_source_date(given, F.col("ts").cast("timestamp") - F.make_dt_interval(days=F.lit(1))).alias("publish_date"))


@query("combined_search", sql=DOCS_CTE + f"""
SELECT doc_id FROM d WHERE ({_clause_sql('term', 'thing')} OR {_clause_sql('title:prefix', 'er')}) AND NOT {_clause_sql('phrase', 'of the')}
AND lower(lang) = 'en' AND indexed_date > TIMESTAMP '2024-01-10 00:00:00' AND indexed_date <= TIMESTAMP '2024-01-28 00:00:00'""")
def q_combined_search(spark, sf_dir):
    """Terms, language and date range as one filter."""
    wanted = S.all_of(S.any_of(S.term("thing"), S.prefix("er", on="title_tokens")), S.none_of(S.phrase("of the")), S.language("en"),
                      S.date_range("indexed_date", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 28)))
    return S.search(_docs(spark, sf_dir), wanted).select("doc_id")


@query("entity_texts", sql="SELECT doc_id, md5(concat_ws(' ', split_part(text, chr(10), 1), text)) AS digest FROM documents")
def q_entity_texts(spark, sf_dir):
    """I11."""
    return _docs(spark, sf_dir).select("doc_id", F.md5(TX.entity_text("title", "story_text")).alias("digest"))


@query("page_dates", sql="""
WITH p AS (SELECT page_id, DATE '2023-01-01' + (page_id % 600)::INTEGER AS d FROM pages)
SELECT page_id, CASE page_id % 3 WHEN 2 THEN NULL ELSE d::TIMESTAMP END AS in_page, CASE WHEN page_id % 4 = 0 THEN NULL ELSE d::TIMESTAMP END AS in_url FROM p""")
def q_page_dates(spark, sf_dir):
    """The publication date in a page's head, or a time element, and in
    its address."""
    day = F.date_add(F.lit("2023-01-01").cast("date"), (F.col("page_id") % 600).cast("int"))
    p = table(spark, sf_dir, "pages").withColumn("d", day)
    iso = F.date_format("d", "yyyy-MM-dd")
    mark = (F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<meta property="article:published_time" content="'), iso, F.lit('">')))
            .when(F.col("page_id") % 3 == 1, F.concat(F.lit('<time datetime="'), iso, F.lit('">'))).otherwise(F.lit('<time datetime="soon">')))
    address = F.when(F.col("page_id") % 4 == 0, F.col("url")).otherwise(F.concat(F.lit("https://x.org/"), F.date_format("d", "yyyy/MM/dd"), F.lit("/story")))
    return p.select("page_id", TX.html_published_date(F.concat(mark, "html")).alias("in_page"), U.url_date(address).alias("in_url"))


# ---------------------------------------------------------------------------
# Result payloads
# ---------------------------------------------------------------------------
def _entities(spark, sf_dir):
    """Extracted entities of each story: its source as an organisation (not
    accepted) and its first two words as a person and a place; none for every
    fifth story."""
    s = fixtures.stories_from_documents(table(spark, sf_dir, "documents"))
    words = F.split("title", " ")
    found = F.array(F.struct(words[0].alias("text"), F.lit("PERSON").alias("type")), F.struct(F.col("media_name").alias("text"), F.lit("ORG").alias("type")),
                    F.struct(F.coalesce(F.try_element_at(words, F.lit(2)), F.lit("X")).alias("text"), F.lit("GPE").alias("type")))
    return s.filter((F.col("story_id") % 5 != 0) & F.col("title").isNotNull()).select("url", found.alias("entities"))


@query("result_payloads", sql=PQ._pipeline_sql() + f"""
, above AS (
  SELECT s.project_id, s.model_id, k.story_id, k.url, k.indexed_date, round(s.model_score, 6) AS confidence,
         sha256(concat_ws('|', CAST(s.project_id AS VARCHAR), coalesce(k.normalized_url, k.url))) AS log_db_id
  FROM scored s JOIN proj p USING (project_id) JOIN kept k ON k.story_id = s.story_id AND k.project_id = s.project_id
  WHERE s.model_score >= coalesce(p.min_confidence, 0))
SELECT '{schemas.OUTPUT_VERSION}' AS version, a.project_id, (row_number() OVER (PARTITION BY a.project_id ORDER BY log_db_id) - 1) // 100 AS batch_no,
       (row_number() OVER (PARTITION BY a.project_id ORDER BY log_db_id) - 1) % 100 AS pos, a.log_db_id, a.url, split_part(d.text, chr(10), 1) AS title,
       d.lang AS language, d.source AS media_name, 'media-cloud' AS source, a.model_id AS language_model_id,
       strftime(a.indexed_date - INTERVAL '1' DAY * (a.story_id % 3), '%Y-%m-%d %H:%M:%S') AS publish_date, a.confidence,
       CASE WHEN a.story_id % 5 <> 0 THEN lower(split_part(split_part(d.text, chr(10), 1), ' ', 1)) || '|'
            || lower(coalesce(string_split(split_part(d.text, chr(10), 1), ' ')[2], 'X')) END AS entities
FROM above a JOIN documents d ON d.doc_id = a.story_id""")
def q_result_payloads(spark, sf_dir):
    """Every field of every story of the written payloads."""
    stories = fixtures.stories_from_documents(table(spark, sf_dir, "documents")).withColumn(
        "publish_date", F.col("indexed_date") - F.make_dt_interval(days=(F.col("story_id") % 3).cast("int")))
    run = pipeline.run(stories, fixtures.projects(spark), fixtures.project_terms(spark), fixtures.models(spark), CQ.model_terms(spark, sf_dir),
                       AS_OF, entities=_entities(spark, sf_dir))
    path = J.run_dir(spark, "payloads")
    O.write_batches(run.batches, path)
    payload = ("version string, project struct<project_id:long>, stories array<struct<log_db_id:string, url:string, title:string, language:string, "
               "media_name:string, source:string, language_model_id:long, publish_date:string, confidence:double, entities:array<string>, project_id:long>>")
    rows = spark.read.text(path).select(F.from_json("value", payload).alias("p"))
    # a payload does not say its number: batches of a project follow its first story's key
    first = F.element_at("p.stories", 1)["log_db_id"]
    number = F.row_number().over(Window.partitionBy("p.project.project_id").orderBy(first)) - 1
    rows = rows.withColumn("batch_no", number.cast("long")).select(
        "p.version", F.col("p.project.project_id").alias("project_id"), "batch_no", F.posexplode("p.stories").alias("pos", "s"))
    return rows.select("version", "project_id", "batch_no", F.col("pos").cast("long").alias("pos"), "s.log_db_id", "s.url", "s.title", "s.language",
                       "s.media_name", "s.source", "s.language_model_id", "s.publish_date", F.round("s.confidence", 6).alias("confidence"),
                       F.array_join("s.entities", "|").alias("entities"))


# ---------------------------------------------------------------------------
# A daily run: with the project's marks and the log
# ---------------------------------------------------------------------------
def _daily_log(spark, sf_dir):
    """What earlier runs logged: every fourth story, for its project's neighbours too."""
    s = fixtures.stories_from_documents(table(spark, sf_dir, "documents")).filter("story_id % 4 = 0")
    return s.select(F.explode(F.array(*[F.lit(p).cast("long") for p in (0, 3, 6, 9)])).alias("project_id"), "url", U.normalize_url("url").alias("normalized_url"))


@query("run_daily", sql=PQ._pipeline_sql().replace("WITH ", PQ.LOG_CTE.strip() + PQ.HIST_SQL + ", ", 1).replace(
    "dedup AS (SELECT *", f"""w AS ({PQ._windows_sql(schemas.SOURCE_MEDIA_CLOUD, True)}),
judged AS (SELECT f.*, coalesce(f.indexed_date > start_date AND f.indexed_date <= {PQ._ts(AS_OF)}
     AND CAST(f.indexed_date - INTERVAL '1' DAY * (f.story_id % 3) AS DATE) BETWEEN CAST({PQ._ts(AS_OF - dt.timedelta(days=5))} AS DATE)
     AND CAST({PQ._ts(AS_OF - dt.timedelta(days=1))} AS DATE), false) AS ok FROM found f LEFT JOIN w USING (project_id)),
dedup AS (SELECT *""", 1).replace("AS rn FROM found)", "AS rn FROM judged WHERE ok)").replace(
    "kept AS (SELECT * EXCLUDE (rn) FROM dedup)",
    "kept AS (SELECT * EXCLUDE (rn) FROM dedup WHERE NOT (story_id % 4 = 0 AND project_id IN (0, 3, 6, 9)))") + """
, f AS (SELECT project_id, count(*) FILTER (WHERE ok) AS found, count(*) FILTER (WHERE NOT ok) AS late FROM judged GROUP BY 1),
k AS (SELECT project_id, count(*) AS kept FROM kept GROUP BY 1),
a AS (SELECT s.project_id, count(*) AS above FROM scored s JOIN proj p USING (project_id) WHERE s.model_score >= coalesce(p.min_confidence, 0) GROUP BY 1)
SELECT project_id, found, late, coalesce(kept, 0) AS kept, coalesce(above, 0) AS above FROM f LEFT JOIN k USING (project_id) LEFT JOIN a USING (project_id)""")
def q_run_daily(spark, sf_dir):
    """The run as it goes daily: only stories in their project's window, and
    not those the log has already."""
    stories = fixtures.stories_from_documents(table(spark, sf_dir, "documents")).withColumn(
        "publish_date", F.col("indexed_date") - F.make_dt_interval(days=(F.col("story_id") % 3).cast("int")))
    # The platform's date, where it gives one, against a wrong one from the page
    given = F.when(F.col("story_id") % 3 != 0, F.date_format("publish_date", "yyyy-MM-dd HH:mm:ss"))
    stories = stories.withColumn("source_publish_date", given).withColumn(
        "publish_date", F.when(given.isNull(), F.col("publish_date")).otherwise(F.lit("1999-01-01").cast("timestamp")))
    run = pipeline.run(stories, fixtures.projects(spark), fixtures.project_terms(spark), fixtures.models(spark), CQ.model_terms(spark, sf_dir),
                       AS_OF, log=_daily_log(spark, sf_dir), history=PQ.history_before(spark, sf_dir))
    count = lambda df, name: df.groupBy("project_id").agg(F.count(F.lit(1)).alias(name))
    out = count(run.found, "found").join(count(run.late, "late"), "project_id", "full")
    for name, df in (("kept", run.stored), ("above", run.above)):
        out = out.join(count(df, name), "project_id", "left")
    return out.select("project_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("found", "late", "kept", "above")])
