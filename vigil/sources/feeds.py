"""Sources: project/model configs, platform feeds, fetched pages.

Each platform delivers stories in its own shape; each ``from_*`` function is a
``select`` into the canonical story schema, so all platforms union into one
DataFrame (G1) and the rest of the job never branches on platform.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import schemas
from vigil.functions import text as TX
from vigil.functions import urls as U


class ConfigError(RuntimeError):
    pass


def _require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.limit(1).count() == 0:
        raise ConfigError(f"{what} list is empty")
    return df


def _with_id(schema: T.StructType) -> T.StructType:
    """The schema plus a plain ``id`` field: config lists key records by ``id``."""
    return T.StructType([*schema.fields, T.StructField("id", T.LongType())])


def _read_config(spark: SparkSession, path: str, schema: T.StructType, key: str, multi_line: bool) -> DataFrame:
    raw = spark.read.schema(_with_id(schema)).option("multiLine", multi_line).json(path)
    return raw.withColumn(key, F.coalesce(F.col(key), F.col("id"))).select(*schema.fieldNames())


def read_projects(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A1: project list (a JSON array; JSON lines with ``multi_line=False``,
    which long lists are split by), explicit schema; records
    keyed by ``id`` or ``project_id``; NBSP and curly quotes in the search
    terms are cleaned; an empty list is an error."""
    df = _read_config(spark, path, schemas.PROJECT, "project_id", multi_line)
    df = df.withColumn("search_terms", TX.clean_terms("search_terms"))
    return _require_rows(df, "project")


def read_models(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A2: model list keyed by ``id`` or ``model_id``; an empty list is an error."""
    return _require_rows(_read_config(spark, path, schemas.MODEL, "model_id", multi_line), "model")


def with_countries(projects: DataFrame) -> DataFrame:
    """B1: projects with a two-letter country code."""
    c = F.col("newscatcher_country")
    return projects.filter(c.isNotNull() & (F.length(c) == 2))


def remap_collections(projects: DataFrame, mapping: dict[int, int]) -> DataFrame:
    """Replace collection ids by others in every project's list."""
    if not mapping:
        return projects
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k).cast("long"), F.lit(v).cast("long"))])
    return projects.withColumn(
        "media_collections",
        F.transform("media_collections", lambda c: F.coalesce(F.try_element_at(m, c), c)))


def filter_country(stories: DataFrame, projects: DataFrame) -> DataFrame:
    """Stories whose country equals their project's country."""
    p = projects.select("project_id", F.upper("newscatcher_country").alias("__country"))
    return (stories.join(p, "project_id")
            .filter(F.upper(F.col("country")) == F.col("__country")).drop("__country"))


def with_source(df: DataFrame, name: str) -> DataFrame:
    """Tag rows with a platform name from the fixed list."""
    if name not in schemas.PLATFORMS:
        raise ValueError(f"unknown platform {name!r}")
    return df.withColumn("source", F.lit(name))


def _canonical(**cols: Column) -> list[Column]:
    out = []
    for f in schemas.STORY.fields:
        c = cols.get(f.name, F.lit(None))
        out.append(c.cast(f.dataType).alias(f.name))
    return out


def from_archive_feed(df: DataFrame) -> DataFrame:
    """A3: indexed-archive items (``url, title, text, publish_date, language,
    media_id, media_url, media_name, indexed_date, story_tags``) -> stories;
    trailing slashes leave the URL; ``source_publish_date = str(publish_date)``."""
    cols = set(df.columns)
    return df.select(*_canonical(
        project_id=F.col("project_id") if "project_id" in cols else F.lit(None),
        url=U.strip_trailing_slash("url"),
        source=F.lit(schemas.SOURCE_MEDIA_CLOUD),
        title=F.col("title"), story_text=F.col("text"), language=F.col("language"),
        publish_date=F.col("publish_date"),
        source_publish_date=F.date_format("publish_date", "yyyy-MM-dd HH:mm:ss"),
        indexed_date=F.col("indexed_date"),
        media_id=F.col("media_id") if "media_id" in cols else F.lit(None),
        media_url=F.col("media_url") if "media_url" in cols else F.lit(None),
        media_name=F.col("media_name") if "media_name" in cols else F.lit(None),
        story_tags=F.col("story_tags") if "story_tags" in cols else F.lit(None),
    ))


def from_search_feed(df: DataFrame, projects: DataFrame) -> DataFrame:
    """A4: search-API articles (``project_id, link, published_date, title,
    authors``) -> stories; language comes from the project, media name and URL
    from the link's domain.  Projects are a config table (broadcast by size)."""
    p = projects.select("project_id", F.col("language").alias("__lang"))
    j = df.join(p, "project_id", "left")
    return j.select(*_canonical(
        project_id=F.col("project_id"), url=F.col("link"),
        source=F.lit(schemas.SOURCE_NEWSCATCHER), title=F.col("title"),
        language=F.col("__lang"), source_publish_date=F.col("published_date"),
        publish_date=(F.col("published_date")).try_cast("timestamp"),
        media_url=U.canonical_domain("link"), media_name=U.canonical_domain("link"),
        authors=F.col("authors") if "authors" in df.columns else F.lit(None),
    ))


def from_webarchive_feed(df: DataFrame) -> DataFrame:
    """A5: web-archive items (``project_id, url, title, publish_date,
    language, media_url, media_name, article_url, archived_url``) -> stories, keeping
    the extracted-content and archive URLs; no authors."""
    return df.select(*_canonical(
        project_id=F.col("project_id"), url=F.col("url"),
        source=F.lit(schemas.SOURCE_WAYBACK_MACHINE), title=F.col("title"),
        language=F.col("language"), source_publish_date=F.col("publish_date"),
        publish_date=(F.col("publish_date")).try_cast("timestamp"),
        media_url=F.col("media_url"), media_name=F.col("media_name"),
        extracted_content_url=F.col("article_url"),
        archived_url=F.col("archived_url"),
    ))


def all_feeds(*feeds: DataFrame) -> DataFrame:
    """G1: union all (by name) of canonical feeds."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_pages(df: DataFrame, content_col: str = "html", url_col: str = "url") -> DataFrame:
    """Fetched pages keyed by the pre-redirect URL:
    ``original_url = coalesce(redirect_urls[0], request url)``."""
    orig = (F.coalesce(F.try_element_at(F.col("redirect_urls"), F.lit(1)), F.col(url_col))
            if "redirect_urls" in df.columns else F.col(url_col))
    return df.select(F.col(content_col).alias("content"), F.col(url_col).alias("final_url"),
                     orig.alias("original_url"))


def parse_extracted(df: DataFrame, content_col: str = "content", field: str = "snippet",
                    out_col: str = "story_text") -> tuple[DataFrame, DataFrame]:
    """Take one JSON field as text.  Returns ``(ok, bad)``: rows whose
    content does not parse or lacks the field go to ``bad`` (counted by the
    caller), never silently dropped."""
    parsed = df.withColumn(out_col, TX.json_field(content_col, field))
    return parsed.filter(F.col(out_col).isNotNull()), parsed.filter(F.col(out_col).isNull()).drop(out_col)


def project_domains(projects: DataFrame, sources: DataFrame) -> DataFrame:
    """The domains of each project's collections.

    A source counts when it has a name and no ``url_search_string``.  Output is
    one row per (project_id, domain) -- distinct -- rather than a collected
    list, so a project with millions of domains never becomes one row.
    """
    pc = projects.select("project_id", F.explode("media_collections").alias("collection_id"))
    good = sources.filter(F.col("url_search_string").isNull() & F.col("name").isNotNull()) \
        .select("collection_id", F.col("name").alias("domain"))
    return pc.join(good, "collection_id").select("project_id", "domain").distinct()


def filter_domains(stories: DataFrame, domains: DataFrame, url_col: str = "url") -> DataFrame:
    """Keep stories whose domain is one of their project's domains
    (``domains``: project_id, domain -- e.g. ``project_domains``), both without
    a leading ``www``/``m`` label.  A left semi join on (project_id, domain):
    only keys move, stories are never duplicated."""
    keyed = stories.withColumn("__host", U.canonical_domain(url_col))
    d = domains.select("project_id", U.bare_domain(F.lower("domain")).alias("__host"))
    return keyed.join(d, ["project_id", "__host"], "left_semi").drop("__host")


def drop_empty(stories: DataFrame) -> DataFrame:
    """Rows without a project (empty pages, NULL stories) do no work."""
    return stories.filter(F.col("project_id").isNotNull())
