"""Registered queries: URLs, feeds, de-duplication, fetch planning, page text."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions import text as TX
from vigil.functions import urls as U
from vigil.operators import dedupe as D
from vigil.operators import fetch as FE
from vigil.operators.common import spread
from vigil.plans.registry import query
from vigil.sources import feeds as FD
from vigil.sources import fixtures
from vigil.sources.tables import table

AS_OF = fixtures.AS_OF
TS_AS_OF = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"

# ---------------------------------------------------------------------------
# DuckDB building blocks (twins of the Spark expressions)
# ---------------------------------------------------------------------------
TRACKING = U.TRACKING_PARAM


def norm_sql(col: str) -> str:
    """DuckDB twin of urls.normalize_url, as one expression over ``col``."""
    u = (f"regexp_replace(regexp_replace(regexp_replace(lower(trim({col})), "
         f"'^[a-z][a-z0-9+.\\-]*://', ''), '^www\\.', ''), '#.*$', '')")
    base = f"regexp_replace(split_part({u}, '?', 1), '/+$', '')"
    q = f"(CASE WHEN strpos({u}, '?') > 0 THEN substr({u}, strpos({u}, '?') + 1) ELSE '' END)"
    params = (f"list_filter(string_split({q}, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}'))")
    return (f"nullif(CASE WHEN len({params}) > 0 THEN {base} || '?' || array_to_string({params}, '&') "
            f"ELSE {base} END, '')")


NETLOC_SQL = "regexp_extract({c}, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#]*)', 1)"
HOST_SQL = "lower(regexp_extract({c}, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
DOMAIN_SQL = "regexp_replace(" + HOST_SQL + ", '^(www[0-9]*|m)\\.', '')"

FEED_CTE = f"""
WITH feed0 AS (
  SELECT page_id * 100 + v AS feed_pos, page_id, (page_id + v) % 10 AS project_id,
         CASE v WHEN 0 THEN url
                WHEN 1 THEN concat(url, CASE WHEN url LIKE '%#%' OR url LIKE '%?%' THEN '' ELSE '/' END)
                WHEN 2 THEN concat(url, CASE WHEN url LIKE '%#%' OR url LIKE '%?%' THEN '' ELSE '?utm_source=mail' END)
                ELSE replace(url, 'http://', 'https://') END AS url
  FROM (SELECT page_id, url, unnest([0, 1, 2, 3, 10, 11]) AS v FROM pages)),
feed AS (SELECT *, {norm_sql('url')} AS normalized_url FROM feed0),
deduped AS (
  SELECT feed_pos, page_id, project_id, url, normalized_url FROM (
    SELECT *, row_number() OVER (PARTITION BY project_id, coalesce(normalized_url, url) ORDER BY feed_pos) AS rn
    FROM feed) WHERE rn = 1),
prior_log AS (
  SELECT page_id % 10 AS project_id, url, {norm_sql('url')} AS normalized_url,
         {TS_AS_OF} - INTERVAL '1' DAY * (page_id % 30) AS queued_date,
         CASE WHEN page_id % 4 = 0 THEN NULL
              ELSE {TS_AS_OF} - INTERVAL '1' DAY * (page_id % 30) + INTERVAL '1' HOUR END AS processed_date
  FROM pages)
"""


def feed(spark, sf_dir):
    f = fixtures.feed_from_pages(table(spark, sf_dir, "pages"))
    return f.withColumn("normalized_url", U.normalize_url("url"))


def deduped(spark, sf_dir):
    return D.dedupe(feed(spark, sf_dir), order_by="feed_pos")


def prior_log(spark, sf_dir):
    """Stories logged before this run, derived from ``pages``."""
    p = table(spark, sf_dir, "pages")
    q = F.to_timestamp(F.lit(f"{AS_OF:%Y-%m-%d %H:%M:%S}")) - F.make_dt_interval(days=(F.col("page_id") % 30).cast("int"))
    return p.select((F.col("page_id") % 10).alias("project_id"), "url",
                    U.normalize_url("url").alias("normalized_url"),
                    q.alias("queued_date"),
                    F.when(F.col("page_id") % 4 == 0, F.lit(None).cast("timestamp"))
                    .otherwise(q + F.make_dt_interval(hours=F.lit(1))).alias("processed_date"))


@query("normalized_feed", sql=FEED_CTE + f"""
SELECT feed_pos, project_id, url, normalized_url,
       {NETLOC_SQL.format(c='url')} AS netloc,
       {DOMAIN_SQL.format(c='url')} AS domain,
       regexp_replace(url, '/+$', '') AS stripped
FROM feed""")
def q_normalized_feed(spark, sf_dir):
    return feed(spark, sf_dir).select(
        "feed_pos", "project_id", "url", "normalized_url",
        U.netloc("url").alias("netloc"), U.canonical_domain("url").alias("domain"),
        U.strip_trailing_slash("url").alias("stripped"))


@query("dedupe_first_wins", sql=FEED_CTE + "SELECT feed_pos, project_id, url, normalized_url FROM deduped")
def q_dedupe(spark, sf_dir):
    return deduped(spark, sf_dir).select("feed_pos", "project_id", "url", "normalized_url")


@query("dedupe_ignored_counts", sql=FEED_CTE + """
, b AS (SELECT project_id, count(*) AS found FROM feed GROUP BY 1),
  a AS (SELECT project_id, count(*) AS kept FROM deduped GROUP BY 1)
SELECT b.project_id, found, coalesce(kept, 0) AS kept, found - coalesce(kept, 0) AS ignored
FROM b LEFT JOIN a USING (project_id)""")
def q_ignored(spark, sf_dir):
    return D.ignored_counts(feed(spark, sf_dir), deduped(spark, sf_dir))


@query("drop_recently_processed", sql=FEED_CTE + f"""
SELECT d.feed_pos, d.project_id, d.url FROM deduped d
WHERE NOT EXISTS (SELECT 1 FROM prior_log l
                  WHERE l.project_id = d.project_id
                    AND coalesce(l.normalized_url, l.url) = coalesce(d.normalized_url, d.url)
                    AND l.queued_date > {TS_AS_OF} - INTERVAL '14' DAY
                    AND l.processed_date IS NOT NULL)""")
def q_drop_recent(spark, sf_dir):
    return D.drop_recently_processed(deduped(spark, sf_dir), prior_log(spark, sf_dir), AS_OF, 14) \
        .select("feed_pos", "project_id", "url")


@query("skipped_counts", sql=FEED_CTE + f"""
SELECT d.project_id, count(*) AS skipped_dupes FROM deduped d
WHERE EXISTS (SELECT 1 FROM prior_log l
              WHERE l.project_id = d.project_id
                AND coalesce(l.normalized_url, l.url) = coalesce(d.normalized_url, d.url)
                AND l.queued_date > {TS_AS_OF} - INTERVAL '14' DAY
                AND l.processed_date IS NOT NULL)
GROUP BY 1""")
def q_skipped(spark, sf_dir):
    return D.skipped_counts(deduped(spark, sf_dir), prior_log(spark, sf_dir), AS_OF, 14)


@query("dedupe_against_log", sql=FEED_CTE + """
SELECT d.feed_pos, d.project_id, d.url FROM deduped d
WHERE NOT EXISTS (SELECT 1 FROM prior_log l WHERE l.project_id = d.project_id
                  AND coalesce(l.normalized_url, l.url) = coalesce(d.normalized_url, d.url))""")
def q_against_log(spark, sf_dir):
    return D.dedupe_against_log(deduped(spark, sf_dir), prior_log(spark, sf_dir)) \
        .select("feed_pos", "project_id", "url")


@query("cap_per_project_50", sql=FEED_CTE + """
SELECT feed_pos, project_id, url FROM (
  SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY feed_pos DESC, url) AS rn FROM deduped)
WHERE rn <= 50""")
def q_cap(spark, sf_dir):
    return D.cap_per_project(deduped(spark, sf_dir), 50, [F.desc("feed_pos"), F.col("url")]) \
        .select("feed_pos", "project_id", "url")


@query("batch_numbers", sql=FEED_CTE + """
SELECT project_id, feed_pos, rn AS batch_pos, (rn - 1) // 10 AS batch_no FROM (
  SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY feed_pos) AS rn FROM deduped)""")
def q_batches(spark, sf_dir):
    return D.batch_numbers(deduped(spark, sf_dir), ["feed_pos"], size=10) \
        .select("project_id", "feed_pos", "batch_pos", "batch_no")


@query("urls_to_fetch", sql=FEED_CTE + "SELECT DISTINCT url FROM deduped WHERE url IS NOT NULL")
def q_urls_to_fetch(spark, sf_dir):
    return FE.urls_to_fetch(deduped(spark, sf_dir))


_HOSTS_SQL = FEED_CTE + f"""
, t AS (SELECT feed_pos, url, {NETLOC_SQL.format(c='url')} AS host FROM feed),
  t2 AS (SELECT * FROM t WHERE host <> ''),
  h AS (SELECT host, row_number() OVER (ORDER BY min(feed_pos), host) AS host_order FROM t2 GROUP BY host)
SELECT t2.host, t2.url, t2.feed_pos,
       row_number() OVER (PARTITION BY t2.host ORDER BY t2.feed_pos) AS pos_in_host,
       h.host_order{{extra}}
FROM t2 JOIN h USING (host)"""


@query("host_groups", sql=_HOSTS_SQL.format(extra=""))
def q_host_groups(spark, sf_dir):
    return FE.group_by_host(feed(spark, sf_dir).select("feed_pos", "url"), "feed_pos") \
        .select("host", "url", "feed_pos", "pos_in_host", "host_order")


@query("host_batches", sql=_HOSTS_SQL.format(extra=", (h.host_order - 1) % 4 AS batch"))
def q_host_batches(spark, sf_dir):
    return FE.host_batches(feed(spark, sf_dir).select("feed_pos", "url"), "feed_pos", 4) \
        .select("host", "url", "feed_pos", "pos_in_host", "host_order", "batch")


def _text_sql(c: str) -> str:
    s = f"regexp_replace({c}, '(?s)<!--.*?-->', ' ', 'g')"
    s = f"regexp_replace({s}, '(?is)<head[\\s>].*?</head>', ' ', 'g')"
    for tag in ["script", "style", "nav", "header", "footer", "aside", "noscript", "template"]:
        s = f"regexp_replace({s}, '(?is)<{tag}[\\s>].*?</{tag}>', ' ', 'g')"
    s = f"regexp_replace({s}, '(?is)<div class=\"ad\"[^>]*>.*?</div>', ' ', 'g')"
    s = f"regexp_replace({s}, '<[^>]*>', ' ', 'g')"
    return f"trim(regexp_replace({_entities_sql(s)}, '\\s+', ' ', 'g'))"


def _entities_sql(s: str) -> str:
    s = f"replace({s}, '&amp;', chr(1))"
    for ent, ch in TX.ENTITIES:
        ch_sql = ch.replace("'", "''")
        s = f"replace({s}, '{ent}', '{ch_sql}')"
    s = f"regexp_replace({s}, '&(?:#[0-9]+|#x[0-9a-fA-F]+|[a-zA-Z]+);', ' ', 'g')"
    return f"replace({s}, chr(1), '&')"


def _title_sql(c: str) -> str:
    t = f"regexp_extract({c}, '(?is)<title[^>]*>(.*?)</title>', 1)"
    return f"trim(regexp_replace({_entities_sql(t)}, '\\s+', ' ', 'g'))"


@query("page_text", sql=f"""
SELECT page_id, {_title_sql('html')} AS title, {_text_sql('html')} AS text FROM pages""")
def q_page_text(spark, sf_dir):
    p = spread(table(spark, sf_dir, "pages"))
    return p.select("page_id", TX.html_title("html").alias("title"), TX.html_to_text("html").alias("text"))


def _blocks_sql(c: str) -> str:
    """The page's blocks: [{text, words, linked}] (block density)."""
    def sq(x):
        return x.replace("'", "''")

    def plain(x):
        return f"trim(regexp_replace({_entities_sql(f"regexp_replace({x}, '<[^>]*>', ' ', 'g')")}, '\\s+', ' ', 'g'))"

    def words(x):
        return f"CASE WHEN {x} = '' THEN 0 ELSE len(string_split({x}, ' ')) END"
    s = f"regexp_replace({c}, '(?s)<!--.*?-->', ' ', 'g')"
    for tag in ["head", "script", "style", "noscript", "template", "nav", "footer", "aside"]:
        s = f"regexp_replace({s}, '(?is)<{tag}(?:\\s[^>]*)?>.*?</{tag}>', ' ', 'g')"
    links = "array_to_string(regexp_extract_all(b, '(?is)<a(?:\\s[^>]*)?>(.*?)</a>', 1), ' ')"
    parts = f"list_transform(string_split_regex({s}, '{sq(TX.BLOCK_TAG)}'), lambda b: {{'text': {plain('b')}, 'link': {plain(links)}}})"
    blocks = f"list_transform({parts}, lambda p: {{'text': p.text, 'words': {words('p.text')}, 'linked': {words('p.link')}}})"
    return f"list_filter({blocks}, lambda b: b.words > 0)"


def main_text_cte(name: str, source: str) -> str:
    """CTE ``name``: ``source``'s columns and ``main``, its ``html``'s text by block density."""
    free = "(bs[{i}].words - bs[{i}].linked)"
    keep = (f"coalesce({free.format(i='i - 1')} * (i > 1)::INT, 0) + 2 * {free.format(i='i')} + coalesce({free.format(i='i + 1')}, 0) >= {4 * TX.MIN_DENSITY}"
            f" AND {TX.MAX_LINK_SHARE} * bs[i].linked <= bs[i].words")
    return (f"{name}_blocks AS (SELECT *, {_blocks_sql('html')} AS bs FROM {source}),\n"
            f"{name} AS (SELECT * EXCLUDE (bs), array_to_string(list_transform(list_filter(range(1, len(bs) + 1), lambda i: {keep}), "
            f"lambda i: bs[i].text), ' ') AS main FROM {name}_blocks)")


@query("page_text_blocks", sql="WITH " + main_text_cte("m", "pages") + " SELECT page_id, main AS text FROM m")
def q_page_text_blocks(spark, sf_dir):
    """I13 by block density, which knows no class of any site."""
    return spread(table(spark, sf_dir, "pages")).select("page_id", TX.main_text("html").alias("text"))


@query("attach_text_blocks", sql=FEED_CTE + ", " + main_text_cte("m", "pages") + """
SELECT d.feed_pos, d.project_id, d.url, m.main AS story_text FROM deduped d JOIN m ON d.url = m.url""")
def q_attach_text_blocks(spark, sf_dir):
    """D3 with the caller's own parser (a native expression)."""
    pages = FD.read_pages(table(spark, sf_dir, "pages"))
    return FE.attach_text(deduped(spark, sf_dir), pages, parser=TX.main_text).select("feed_pos", "project_id", "url", "story_text")


@query("attach_text", sql=FEED_CTE + f"""
SELECT d.feed_pos, d.project_id, d.url, {_title_sql('p.html')} AS page_title, {_text_sql('p.html')} AS story_text
FROM deduped d JOIN pages p ON d.url = p.url""")
def q_attach_text(spark, sf_dir):
    pages = FD.read_pages(table(spark, sf_dir, "pages"))
    return FE.attach_text(deduped(spark, sf_dir), pages) \
        .select("feed_pos", "project_id", "url", "page_title", "story_text")


@query("text_failures", sql=FEED_CTE + """
SELECT project_id, count(*) AS no_text FROM deduped d
WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = d.url) GROUP BY 1""")
def q_text_failures(spark, sf_dir):
    pages = FD.read_pages(table(spark, sf_dir, "pages"))
    return FE.text_failures(deduped(spark, sf_dir), pages)


@query("parse_extracted_ok", sql="""
SELECT event_id, json_extract_string(props, '$.k') AS story_text FROM events
WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def q_parse_ok(spark, sf_dir):
    ok, _ = FD.parse_extracted(table(spark, sf_dir, "events"), "props", field="k")
    return ok.select("event_id", "story_text")


@query("parse_extracted_bad", sql="""
SELECT count(*) AS bad FROM events WHERE json_extract_string(props, '$.k') IS NULL""")
def q_parse_bad(spark, sf_dir):
    _, bad = FD.parse_extracted(table(spark, sf_dir, "events"), "props", field="k")
    return bad.agg(F.count(F.lit(1)).alias("bad"))


def _projects_values() -> str:
    rows = []
    for r in fixtures.PROJECT_ROWS:
        cols = "[" + ", ".join(str(c) for c in r[4]) + "]"
        rows.append(f"({r[0]}, {cols})")
    return "(VALUES " + ", ".join(rows) + ") AS p(project_id, media_collections)"


@query("project_domains", sql=f"""
WITH pc AS (SELECT project_id, unnest(media_collections) AS collection_id FROM {_projects_values()}),
src AS (SELECT page_id % 5 AS collection_id,
               CASE WHEN page_id % 11 = 0 THEN NULL ELSE {HOST_SQL.format(c='url')} END AS name,
               CASE WHEN page_id % 7 = 0 THEN '/section/*' END AS url_search_string FROM pages)
SELECT DISTINCT CAST(pc.project_id AS BIGINT) AS project_id, src.name AS domain
FROM pc JOIN src USING (collection_id)
WHERE src.url_search_string IS NULL AND src.name IS NOT NULL""")
def q_project_domains(spark, sf_dir):
    return FD.project_domains(fixtures.projects(spark),
                              fixtures.collection_sources(table(spark, sf_dir, "pages")))


def _archive_items(spark, sf_dir):
    s = fixtures.stories_from_documents(table(spark, sf_dir, "documents"))
    return s.select((F.col("story_id") % 10).alias("project_id"),
                    F.concat("url", F.lit("/")).alias("url"), "title",
                    F.col("story_text").alias("text"), "language", "media_name",
                    F.col("indexed_date").alias("publish_date"), "indexed_date")


def _search_items(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select((F.col("page_id") % 10).alias("project_id"), F.col("url").alias("link"),
                    TX.html_title("html").alias("title"),
                    F.lit("2024-01-15 10:00:00").alias("published_date"))


def _webarchive_items(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select(((F.col("page_id") + 5) % 10).alias("project_id"), "url",
                    TX.html_title("html").alias("title"),
                    F.lit("2024-01-20").alias("publish_date"),
                    F.regexp_extract("html", r'<html lang="([a-z]+)"', 1).alias("language"),
                    U.canonical_domain("url").alias("media_url"), U.canonical_domain("url").alias("media_name"),
                    F.concat(F.lit("https://archive.example.org/extract/"), F.col("page_id").cast("string")).alias("article_url"),
                    F.concat(F.lit("https://archive.example.org/web/"), F.col("url")).alias("archived_url"))


def _projects_lang_values() -> str:
    rows = ", ".join(f"({r[0]}, '{r[2]}')" for r in fixtures.PROJECT_ROWS)
    return f"(VALUES {rows}) AS p(project_id, language)"


@query("canonical_feeds", sql=f"""
SELECT doc_id % 10 AS project_id,
       regexp_replace(concat('https://', source, '.example.org/story/', CAST(doc_id AS VARCHAR), '/'), '/+$', '') AS url,
       'media-cloud' AS source, split_part(text, chr(10), 1) AS title, lang AS language, source AS media_name,
       strftime({TS_AS_OF} - INTERVAL '1' DAY * (doc_id % 30) - INTERVAL '1' HOUR * (doc_id % 24),
                '%Y-%m-%d %H:%M:%S') AS source_publish_date,
       CAST(NULL AS VARCHAR) AS extracted_content_url
FROM documents
UNION ALL
SELECT page_id % 10, url, 'newscatcher', {_title_sql('html')}, p.language, {DOMAIN_SQL.format(c='url')},
       '2024-01-15 10:00:00', NULL
FROM pages LEFT JOIN {_projects_lang_values()} ON p.project_id = pages.page_id % 10
UNION ALL
SELECT (page_id + 5) % 10, url, 'wayback-machine', {_title_sql('html')},
       regexp_extract(html, '<html lang="([a-z]+)"', 1), {DOMAIN_SQL.format(c='url')},
       '2024-01-20', concat('https://archive.example.org/extract/', CAST(page_id AS VARCHAR))
FROM pages""")
def q_canonical_feeds(spark, sf_dir):
    projects = fixtures.projects(spark)
    out = FD.all_feeds(FD.from_archive_feed(_archive_items(spark, sf_dir)),
                       FD.from_search_feed(_search_items(spark, sf_dir), projects),
                       FD.from_webarchive_feed(_webarchive_items(spark, sf_dir)))
    return out.select("project_id", "url", "source", "title", "language", "media_name",
                      "source_publish_date", "extracted_content_url")


@query("filter_domains", sql=FEED_CTE + f"""
, pc AS (SELECT project_id, unnest(media_collections) AS collection_id FROM {_projects_values()}),
src AS (SELECT page_id % 5 AS collection_id,
               CASE WHEN page_id % 11 = 0 THEN NULL ELSE {HOST_SQL.format(c='url')} END AS name,
               CASE WHEN page_id % 7 = 0 THEN '/section/*' END AS url_search_string FROM pages),
dom AS (SELECT DISTINCT CAST(pc.project_id AS BIGINT) AS project_id, src.name AS domain
        FROM pc JOIN src USING (collection_id) WHERE src.url_search_string IS NULL AND src.name IS NOT NULL)
SELECT d.feed_pos, d.project_id, d.url FROM deduped d
WHERE EXISTS (SELECT 1 FROM dom WHERE dom.project_id = d.project_id AND regexp_replace(dom.domain, '^(www[0-9]*|m)\\.', '')
              = regexp_replace({HOST_SQL.format(c='d.url')}, '^(www[0-9]*|m)\\.', ''))""")
def q_filter_domains(spark, sf_dir):
    domains = FD.project_domains(fixtures.projects(spark),
                                 fixtures.collection_sources(table(spark, sf_dir, "pages")))
    return FD.filter_domains(deduped(spark, sf_dir), domains).select("feed_pos", "project_id", "url")
