"""Planning page fetches and attaching fetched text.

The crawler itself is outside this engine: fetched pages arrive as a table.
What remains is relational: which URLs to fetch, how to spread hosts over
fetchers, and joining page text back to every story that asked for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import text as TX
from vigil.functions import urls as U
from vigil.operators.common import bounded_broadcast, number_rows, spread, unbounded


def urls_to_fetch(stories: DataFrame, url_col: str = "url") -> DataFrame:
    """Each distinct URL once (fetched once, fanned out to projects later)."""
    return stories.select(F.col(url_col).alias("url")).filter(F.col("url").isNotNull()).distinct()


def group_by_host(urls: DataFrame, order_col: str) -> DataFrame:
    """URLs grouped by network location, URLs without one skipped.

    A group is a key, not a collected list: every URL row gets its ``host``,
    the host's order of first appearance (``host_order``, 1-based) and its
    position inside the host (``pos_in_host``).  Numbering is skew-safe, so a
    host with a third of all URLs is never gathered into one task.
    """
    tagged = urls.withColumn("host", U.netloc("url")).filter(F.col("host") != "")
    hosts = tagged.groupBy("host").agg(F.min(order_col).alias("__first"))
    hosts = number_rows(hosts, [], ["__first", "host"], out_col="host_order").drop("__first")
    within = number_rows(tagged, ["host"], [order_col], out_col="pos_in_host")
    return within.join(hosts, "host")


def host_batches(urls: DataFrame, order_col: str, n: int = 4) -> DataFrame:
    """hosts dealt round-robin over ``n`` fetch batches in order of first
    appearance; a host is never split across batches."""
    g = group_by_host(urls, order_col)
    return g.withColumn("batch", ((F.col("host_order") - 1) % F.lit(n)).cast("long"))


def attach_text(stories: DataFrame, pages: DataFrame, story_url: str = "url",
                parser: Callable[[Column], Column] = TX.html_to_text) -> DataFrame:
    """D3: every story whose URL was fetched gets the page's main text (I13);
    stories without a fetched page fall out (inner equi-join).

    Only pages that some story asks for are parsed: the distinct URLs are
    semi-joined first (broadcast within their measured bound).  ``parser`` is
    the caller's own extraction, a native expression of the page's content.
    """
    s = stories.drop("story_text") if "story_text" in stories.columns else stories
    asked = s.select(F.col(story_url).alias("original_url")).filter(F.col("original_url").isNotNull()).distinct()
    p = spread(pages).join(bounded_broadcast(asked), "original_url", "left_semi").select(
        F.col("original_url").alias("__u"), TX.html_title("content").alias("page_title"),
        parser(F.col("content")).alias("story_text"), TX.html_published_date("content").alias("page_date"))
    return s.join(unbounded(p), s[story_url] == p["__u"]).drop("__u")


def text_failures(stories: DataFrame, pages: DataFrame, story_url: str = "url") -> DataFrame:
    """Per project, stories that got no text."""
    missing = stories.join(unbounded(pages.select(F.col("original_url").alias(story_url))), story_url, "left_anti")
    return missing.groupBy("project_id").agg(F.count(F.lit(1)).alias("no_text"))
