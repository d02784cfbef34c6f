"""URL filter with redirect equivalence.

Rules decide the urls they fit.  Urls that redirect to each other or name the
same canonical page are aliases: the connected components over those links.
A url that no rule fits is allowed if a rule allows one of its aliases (an
explicit allow goes before any block), else blocked if a rule blocks one,
else allowed.  A rule that fits a url always decides it.

Links come from ``<link rel="canonical">`` and ``<meta http-equiv="refresh">``
of the pages.  Urls are the same node when host (lower case) and path agree;
scheme, query and fragment do not matter.  Linked urls need not be pages.

Only DataFrame functions; the page sources are read once, for their links.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule, has no aliases and is allowed; a null or empty source has
no links; links without a host are ignored; repeated rows are judged one by
one; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.components import connected_components
from vigil.llm.storage import Scratch
from vigil.operators.common import bounded_broadcast

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    fits = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p),
                   F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in rules]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute: in either quotes, or bare up to white space."""
    value = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, value, i) for i in (1, 2, 3)])


def link_targets(html: Column) -> Column:
    """Targets of a page's canonical links and refresh redirects, as written."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    canonical = F.transform(F.filter(tags, lambda t: F.lower(_attribute(t, "rel")).rlike(r"(^|\s)canonical(\s|$)")),
                            lambda t: _attribute(t, "href"))
    refresh = F.transform(F.filter(tags, lambda t: F.lower(F.trim(_attribute(t, "http-equiv"))) == "refresh"),
                          lambda t: F.regexp_extract(_attribute(t, "content"), r"""(?is)^\s*[0-9.]*\s*[;,]\s*url\s*=\s*["']?([^"']*)""", 1))
    return F.filter(F.concat(canonical, refresh), lambda x: F.trim(x) != "")


def absolute(target: Column, host: Column, path: Column) -> Column:
    """A link target as an absolute url, seen from a page."""
    t = F.trim(target)
    folder = F.regexp_replace(path, "[^/]*$", "")
    return (F.when(t.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), t)
            .when(t.startswith("//"), F.concat(F.lit("http:"), t))
            .when(t.startswith("/"), F.concat(F.lit("http://"), host, t))
            .when(t.startswith("?") | t.startswith("#"), F.concat(F.lit("http://"), host, path))
            .otherwise(F.concat(F.lit("http://"), host, F.when(folder == "", F.lit("/")).otherwise(folder), t)))


def _node(host: Column, path: Column) -> Column:
    return F.when(host != "", F.concat(host, F.when(path == "", F.lit("/")).otherwise(path)))


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict, alias_of) for every page; ``alias_of`` is
    the first url of its aliases, if it has any."""
    run = Scratch(pages.sparkSession, "urls")
    url = F.col(url_col).cast("string")
    src = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
                       link_targets(F.col(html_col).cast("string")).alias("targets"))
    parsed = run.keep(src.withColumn("node", _node(F.col("host"), F.col("path")))
                      .withColumn("found", matching_rule(F.col("host"), F.col("path"), rules)), "parsed")

    out = (parsed.filter("node is not null").select("node", "host", "path", F.explode("targets").alias("target"))
           .select("node", absolute(F.col("target"), F.col("host"), F.col("path")).alias("to")))
    out = out.select("node", host_of(F.col("to")).alias("h"), path_of(F.col("to")).alias("p")).withColumn("to", _node(F.col("h"), F.col("p")))
    links = run.keep(out.filter("to is not null and to <> node").groupBy("node", "to").agg(F.first("h").alias("h"), F.first("p").alias("p")), "links")
    alias = connected_components(links.select(F.col("node").alias("u"), F.col("to").alias("v")), run, "aliases")
    # what the rules say of each url of a group of aliases
    verdict = matching_rule(F.col("h"), F.col("p"), rules)["verdict"]
    named = links.select(F.col("to").alias("node"), verdict.alias("verdict")).unionByName(
        parsed.select("node", F.col("found.verdict").alias("verdict"))).filter("verdict is not null").distinct()
    says = lambda v: F.max(F.col("verdict") == v)
    groups = alias.join(named, "node").groupBy("component").agg(says("allow").alias("allow"), says("block").alias("block"))
    decided = alias.join(groups, "component", "left").select(
        F.col("node"), F.col("component").alias("alias_of"),
        F.when(F.coalesce("allow", F.lit(False)), "allow").when(F.coalesce("block", F.lit(False)), "block").alias("inherited"))
    return (parsed.join(bounded_broadcast(decided), "node", "left")
            .select(F.col("id").alias(id_col), "host", "path", F.col("found.rule").alias("rule"),
                    F.coalesce("found.verdict", "inherited", F.lit("allow")).alias("verdict"), "alias_of"))
