"""URL expressions (I1-I4): native regex/array functions, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track a click and never change the story.
TRACKING_PARAM = r"^(utm_[^=]*|fbclid|gclid|at_medium|at_campaign|ref)(=.*)?$"
_NETLOC = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)"
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_trailing_slash(url: Column | str) -> Column:
    """I4: ``url.rstrip('/')``."""
    return F.regexp_replace(_c(url), "/+$", "")


def netloc(url: Column | str) -> Column:
    """The network location (``user@host:port``), '' when there is none."""
    return F.regexp_extract(_c(url), _NETLOC, 1)


def host(url: Column | str) -> Column:
    """Lower-cased host name without user info or port, '' when absent."""
    return F.lower(F.regexp_extract(_c(url), _HOST, 1))


def canonical_domain(url: Column | str) -> Column:
    """Host without a leading ``www``/``wwwN``/``m`` label."""
    return bare_domain(host(url))


def bare_domain(name: Column) -> Column:
    """A host name without its leading ``www``/``wwwN``/``m`` label."""
    return F.regexp_replace(name, r"^(www[0-9]*|m)\.", "")


def normalize_url(url: Column | str) -> Column:
    """The de-duplication key of a URL.

    trim, lower-case, drop leading schemes and ``www.``, drop the fragment,
    drop tracking parameters (keeping the others in order), strip trailing
    slashes from the path, NULL when nothing is left.  Idempotent.
    """
    u = F.regexp_replace(F.lower(_c(url)), "(?s)#.*$", "")
    u = F.regexp_replace(u, r"^(?:\s|[a-z][a-z0-9+.\-]*://|www\.)+", "")
    base = F.regexp_replace(F.substring_index(u, "?", 1), r"[/\s]+$", "")
    query = F.when(F.instr(u, "?") > 0, F.substring(u, F.instr(u, "?") + 1, 1 << 30)).otherwise(F.lit(""))
    params = F.transform(F.split(query, "&"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    params = F.filter(params, lambda p: (p != "") & ~p.rlike(TRACKING_PARAM))
    out = F.when(F.size(params) > 0, F.concat(base, F.lit("?"), F.array_join(params, "&"))).otherwise(base)
    return F.when(out == "", F.lit(None).cast("string")).otherwise(out)


def url_date(url: Column | str) -> Column:
    """Publication date from a ``/YYYY/MM/DD/`` URL path, else NULL (part of I14)."""
    m = F.regexp_extract(_c(url), r"/((?:19|20)[0-9]{2})/([01][0-9])/([0-3][0-9])(?:/|$)", 0)
    ymd = F.regexp_replace(m, r"^/|/$", "")
    return F.try_to_timestamp(F.nullif(ymd, F.lit("")), F.lit("yyyy/MM/dd"))
