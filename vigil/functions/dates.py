"""Date and time expressions.

Every operator that looks at "now" takes an explicit ``as_of``; literals are
built from strings so they are read in the session time zone (UTC), not in
the Python process's zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layouts tried, in order, by the lenient parser (I6).  ISO forms with a 'T'
# or zone suffix are handled by the plain cast first.
LENIENT_FORMATS = [
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "dd MMM yyyy HH:mm:ss Z",
    "dd MMM yyyy",
    "MMMM d, yyyy",
    "yyyy/MM/dd",
]


def ts_lit(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP literal in the session zone."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.to_timestamp(F.lit(value))


def date_lit(value: dt.datetime | dt.date | str) -> Column:
    if isinstance(value, dt.datetime):
        value = value.date()
    if isinstance(value, dt.date):
        value = value.isoformat()
    return F.to_date(F.lit(value))


def days_before(as_of: dt.datetime, days: int) -> Column:
    """``as_of - days`` as a timestamp."""
    return ts_lit(as_of - dt.timedelta(days=days))


def day_floor_before(as_of: dt.datetime, days: int) -> Column:
    """``date(as_of) - days`` as a DATE (the reports' ``'...'::DATE`` bound)."""
    return date_lit(as_of.date() - dt.timedelta(days=days))


def day(c: Column | str) -> Column:
    """Day bucket, ``x::date`` (I8)."""
    return F.to_date(F.col(c) if isinstance(c, str) else c)


def day_text(c: Column | str) -> Column:
    """A day as ``yyyy-MM-dd`` text: the label reports show (applied after
    aggregation, on the small result)."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


def _attempts(s: Column | str) -> list[Column]:
    s = F.col(s) if isinstance(s, str) else s
    # RFC 822 dates start with a day name, which parsers no longer accept
    t = F.regexp_replace(F.trim(s), r"^[A-Za-z]{3},\s*", "")
    return [t.try_cast("timestamp")] + [F.try_to_timestamp(t, F.lit(f)) for f in LENIENT_FORMATS]


def lenient_timestamp(s: Column | str, fallback: Column) -> Column:
    """Parse a date string leniently; unparsable or missing -> ``fallback``.

    Native expressions only: a chain of ``try_to_timestamp`` attempts.
    """
    return F.coalesce(*_attempts(s), fallback)


def used_fallback(s: Column | str) -> Column:
    return F.coalesce(*_attempts(s)).isNull()


def parse_start_date(s: Column | str) -> Column:
    """Project start date such as ``2023-12-01T00:00:00Z``; NULL when unusable."""
    s = F.col(s) if isinstance(s, str) else s
    return (s).try_cast("timestamp")


def prefer_source_date(source_publish_date: Column | str, extracted: Column | str) -> Column:
    """The platform's date wins over the date extracted from the page."""
    sp = F.col(source_publish_date) if isinstance(source_publish_date, str) else source_publish_date
    ex = F.col(extracted) if isinstance(extracted, str) else extracted
    return F.coalesce((sp).try_cast("timestamp"), ex)
