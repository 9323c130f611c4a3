"""Strict ``yyyy-MM-dd HH:mm:ss`` timestamp parsing.

Functions come in pairs: ``*_sql(expr)`` returns Spark SQL text over a SQL
expression (usually a column name), and the plain function wraps it in one
``F.expr`` call, so building a plan costs one call into the JVM per
expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.  Accepted shape of a transaction timestamp: four-digit year,
# two-digit month and day, one or more spaces, one- or two-digit hour,
# two-digit minute and second, then an optional fraction introduced by "." or
# ",".  Nothing may follow ("\z", so a trailing newline is rejected too).
TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} ++[0-9]{1,2}+:[0-9]{2}:[0-9]{2}(?:[.,][0-9]++)?+\z"
TIMESTAMP_LAYOUT = "yyyy-MM-dd HH:mm:ss"


def strict_timestamp_sql(text: str) -> str:
    """SQL for :func:`strict_timestamp` over the SQL expression ``text``."""
    spaced = f"CASE WHEN contains({text}, '  ') THEN regexp_replace({text}, ' +', ' ') ELSE {text} END"
    dotted = f"CASE WHEN contains({text}, ',') THEN translate({spaced}, ',', '.') ELSE {spaced} END"
    return f"CASE WHEN {text} RLIKE r'{TIMESTAMP_SHAPE}' THEN try_cast({dotted} AS timestamp_ntz) END"


def strict_timestamp(text: str) -> Column:
    """Parse ``text`` into ``timestamp_ntz``; NULL when it is not a valid timestamp.

    The shape guard rejects what a plain cast would take (date only, ``T``,
    zones, a leading space, one-digit months).  Spaces are then collapsed and
    a ``,`` fraction separator becomes ``.`` (only when present), and the
    cast checks the calendar: month, day of month (Feb 29 only in leap
    years), hour < 24, second < 60.  Fractions beyond microseconds are
    truncated; the calendar day is unaffected.
    """
    return F.expr(strict_timestamp_sql(text))


def day_key(ts: str) -> Column:
    """Calendar day of a (UTC, zone-free) timestamp or date as ``yyyy-MM-dd`` text."""
    return F.expr(f"date_format({ts}, 'yyyy-MM-dd')")
