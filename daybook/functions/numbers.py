"""Strict text → double parsing (P4) and the amount range rule (F1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.  Decimal number text: optional sign, digits with an optional
# point (or a point followed by digits), optional exponent; nothing around it.
DECIMAL_BODY = r"[+-]?+(?:[0-9]++[.]?+[0-9]*+|[.][0-9]++)(?:[eE][+-]?+[0-9]++)?+"
DECIMAL_SHAPE = rf"^{DECIMAL_BODY}\z"
# The same with single underscores between digits.
_GROUPED = r"[0-9]++(?:_[0-9]++)*+"
GROUPED_SHAPE = rf"^[+-]?+(?:{_GROUPED}(?:[.](?:{_GROUPED})?+)?+|[.]{_GROUPED})(?:[eE][+-]?+{_GROUPED})?+\z"
# The words for infinity (optionally signed) and not-a-number, in any case.
INFINITY_WORD = r"^(?i)[+-]?inf(?:inity)?\z"
NAN_WORD = r"^(?i)nan\z"

# Fixed value: the largest accepted amount; negative amounts are rejected too.
MAX_VOLUME = 1e15


def _double(value: float) -> str:
    return f"double('{float(value)!r}')"


def finite_double_sql(decimal_text: str) -> str:
    """SQL: text already known to be decimal-shaped → double; NULL when it overflows."""
    return f"nullif(nullif(try_cast({decimal_text} AS double), double('inf')), double('-inf'))"


def strict_double_sql(text: str) -> str:
    """SQL for :func:`strict_double` over the SQL expression ``text``."""
    return (
        f"CASE WHEN {text} RLIKE r'{DECIMAL_SHAPE}' THEN {finite_double_sql(text)} "
        f"WHEN contains({text}, '_') AND {text} RLIKE r'{GROUPED_SHAPE}' "
        f"THEN {finite_double_sql(f"replace({text}, '_', '')")} "
        f"WHEN {text} RLIKE r'{INFINITY_WORD}' "
        f"THEN CASE WHEN startswith({text}, '-') THEN double('-inf') ELSE double('inf') END "
        f"WHEN {text} RLIKE r'{NAN_WORD}' THEN double('NaN') END"
    )


def strict_double(text: str) -> Column:
    """Parse ``text`` as a double; NULL when it is not a number.

    Decimal text that overflows a double (``1e400``) is NOT a number here (a
    range error), while the words ``inf``/``infinity`` are infinities and
    ``nan`` is NaN.  Single underscores may stand between digits (``1_000.5``).
    Surrounding spaces, type suffixes (``1d``) and hexadecimal floats are rejected.
    """
    return F.expr(strict_double_sql(text))


def outside_range_sql(value: str, max_volume: float = MAX_VOLUME) -> str:
    """SQL: the amount is negative or above ``max_volume`` (0 and max_volume pass).

    NaN compares greater than every number in Spark, so it is rejected here.
    """
    return f"({value} < 0D OR {value} > {_double(max_volume)})"


def outside_range(value: str, max_volume: float = MAX_VOLUME) -> Column:
    return F.expr(outside_range_sql(value, max_volume))


def fixed_point_text_sql(value: str) -> str:
    """SQL: ``%f`` text of a double, with ``+Inf`` / ``-Inf`` / ``NaN`` for the special values."""
    return (
        f"CASE WHEN isnan({value}) THEN 'NaN' WHEN {value} = double('inf') THEN '+Inf' "
        f"WHEN {value} = double('-inf') THEN '-Inf' ELSE format_string('%f', {value}) END"
    )


def fixed_point_text(value: str) -> Column:
    return F.expr(fixed_point_text_sql(value))
