"""Column-level functions.

Each function has a ``*_sql`` twin that returns Spark SQL text; the plain
function wraps it in a single ``F.expr`` call.  Everything stays JVM-side.
"""

from daybook.functions.jsonfield import (
    canonical_value_sql,
    exact_member_sql,
    field_lookup_sql,
    field_of_text_sql,
    field_resolve_sql,
    json_string_field,
    parse_json_strict,
    parse_json_strict_sql,
    times_named_sql,
)
from daybook.functions.numbers import (
    MAX_VOLUME,
    fixed_point_text,
    fixed_point_text_sql,
    outside_range,
    outside_range_sql,
    strict_double,
    strict_double_sql,
)
from daybook.functions.timestamps import day_key, strict_timestamp, strict_timestamp_sql

__all__ = [
    "MAX_VOLUME",
    "canonical_value_sql",
    "day_key",
    "exact_member_sql",
    "field_lookup_sql",
    "field_of_text_sql",
    "field_resolve_sql",
    "fixed_point_text",
    "fixed_point_text_sql",
    "json_string_field",
    "outside_range",
    "outside_range_sql",
    "parse_json_strict",
    "parse_json_strict_sql",
    "strict_double",
    "strict_double_sql",
    "strict_timestamp",
    "strict_timestamp_sql",
    "times_named_sql",
]
