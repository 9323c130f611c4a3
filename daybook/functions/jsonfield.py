"""Strict extraction of one text field from a JSON object held as text.

The rule is that of decoding the whole text into a record with a single text
field:

* the whole text must be exactly one JSON value (surrounding JSON white space
  allowed; trailing text, two concatenated values, single quotes, comments,
  ``NaN``, trailing commas or leading zeros are errors);
* that value must be an object or ``null``;
* every key equal to the field name, compared without case, must hold a string
  or ``null``; any other type is an error, also where a later key overrides it;
* the field value is the last such string in document order (a ``null`` leaves
  what an earlier key set), or ``""`` when there is none; other keys are ignored.

Spark's ``try_parse_json`` alone accepts trailing text, so the text is parsed
twice, once wrapped as an object member and once as an array element; only a
single JSON value survives both wraps.  A regular expression recognises the
common canonical form ``{"field": "text"}`` first, so most rows never reach
the JSON parser at all; a parsed document that names the field once is looked
up by path.  A parsed document keeps neither key order nor duplicates, so only
texts that name the field several times, in another case or with escapes are
read again as an ordered list of entries (lambdas).  Spark's JSON parser gives
up at about a thousand nested levels; such a document counts as not valid.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# JSON white space and the characters a plain JSON string may
# hold without escapes (no quote, no backslash, no control character).
_WS = r"[ \t\n\r]*+"
_PLAIN_VALUE = r'[^"\\\x00-\x1f]*+'


def canonical_pattern(field: str, value: str = _PLAIN_VALUE) -> str:
    """Regex for ``{"<field>": "<value>"}`` with optional white space; group 1 is the value.

    ``value`` is the pattern the text between the quotes must match (by
    default any plain JSON string content).
    """
    _checked_field(field)
    return rf'^{_WS}\{{{_WS}"{field}"{_WS}:{_WS}"({value})"{_WS}\}}{_WS}\z'


def parse_json_strict_sql(text: str) -> str:
    """SQL: the JSON value of ``text`` as a VARIANT; SQL NULL when ``text`` is not one JSON value.

    A JSON ``null`` document gives a variant null (``is_variant_null``), not SQL NULL.
    """
    as_element = f"try_parse_json(concat('[', {text}, ']'))"
    as_member = f"""try_parse_json(concat('{{"v":', {text}, '}}'))"""
    return f"CASE WHEN {as_element} IS NOT NULL THEN try_variant_get({as_member}, '$.v') END"


def parse_json_strict(text: str) -> Column:
    return F.expr(parse_json_strict_sql(text))


# The field of a valid document, from its entries in document order.
# ``transform(array(x), m -> ...)[0]`` binds a value to a name so it is computed once.
_FIELD_OF_TEXT = """
transform(array(filter(map_entries(from_json({text}, 'map<string,variant>')), e -> lower(e.key) = '{lower}')), m ->
  CASE WHEN m IS NOT NULL AND forall(m, e -> e.value IS NULL OR schema_of_variant(e.value) IN ('STRING', 'VOID'))
  THEN named_struct('ok', true, 'value', coalesce(
      try_element_at(filter(transform(m, e -> try_variant_get(e.value, '$', 'string')), v -> v IS NOT NULL), -1), ''))
  ELSE named_struct('ok', false, 'value', CAST(NULL AS string)) END)[0]
"""


def _checked_field(field: str) -> str:
    if not field.isidentifier():
        raise ValueError(f"field name must be a plain identifier: {field!r}")
    return field


def field_of_text_sql(text: str, field: str) -> str:
    """SQL: ``struct<ok, value>`` for ``field`` of a text that is one valid JSON value other than ``null``."""
    return _FIELD_OF_TEXT.format(text=text, lower=_checked_field(field).lower())


def times_named_sql(text: str, field: str) -> str:
    """SQL: how often the text names the field in quotes, in any case; 2 if an escape could hide a name."""
    return (f"CASE WHEN contains({text}, '\\\\u') THEN 2 "
            f"ELSE regexp_count({text}, '(?i)\"{_checked_field(field)}\"') END")


def canonical_value_sql(text: str, field: str, value: str = _PLAIN_VALUE) -> str:
    """SQL: the field value when ``text`` has the canonical one-key shape, else NULL.

    One anchored ``regexp_extract`` both checks the shape and cuts the value
    out.  An empty value also gives NULL here; such rows take the general path,
    which gets them right.  Materialise it as a column and pass that column to
    the later steps (:func:`field_lookup_sql`), so they read it instead of
    repeating it (repeated text also bloats the generated code).
    """
    return f"nullif(regexp_extract({text}, r'{canonical_pattern(field, value)}', 1), '')"


def exact_member_sql(doc: str, field: str) -> str:
    """SQL: the member ``field`` (exact spelling) of a parsed document as a VARIANT, else NULL."""
    return f"try_variant_get({doc}, '$.{_checked_field(field)}')"


def field_lookup_sql(fast: str, doc: str, exact: str, named: str) -> str:
    """SQL: ``struct<ok, value>`` from already materialised columns, without lambdas.

    ``fast`` holds the canonical value (or NULL), ``doc`` the strictly parsed
    document (NULL when the text is not one JSON value), ``exact`` the member
    with the exact spelling (:func:`exact_member_sql`) and ``named`` how often the
    text names the field (:func:`times_named_sql`).  ``ok`` is NULL where
    that does not decide: those rows need :func:`field_of_text_sql`.
    """
    empty, text_of_exact = "''", f"coalesce(try_variant_get({exact}, '$', 'string'), '')"

    def struct(ok: str, value: str) -> str:
        return f"named_struct('ok', CAST({ok} AS boolean), 'value', CAST({value} AS string))"

    return (
        f"CASE WHEN {fast} IS NOT NULL THEN {struct('true', fast)} "
        f"WHEN {doc} IS NULL THEN {struct('false', 'NULL')} "
        f"WHEN is_variant_null({doc}) THEN {struct('true', empty)} "
        f"WHEN NOT startswith(schema_of_variant({doc}), 'OBJECT') THEN {struct('false', 'NULL')} "
        f"WHEN {named} = 0 THEN {struct('true', empty)} "
        f"WHEN {named} > 1 OR {exact} IS NULL THEN {struct('NULL', 'NULL')} "
        f"WHEN schema_of_variant({exact}) IN ('STRING', 'VOID') "
        f"THEN {struct('true', text_of_exact)} "
        f"ELSE {struct('false', 'NULL')} END"
    )


def field_resolve_sql(lookup: str, text: str, field: str) -> str:
    """SQL: the final ``struct<ok, value>``; the entries are read only where ``lookup.ok`` is NULL."""
    return f"CASE WHEN {lookup}.ok IS NOT NULL THEN {lookup} ELSE {field_of_text_sql(text, field)} END"


def json_string_field(text: str, field: str) -> Column:
    """``struct<ok: boolean, value: string>`` for ``field`` of the JSON text ``text``.

    ``ok`` is false when the text is not valid for the rule in the module
    doc; ``value`` is then NULL.  NULL text is not ok.  Inside a pipeline the
    steps are split into columns (see ``operators.clean.classify``) so that
    each is computed once per row; this one-expression form is for ad hoc use.
    """
    fast = canonical_value_sql(text, field)
    doc = f"CASE WHEN ({fast}) IS NULL THEN {parse_json_strict_sql(text)} END"
    lookup = field_lookup_sql("s.f", "s.d", exact_member_sql("s.d", field), "s.n")
    return F.expr(
        f"transform(array(named_struct('f', {fast}, 'd', {doc}, 'n', {times_named_sql(text, field)})), s -> "
        f"transform(array({lookup}), l -> {field_resolve_sql('l', text, field)})[0])[0]"
    )
