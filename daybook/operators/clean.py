"""Validation of raw transactions: clean rows and dead letters.

Each raw row (five text columns, never NULL) goes to exactly one of two
outputs.  The checks run in a fixed order and the first failure names the
reason:

1. ``ts`` is a strict ``yyyy-MM-dd HH:mm:ss`` timestamp,
2. ``nums`` is a JSON object whose ``currencyValueDecimal`` is text,
3. ``props`` is a JSON object whose ``currencySymbol`` is text,
4. that amount text is a decimal number,
5. the amount lies in ``[0, max_volume]``.

All parsing happens once per row: the expensive expressions are computed in
projections placed below a one-row generator (:func:`evaluate_once`).  Catalyst
pushes filters through projections by inlining their expressions, so without
that barrier a filter on the reason would evaluate every parse a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import (
    MAX_VOLUME,
    fixed_point_text_sql,
    canonical_value_sql,
    exact_member_sql,
    field_lookup_sql,
    field_resolve_sql,
    parse_json_strict_sql,
    times_named_sql,
    outside_range_sql,
    strict_double_sql,
    strict_timestamp_sql,
)
from daybook.functions.numbers import DECIMAL_BODY, finite_double_sql
from daybook.functions.timestamps import TIMESTAMP_LAYOUT

RAW_COLUMNS = ("ts", "project_id", "event", "props", "nums")
CLEAN_COLUMNS = ("ts", "project_id", "currency_symbol", "volume")
DEAD_LETTER_COLUMNS = ("Reason",) + RAW_COLUMNS

# The rejection categories (the start of every Reason text).
INVALID_TIMESTAMP = "invalid timestamp format"
INVALID_NUMS_JSON = "invalid JSON format in Nums field"
INVALID_PROPS_JSON = "invalid JSON format in Props field"
INVALID_VOLUME = "invalid volume format"
OVER_THRESHOLD = "volume over threshold"
UNKNOWN_CURRENCY = "currency symbol not supported"
MALFORMED_ROW = "malformed CSV row"

# The JSON keys read from the two payload columns.
NUMS_FIELD = "currencyValueDecimal"
PROPS_FIELD = "currencySymbol"


def evaluate_once(df: DataFrame, **columns: str) -> DataFrame:
    """Append ``columns`` (name → SQL text) to ``df``, each evaluated exactly once per row.

    A generator over a one-element array is a plan boundary filters are not
    pushed through, so expressions above it read the materialised values.
    """
    fields = ", ".join(f"'{name}', {sql}" for name, sql in columns.items())
    return df.select("*", F.expr(f"inline(array(named_struct({fields})))"))


def _quoted(sql: str) -> str:
    return f"""concat('"', {sql}, '"')"""


def classify(raw: DataFrame, max_volume: float = MAX_VOLUME) -> DataFrame:
    """Add parsed values and the rejection reason to every raw row.

    Adds ``_ts`` (timestamp_ntz), ``_nums`` / ``_props`` (struct ok, value),
    ``_volume`` (double), ``reason_code`` (NULL for a clean row) and
    ``Reason`` (category plus detail).  All input columns are kept.

    Layers, each computed once per row:

    1. canonical payload values by one anchored regex per field (for the
       amount, a decimal-shaped capture is tried first);
    2. only for other payloads, the strict JSON parse and the member with the
       exact key spelling, resolved without lambdas;
    3. a one-row generator (a filter barrier) over these and the timestamp; only
       texts that name a field several times, in another case or with escapes
       go through the ordered entries, which use lambdas;
    4. a second generator with the values and the reason, so that the filters
       and projections of callers read plain columns inside generated code.
    """
    cut = raw.select(
        "*",
        F.expr(canonical_value_sql("nums", NUMS_FIELD, DECIMAL_BODY)).alias("_nums_num"),
        F.expr(canonical_value_sql("props", PROPS_FIELD)).alias("_props_fast"),
    )
    # Any other canonical amount text is tried only where the decimal form failed.
    plain = cut.select(
        "*",
        F.expr(f"CASE WHEN _nums_num IS NULL THEN {canonical_value_sql('nums', NUMS_FIELD)} END")
        .alias("_nums_plain"),
    )
    docs = plain.select(
        "*",
        F.expr("coalesce(_nums_num, _nums_plain)").alias("_nums_fast"),
        F.expr(f"CASE WHEN _nums_num IS NULL AND _nums_plain IS NULL THEN {parse_json_strict_sql('nums')} END")
        .alias("_nums_doc"),
        F.expr(f"CASE WHEN _props_fast IS NULL THEN {parse_json_strict_sql('props')} END").alias("_props_doc"),
    )
    members = docs.select(
        "*",
        F.expr(exact_member_sql("_nums_doc", NUMS_FIELD)).alias("_nums_exact"),
        F.expr(exact_member_sql("_props_doc", PROPS_FIELD)).alias("_props_exact"),
        F.expr(f"CASE WHEN _nums_doc IS NOT NULL THEN {times_named_sql('nums', NUMS_FIELD)} END").alias("_nums_named"),
        F.expr(f"CASE WHEN _props_doc IS NOT NULL THEN {times_named_sql('props', PROPS_FIELD)} END").alias("_props_named"),
    )
    scanned = evaluate_once(
        members, _ts=strict_timestamp_sql("ts"),
        _nums_look=field_lookup_sql("_nums_fast", "_nums_doc", "_nums_exact", "_nums_named"),
        _props_look=field_lookup_sql("_props_fast", "_props_doc", "_props_exact", "_props_named"))
    resolved = scanned.select(
        *raw.columns, "_ts", "_nums_num",
        F.expr(field_resolve_sql("_nums_look", "nums", NUMS_FIELD)).alias("_nums"),
        F.expr(field_resolve_sql("_props_look", "props", PROPS_FIELD)).alias("_props"),
    )
    amount = (f"CASE WHEN _nums_num IS NOT NULL THEN {finite_double_sql('_nums_num')} "
              f"ELSE {strict_double_sql('_nums.value')} END")
    valued = resolved.select(*raw.columns, "_ts", "_nums", "_props", F.expr(amount).alias("_volume"))
    code = f"""CASE WHEN _ts IS NULL THEN '{INVALID_TIMESTAMP}'
        WHEN NOT _nums.ok THEN '{INVALID_NUMS_JSON}'
        WHEN NOT _props.ok THEN '{INVALID_PROPS_JSON}'
        WHEN _volume IS NULL THEN '{INVALID_VOLUME}'
        WHEN {outside_range_sql('_volume', max_volume)} THEN '{OVER_THRESHOLD}' END"""
    detail = f"""CASE WHEN _ts IS NULL THEN concat('cannot parse ', {_quoted('ts')}, ' as "{TIMESTAMP_LAYOUT}"')
        WHEN NOT _nums.ok THEN 'not a JSON object with a text "{NUMS_FIELD}"'
        WHEN NOT _props.ok THEN 'not a JSON object with a text "{PROPS_FIELD}"'
        WHEN _volume IS NULL THEN concat('cannot parse ', {_quoted('_nums.value')}, ' as a number')
        ELSE {fixed_point_text_sql('_volume')} END"""
    # The reason and the values read below come out of one generator.
    coded = valued.select("*", F.expr(code).alias("_code"))
    out = evaluate_once(
        coded.select(*raw.columns, F.col("_ts").alias("_t"), F.col("_nums").alias("_n"), F.col("_props").alias("_p"),
                     F.col("_volume").alias("_v"), "_code",
                     F.expr(f"CASE WHEN _code IS NOT NULL THEN concat(_code, ': ', {detail}) END").alias("_reason")),
        _ts="_t", _nums="_n", _props="_p", _volume="_v", reason_code="_code", Reason="_reason")
    return out.select(*raw.columns, "_ts", "_nums", "_props", "_volume", "reason_code", "Reason")


def clean_rows(classified: DataFrame, keep: tuple[str, ...] = (), keep_raw: bool = False) -> DataFrame:
    """Clean transactions of a :func:`classify` result: ts, project_id, currency_symbol, volume.

    ``keep`` names extra input columns to carry along; ``keep_raw`` adds the
    raw text columns as ``raw_<name>`` (for dead letters raised later).
    """
    raw = [F.col(c).alias(f"raw_{c}") for c in RAW_COLUMNS] if keep_raw else []
    return classified.where(F.col("reason_code").isNull()).select(
        F.col("_ts").alias("ts"),
        "project_id",
        F.col("_props.value").alias("currency_symbol"),
        F.col("_volume").alias("volume"),
        *keep,
        *raw,
    )


def rejected_rows(classified: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Dead letters of a :func:`classify` result: Reason, the raw row, and reason_code."""
    return classified.where(F.col("reason_code").isNotNull()).select(
        *DEAD_LETTER_COLUMNS, "reason_code", *keep
    )


def clean(
    raw: DataFrame, max_volume: float = MAX_VOLUME, keep: tuple[str, ...] = (), keep_raw: bool = False
) -> DataFrame:
    """Raw transactions → clean transactions (rejected rows dropped)."""
    return clean_rows(classify(raw, max_volume), keep, keep_raw)


def dead_letters(raw: DataFrame, max_volume: float = MAX_VOLUME, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw transactions → rejected rows with their reason."""
    return rejected_rows(classify(raw, max_volume), keep)


def reject_counts(raw: DataFrame, max_volume: float = MAX_VOLUME) -> DataFrame:
    """Row count per outcome: one row per rejection category plus ``clean``."""
    return (
        classify(raw, max_volume)
        .groupBy(F.coalesce(F.col("reason_code"), F.lit("clean")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
