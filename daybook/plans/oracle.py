"""DuckDB SQL for every registered query, written independently of the Spark code.

The tables ``events lineitem orders part ...`` are DuckDB views over the same
parquet files.  The adapters and the validation rules are restated here in
plain SQL; only the fixed constants are shared.
"""

from __future__ import annotations

from daybook.plans import queries as Q
from daybook.sources import tables as T


def _values(prices: dict[str, float]) -> str:
    rows = ", ".join(f"('{s}', CAST({p!r} AS DOUBLE))" for s, p in prices.items())
    return f"(VALUES {rows}) AS p(symbol, price)"


def _symbol_case(col: str) -> str:
    whens = " ".join(f"WHEN '{e}' THEN '{s}'" for e, s in T.EVENT_SYMBOLS.items())
    return f"CASE {col} {whens} END"


EVENTS_RAW = f"""
SELECT event_id,
  COALESCE(CASE WHEN event_id % {T.BAD_TS_MOD} = 0 THEN 'invalid-timestamp'
                ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END, '') AS ts,
  COALESCE(CAST(user_id % 20 AS VARCHAR), '') AS project_id,
  COALESCE(event_type, '') AS event,
  COALESCE(CASE WHEN event_id % {T.BAD_PROPS_MOD} = 0 THEN 'invalid-json'
                ELSE '{{"currencySymbol": "' || {_symbol_case('event_type')} || '"}}' END, '') AS props,
  COALESCE(CASE WHEN event_id % {T.BAD_NUMS_JSON_MOD} = 0 THEN 'invalid-json'
                WHEN event_id % {T.BAD_NUMS_TEXT_MOD} = 0 THEN '{{"currencyValueDecimal": "abc"}}'
                WHEN event_id % {T.NEGATIVE_MOD} = 0 THEN '{{"currencyValueDecimal": "-100.0"}}'
                WHEN event_id % {T.HUGE_MOD} = 0 THEN '{{"currencyValueDecimal": "1e20"}}'
                WHEN event_id % {T.BARE_NUMBER_MOD} = 0 THEN '{{"currencyValueDecimal": 5}}'
                ELSE '{{"currencyValueDecimal": "' || CAST(value AS VARCHAR) || '"}}' END, '') AS nums
FROM events
"""

LINEITEM_RAW = """
SELECT
  COALESCE(strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), '') AS ts,
  COALESCE(CAST(l_suppkey % 50 AS VARCHAR), '') AS project_id,
  'SHIP' AS event,
  COALESCE('{"currencySymbol": "' || l_returnflag || l_linestatus || '"}', '') AS props,
  COALESCE('{"currencyValueDecimal": "' || CAST(l_extendedprice AS VARCHAR) || '"}', '') AS nums
FROM lineitem
"""

ORDERS_RAW = """
SELECT
  COALESCE(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '') AS ts,
  COALESCE(CAST(o_custkey % 100 AS VARCHAR), '') AS project_id,
  COALESCE(o_orderstatus, '') AS event,
  '{"currencySymbol": "USD"}' AS props,
  COALESCE('{"currencyValueDecimal": "' || CAST(o_totalprice AS VARCHAR) || '"}', '') AS nums
FROM orders
"""

TS_RE = "[0-9]{4}-[0-9]{2}-[0-9]{2} +[0-9]{1,2}:[0-9]{2}:[0-9]{2}([.,][0-9]+)?"
NUM_RE = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def _json_ok(col: str, key: str) -> str:
    return (
        f"(CASE WHEN json_valid({col}) AND json_type({col}) IN ('OBJECT', 'NULL') "
        f"THEN COALESCE(json_type({col}, '$.{key}') IN ('VARCHAR', 'NULL'), TRUE) ELSE FALSE END)"
    )


def classified(raw_sql: str, max_volume: float) -> str:
    """raw rows + parsed values + reason_code + Reason, as nested SELECTs."""
    return f"""
SELECT *,
  CASE WHEN parsed_ts IS NULL THEN 'invalid timestamp format'
       WHEN NOT nums_ok THEN 'invalid JSON format in Nums field'
       WHEN NOT props_ok THEN 'invalid JSON format in Props field'
       WHEN volume IS NULL THEN 'invalid volume format'
       WHEN volume < 0 OR volume > {max_volume!r} OR isnan(volume) THEN 'volume over threshold'
  END AS reason_code,
  CASE WHEN parsed_ts IS NULL THEN 'invalid timestamp format: cannot parse "' || ts || '" as "yyyy-MM-dd HH:mm:ss"'
       WHEN NOT nums_ok THEN 'invalid JSON format in Nums field: not a JSON object with a text "currencyValueDecimal"'
       WHEN NOT props_ok THEN 'invalid JSON format in Props field: not a JSON object with a text "currencySymbol"'
       WHEN volume IS NULL THEN 'invalid volume format: cannot parse "' || amount_text || '" as a number'
       WHEN volume < 0 OR volume > {max_volume!r} OR isnan(volume) THEN 'volume over threshold: ' || printf('%f', volume)
  END AS Reason
FROM (
  SELECT *,
    CASE WHEN regexp_full_match(amount_text, '{NUM_RE}') AND NOT isinf(TRY_CAST(amount_text AS DOUBLE))
         THEN TRY_CAST(amount_text AS DOUBLE) END AS volume
  FROM (
    SELECT r.*,
      CASE WHEN regexp_full_match(ts, '{TS_RE}')
           THEN TRY_CAST(replace(regexp_replace(ts, ' +', ' ', 'g'), ',', '.') AS TIMESTAMP) END AS parsed_ts,
      {_json_ok('nums', 'currencyValueDecimal')} AS nums_ok,
      CASE WHEN {_json_ok('nums', 'currencyValueDecimal')}
           THEN COALESCE(nums ->> '$.currencyValueDecimal', '') END AS amount_text,
      {_json_ok('props', 'currencySymbol')} AS props_ok,
      CASE WHEN {_json_ok('props', 'currencySymbol')}
           THEN COALESCE(props ->> '$.currencySymbol', '') END AS symbol
    FROM ({raw_sql}) r
  ) a
) b
"""


EVENTS_CLASSIFIED = classified(EVENTS_RAW, 1e15)
EVENTS_CLEAN = f"SELECT * FROM ({EVENTS_CLASSIFIED}) c WHERE reason_code IS NULL"


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"


def _csv_field(column: str) -> str:
    return f"""'"' || replace({column}, '"', '""') || '"'"""


def _csv_line(columns: list[str]) -> str:
    return " || ',' || ".join(_csv_field(c) for c in columns)


def _malformed() -> str:
    """The damaged export: what is left whole, and the text of what is not."""
    columns = list(T.WIDE_CSV_COLUMNS)
    lost, extra = f"event_id % {Q.LOST_FIELD_MOD} = 0", f"event_id % {Q.EXTRA_FIELD_MOD} = 0"
    stray = f"(event_id % {Q.STRAY_QUOTE_MOD} = 0 AND event_id % {Q.LINE_BREAK_MOD} <> 0)"

    def line(order: list[str]) -> str:
        return (f"CASE WHEN {lost} THEN {_csv_line(order[:-1])} WHEN {extra} THEN {_csv_line(order)} || ',\"more\"' "
                f"ELSE 'x' || {_csv_line(order)} END")

    bad = f"CASE WHEN (event_id // {Q.STAGED_ROWS}) % 2 = 0 THEN {line(columns)} ELSE {line(columns[::-1])} END"
    whole = f"NOT ({lost}) AND NOT ({extra}) AND NOT {stray}"
    texts = ", ".join(f"CASE WHEN {whole} THEN {c} ELSE '' END AS {c}" for c in ("ts", "project_id", "event", "props", "nums"))
    return f"""
SELECT CASE WHEN {whole} THEN '' ELSE 'malformed CSV row: ' || {bad} END AS Reason, {texts}
FROM (SELECT r.event_id, r.ts, r.project_id, r.props, r.nums,
        CASE WHEN r.event_id % {Q.LINE_BREAK_MOD} = 0 THEN r.event || chr(10) || 'again' ELSE r.event END AS event,
        'app' || r.event_id % 7 AS app, '' AS source, CAST(r.event_id AS VARCHAR) AS ident,
        CAST(e.user_id AS VARCHAR) AS user_id, substr(sha256(CAST(r.event_id AS VARCHAR)), 1, 16) AS session_id,
        'C' || e.user_id % 40 AS country, 'type ' || r.event_id % 3 AS device_type, 'os ' || r.event_id % 5 AS device_os,
        CAST(r.event_id % 11 AS VARCHAR) AS device_os_ver, 'browser ' || e.user_id % 4 AS device_browser,
        (r.event_id % 13) || '.' || (e.user_id % 9) AS device_browser_ver
      FROM ({EVENTS_RAW}) r JOIN events e USING (event_id)) w
"""


def _traps() -> str:
    rows = ", ".join(f"({k}, {_text(t[3])}, {_text(t[4])}, {'CAST(NULL AS DOUBLE)' if t[5] is None else f'CAST({t[5]!r} AS DOUBLE)'})"
                     for k, t in enumerate(T.TRAPS))
    return f"""
SELECT event_id, reason_code,
       CASE WHEN reason_code IS NULL THEN CASE WHEN event_id % 3 = 0 THEN '' ELSE ' P' || user_id % 20 || ' ' END END AS project_id,
       symbol, volume
FROM events JOIN (VALUES {rows}) AS t(k, reason_code, symbol, volume) ON event_id % {len(T.TRAPS)} = k
"""


def _blank_project(sql: str) -> str:
    return (f"SELECT * REPLACE (repeat(' ', CAST(project_id AS INT) % 3) || project_id || "
            f"repeat(' ', CAST(project_id AS INT) % 2) AS project_id) FROM ({sql}) q")


KNOWN = "('USD', 'EUR', 'BTC', 'SFL')"


def _counters() -> str:
    """Counts of the whole run in each mode and sink."""
    facts = f"""
WITH c AS (SELECT *, reason_code IS NULL AS ok FROM ({EVENTS_CLASSIFIED}) x),
f AS (SELECT count(*) AS rows_read, count(*) FILTER (ok) AS clean, count(*) FILTER (ok AND symbol IN {KNOWN}) AS priced,
  count(DISTINCT (strftime(parsed_ts, '%Y-%m-%d'), project_id)) FILTER (ok) AS groups_all,
  count(DISTINCT (strftime(parsed_ts, '%Y-%m-%d'), project_id)) FILTER (ok AND symbol IN {KNOWN}) AS groups_priced FROM c)"""
    part = ("SELECT '{}' AS mode, '{}' AS sink, rows_read, CAST({} AS BIGINT) AS prices_read, {} AS clean_rows, "
            "rows_read - {} AS rejected_rows, {} AS aggregates_written FROM f")
    n = len(T.EVENT_PRICES)
    return facts + " UNION ALL ".join([
        part.format("fail", "csv", n, "clean", "clean", "groups_all"),
        part.format("fail", "table", n, "clean", "clean", "groups_all"),
        part.format("dead_letter", "csv", n - 1, "priced", "priced", "groups_priced")])


def _daily(clean_sql: str, prices: dict[str, float], places: int) -> str:
    return f"""
SELECT strftime(c.parsed_ts, '%Y-%m-%d') AS Date, c.project_id AS ProjectId,
       count(*) AS NumberOfTransactions, round(sum(p.price * c.volume), {places}) AS TotalVolumeUsd
FROM ({clean_sql}) c JOIN {_values(prices)} ON c.symbol = p.symbol
GROUP BY 1, 2
"""


DEAD_COLS = "Reason, ts, project_id, event, props, nums, reason_code"

# Price pages of part rows, one of which lacks a coin, up to the first short page.
PAGED = f"""
WITH coin AS (SELECT p_partkey // {Q.PAGE_SIZE} AS page, CAST(p_partkey AS VARCHAR) AS ID, lower(p_brand) AS Symbol,
                     p_name AS Name, p_retailprice AS price_usd FROM part
              WHERE NOT (p_partkey // {Q.PAGE_SIZE} = {Q.SHORT_PAGE} AND p_partkey % {Q.PAGE_SIZE} = {Q.LOST_COIN})),
short AS (SELECT min(page) AS last FROM (SELECT page FROM coin GROUP BY page HAVING count(*) < {Q.PAGE_SIZE}) s)
SELECT * FROM coin WHERE page <= coalesce((SELECT last FROM short), page)
"""

# Exact sums: every product is a whole number of 2^-70, summed as HUGEINT and rounded once, by way of text.
EXACT = f"""
SELECT strftime(c.parsed_ts, '%Y-%m-%d') AS Date, c.project_id AS ProjectId, count(*) AS NumberOfTransactions,
       CAST(CAST(sum(CAST(p.price * c.volume * pow(2, 70) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / pow(2, 70) AS TotalVolumeUsd
FROM ({EVENTS_CLEAN}) c JOIN {_values(T.EVENT_PRICES)} ON c.symbol = p.symbol
GROUP BY 1, 2
"""

SQL = {
    "daily_volume": _daily(EVENTS_CLEAN, T.EVENT_PRICES, Q.EVENT_USD_PLACES),
    "daily_volume_lineitem": _daily(
        f"SELECT * FROM ({classified(LINEITEM_RAW, 1e15)}) c WHERE reason_code IS NULL",
        T.LINEITEM_PRICES, Q.LINEITEM_USD_PLACES,
    ),
    "parse_timestamp": f"SELECT ts, strftime(parsed_ts, '%Y-%m-%d %H:%M:%S') AS parsed_ts FROM ({EVENTS_CLASSIFIED}) c",
    "extract_nums": f"SELECT nums, nums_ok AS json_ok, amount_text FROM ({EVENTS_CLASSIFIED}) c",
    "extract_props": f"SELECT props, props_ok AS json_ok, symbol FROM ({EVENTS_CLASSIFIED}) c",
    "parse_volume": f"SELECT amount_text, volume FROM ({EVENTS_CLASSIFIED}) c WHERE nums_ok",
    "clean_transactions": (
        "SELECT strftime(parsed_ts, '%Y-%m-%d %H:%M:%S') AS ts, project_id, symbol AS currency_symbol, volume "
        f"FROM ({EVENTS_CLEAN}) c"
    ),
    "dead_letters": f"SELECT {DEAD_COLS} FROM ({EVENTS_CLASSIFIED}) c WHERE reason_code IS NOT NULL",
    "reject_counts": (
        f"SELECT COALESCE(reason_code, 'clean') AS outcome, count(*) AS n_rows FROM ({EVENTS_CLASSIFIED}) c GROUP BY 1"
    ),
    "volume_outliers": (
        f"SELECT {DEAD_COLS} FROM ({classified(ORDERS_RAW, Q.ORDER_MAX_VOLUME)}) c WHERE reason_code IS NOT NULL"
    ),
    "usd_lookup": f"""
SELECT strftime(c.parsed_ts, '%Y-%m-%d %H:%M:%S') AS ts, c.project_id, c.symbol AS currency_symbol, c.volume,
       p.price, round(p.price * c.volume, {Q.EVENT_USD_PLACES}) AS usd
FROM ({EVENTS_CLEAN}) c JOIN {_values(T.EVENT_PRICES)} ON c.symbol = p.symbol
""",
    "unknown_currency": f"""
SELECT 'currency symbol not supported: ' || c.symbol AS Reason, c.ts, c.project_id, c.event, c.props, c.nums,
       'currency symbol not supported' AS reason_code
FROM ({EVENTS_CLEAN}) c
WHERE c.symbol NOT IN ({", ".join(f"'{s}'" for s in T.EVENT_PRICES if s != "MATIC")})
""",
    "merge_partials": _daily(EVENTS_CLEAN, T.EVENT_PRICES, Q.EVENT_USD_PLACES),
    "scan_project": f"SELECT ts, project_id, event, props, nums FROM ({EVENTS_RAW}) r",
    "price_last_wins": (
        "SELECT upper(p_brand) AS symbol, arg_max(p_retailprice, p_partkey) AS price FROM part GROUP BY 1"
    ),
    "csv_round_trip": _daily(_blank_project(EVENTS_CLEAN), T.EVENT_PRICES, Q.EVENT_USD_PLACES),
    "dead_letter_round_trip": (
        "SELECT Reason, ts, project_id, event || chr(10) || ' \"next\", line ' AS event, props, nums "
        f"FROM ({_blank_project(EVENTS_CLASSIFIED)}) c WHERE reason_code IS NOT NULL"
    ),
    "malformed_rows": _malformed(),
    "price_quoted_lines": (
        "SELECT CAST(p_partkey AS VARCHAR) AS ID, p_brand AS Symbol, p_retailprice AS price_usd, "
        "CASE WHEN p_partkey % 3 = 0 THEN p_name || chr(10) || '\"second\", ' || p_name ELSE p_name END AS Name FROM part"
    ),
    "trap_rows": _traps(),
    "table_append": f"""
SELECT strftime(c.parsed_ts, '%Y-%m-%d') AS Date, c.project_id AS ProjectId,
       count(*) AS NumberOfTransactions, round(sum(p.price * c.volume), {Q.EVENT_USD_PLACES}) AS TotalVolumeUsd,
       count(DISTINCT c.event_id % 2) AS n_rows
FROM ({EVENTS_CLEAN}) c JOIN {_values(T.EVENT_PRICES)} ON c.symbol = p.symbol
GROUP BY 1, 2
""",
    "price_snapshot": f"SELECT ID, Symbol, Name, price_usd, count(*) OVER () AS n_written FROM ({PAGED}) q",
    "run_counters": _counters(),
    "unknown_abort": "SELECT 'currency symbol not supported: MATIC' AS message",
    "stream_dead_letters": f"""
SELECT {DEAD_COLS} FROM ({EVENTS_CLASSIFIED}) c WHERE reason_code IS NOT NULL
UNION ALL
SELECT 'currency symbol not supported: ' || symbol AS Reason, ts, project_id, event, props, nums,
  'currency symbol not supported' AS reason_code
FROM ({EVENTS_CLEAN}) c WHERE symbol NOT IN {KNOWN}
""",
    "partitioned_table": _daily(EVENTS_CLEAN, T.EVENT_PRICES, Q.EVENT_USD_PLACES),
    "stream_daily_volume": _daily(EVENTS_CLEAN, T.EVENT_PRICES, Q.EVENT_USD_PLACES),
    "price_pages": f"SELECT ID, Symbol, Name, price_usd FROM ({PAGED}) q",
    "job_daily_volume": _daily(EVENTS_CLEAN, T.EVENT_PRICES, Q.EVENT_USD_PLACES),
    "job_dead_letters": f"""
SELECT Reason, ts, project_id, event, props, nums FROM ({EVENTS_CLASSIFIED}) c WHERE reason_code IS NOT NULL
UNION ALL
SELECT 'currency symbol not supported: ' || symbol AS Reason, ts, project_id, event, props, nums
FROM ({EVENTS_CLEAN}) c WHERE symbol NOT IN ({", ".join(f"'{s}'" for s in T.EVENT_PRICES if s != "MATIC")})
""",
    "replicate": _daily(
        f"SELECT * FROM ({classified(f'SELECT r.* FROM ({EVENTS_RAW}) r, range({Q.REPLICAS}) t', 1e15)}) c "
        "WHERE reason_code IS NULL",
        T.EVENT_PRICES, Q.EVENT_USD_PLACES,
    ),
    "daily_volume_exact": EXACT,
    "stream_running_reduce": EXACT,
    "stream_price_versions": f"""
SELECT *, '{Q.LATE_SYMBOL}' AS stopped_at, 1 AS price_version FROM ({_daily(EVENTS_CLEAN, T.EVENT_PRICES, Q.EVENT_USD_PLACES)}) q
""",
    "table_rerun": f"""
SELECT strftime(c.parsed_ts, '%Y-%m-%d') AS Date, c.project_id AS ProjectId, count(*) AS NumberOfTransactions,
       round(sum(p.price * c.volume), {Q.EVENT_USD_PLACES}) AS TotalVolumeUsd,
       CASE WHEN c.event_id % 2 = 0 THEN 'A' ELSE 'B' END AS run_id
FROM ({EVENTS_CLEAN}) c JOIN {_values(T.EVENT_PRICES)} ON c.symbol = p.symbol
GROUP BY 1, 2, 5
""",
    "row_count_batches": f"""
SELECT (k - 1) // {Q.BATCH_ROWS} AS batch_id, count(*) AS n_rows, min(event_id) AS first_event, max(event_id) AS last_event
FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS k FROM events) e GROUP BY 1
""",
}
