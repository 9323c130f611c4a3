"""Adapters that present the shared parquet tables as transaction text rows.

The engine's input is raw transaction text (five string columns).  These
adapters derive such rows from the benchmark tables with fixed, deterministic
rules, including rows that must be rejected, so the whole pipeline can run on
data that grows with the scale factor.  The SQL oracles in
``daybook/plans/oracle.py`` state the same rules in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.clean import RAW_COLUMNS
from daybook.sources.balance import spread

# Symbol per event type, and the prices used with them.
EVENT_SYMBOLS = {"purchase": "USD", "click": "EUR", "view": "BTC", "signup": "SFL", "error": "MATIC"}
EVENT_PRICES = {"USD": 1.0, "EUR": 1.2, "BTC": 60000.0, "SFL": 0.05, "MATIC": 0.7}

# Prices for the lineitem symbols (return flag || line status).
LINEITEM_PRICES = {"AF": 1.0, "AO": 1.25, "NF": 0.5, "NO": 2.0, "RF": 1.5, "RO": 0.75}

# event_id moduli that turn an event into a bad row.
BAD_TS_MOD = 97
BAD_PROPS_MOD = 89
BAD_NUMS_JSON_MOD = 83
BAD_NUMS_TEXT_MOD = 79
NEGATIVE_MOD = 73
HUGE_MOD = 71
BARE_NUMBER_MOD = 67

# The header of the wide transaction export (16 columns).
WIDE_CSV_COLUMNS = (
    "app", "ts", "event", "project_id", "source", "ident", "user_id", "session_id", "country",
    "device_type", "device_os", "device_os_ver", "device_browser", "device_browser_ver", "props", "nums",
)

TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _amount(value: str) -> str:
    return f'{{"currencyValueDecimal": "{value}"}}'


_TS, _USD = "2024-01-01 00:00:00", '{"currencySymbol": "USD"}'
_BAD_TS, _BAD_NUMS, _BAD_PROPS = "invalid timestamp format", "invalid JSON format in Nums field", "invalid JSON format in Props field"
_BAD_VOLUME, _BAD_RANGE = "invalid volume format", "volume over threshold"

# Hard cases, one per event_id modulo their number.  Raw ts, nums and props, then what must come of
# them: the reason code, or NULL and the symbol and amount.  The outcomes are constants, so no parser is shared
# between the engine and the oracle.
TRAPS: tuple[tuple[str, str, str, str | None, str | None, float | None], ...] = (
    (_TS, _amount("1.5"), _USD, None, "USD", 1.5),
    (_TS, '{"x": 1, "currencyValueDecimal": "2.5", "y": [1, {"currencyValueDecimal": 3}]}', _USD, None, "USD", 2.5),
    (_TS, '{"CURRENCYVALUEDECIMAL": "3"}', _USD, None, "USD", 3.0),
    (_TS, '{"currencyValueDecimal": "1", "currencyValueDecimal": "4"}', _USD, None, "USD", 4.0),
    (_TS, '{"currencyValueDecimal": 5, "currencyValueDecimal": "4"}', _USD, _BAD_NUMS, None, None),
    (_TS, '{"currencyValueDecimal": "4", "CurrencyValueDecimal": 5}', _USD, _BAD_NUMS, None, None),
    (_TS, '{"currencyValueDecimal": "6", "currencyValueDecimal": null}', _USD, None, "USD", 6.0),
    (_TS, '{"currencyValueDecimal": "1", "CURRENCYvalueDECIMAL": "8"}', _USD, None, "USD", 8.0),
    (_TS, '{"currencyValueDecimal": null}', _USD, _BAD_VOLUME, None, None),
    (_TS, "null", _USD, _BAD_VOLUME, None, None),
    (_TS, "{}", _USD, _BAD_VOLUME, None, None),
    (_TS, '{"a": {"currencyValueDecimal": "1"}}', _USD, _BAD_VOLUME, None, None),
    (_TS, '{"currency\\u0056alueDecimal": "7"}', _USD, None, "USD", 7.0),
    (_TS, '{"currencyValueDecimal": "1"} x', _USD, _BAD_NUMS, None, None),
    (_TS, "{}{}", _USD, _BAD_NUMS, None, None),
    (_TS, '["currencyValueDecimal", "1"]', _USD, _BAD_NUMS, None, None),
    (_TS, '{"currencyValueDecimal": "1",}', _USD, _BAD_NUMS, None, None),
    (_TS, '{"x": 01, "currencyValueDecimal": "1"}', _USD, _BAD_NUMS, None, None),
    (_TS, "", _USD, _BAD_NUMS, None, None),
    (_TS, _amount("1"), '{"currencySymbol": "\\u0055SD"}', None, "USD", 1.0),
    (_TS, _amount("1"), '{"currencysymbol": "BTC", "n": null}', None, "BTC", 1.0),
    (_TS, _amount("1"), '{"currencySymbol": ["USD"]}', _BAD_PROPS, None, None),
    (_TS, _amount("1"), "'USD'", _BAD_PROPS, None, None),
    ("2024-01-01 00:00:00.250", _amount("1"), _USD, None, "USD", 1.0),
    ("2024-01-01 00:00:00,5", _amount("1"), _USD, None, "USD", 1.0),
    ("2024-01-01 3:04:05", _amount("1"), _USD, None, "USD", 1.0),
    ("2024-01-01   03:04:05", _amount("1"), _USD, None, "USD", 1.0),
    ("2024-02-29 00:00:00", _amount("1"), _USD, None, "USD", 1.0),
    ("2023-02-29 00:00:00", _amount("1"), _USD, _BAD_TS, None, None),
    ("2024-01-01", _amount("1"), _USD, _BAD_TS, None, None),
    ("2024-01-01T00:00:00", _amount("1"), _USD, _BAD_TS, None, None),
    (" 2024-01-01 00:00:00", _amount("1"), _USD, _BAD_TS, None, None),
    ("2024-01-01 24:00:00", _amount("1"), _USD, _BAD_TS, None, None),
    ("", "x", "x", _BAD_TS, None, None),
    (_TS, _amount("inf"), _USD, _BAD_RANGE, None, None),
    (_TS, _amount("NaN"), _USD, _BAD_RANGE, None, None),
    (_TS, _amount("1000000000000001"), _USD, _BAD_RANGE, None, None),
    (_TS, _amount("1e400"), _USD, _BAD_VOLUME, None, None),
    (_TS, _amount(" 1"), _USD, _BAD_VOLUME, None, None),
    (_TS, _amount("1d"), _USD, _BAD_VOLUME, None, None),
    (_TS, _amount("1__0"), _USD, _BAD_VOLUME, None, None),
    (_TS, _amount("1_000.5"), _USD, None, "USD", 1000.5),
    (_TS, _amount("+5"), _USD, None, "USD", 5.0),
    (_TS, _amount(".5"), _USD, None, "USD", 0.5),
    (_TS, _amount("5."), _USD, None, "USD", 5.0),
    (_TS, _amount("1e15"), _USD, None, "USD", 1e15),
    (_TS, _amount("0"), _USD, None, "USD", 0.0),
)


def table(spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...] | None = None,
          spread_scan: bool = True) -> DataFrame:
    """One shared table, pruned to ``columns`` and spread when its file arrives in too few splits."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return spread(df) if spread_scan else df


def nums_text(value_sql: str) -> str:
    return f"""concat('{{"currencyValueDecimal": "', {value_sql}, '"}}')"""


def props_text(symbol_sql: str) -> str:
    return f"""concat('{{"currencySymbol": "', {symbol_sql}, '"}}')"""


def _event_symbol(event_type: str) -> str:
    whens = " ".join(f"WHEN '{event}' THEN '{symbol}'" for event, symbol in EVENT_SYMBOLS.items())
    return f"CASE {event_type} {whens} END"


def _raw_select(df: DataFrame, *exprs: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The five raw columns from SQL texts (NULL becomes ""), plus ``keep`` columns."""
    return df.selectExpr(
        *[f"coalesce({sql}, '') AS {name}" for sql, name in zip(exprs, RAW_COLUMNS)], *keep
    )


def events_transactions(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``events`` as raw transactions, with deterministic bad rows (see module doc)."""
    e = table(spark, sf_dir, "events", ("event_id", "ts", "user_id", "event_type", "value"))
    ts = (f"CASE WHEN event_id % {BAD_TS_MOD} = 0 THEN 'invalid-timestamp' "
          f"ELSE date_format(ts, '{TS_TEXT}') END")
    props = (f"CASE WHEN event_id % {BAD_PROPS_MOD} = 0 THEN 'invalid-json' "
             f"ELSE {props_text(_event_symbol('event_type'))} END")
    nums = f"""CASE WHEN event_id % {BAD_NUMS_JSON_MOD} = 0 THEN 'invalid-json'
        WHEN event_id % {BAD_NUMS_TEXT_MOD} = 0 THEN {nums_text("'abc'")}
        WHEN event_id % {NEGATIVE_MOD} = 0 THEN {nums_text("'-100.0'")}
        WHEN event_id % {HUGE_MOD} = 0 THEN {nums_text("'1e20'")}
        WHEN event_id % {BARE_NUMBER_MOD} = 0 THEN '{{"currencyValueDecimal": 5}}'
        ELSE {nums_text('CAST(value AS string)')} END"""
    return _raw_select(e, ts, "CAST(user_id % 20 AS string)", "event_type", props, nums, keep=keep)


def events_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events adapter with the 11 extra columns of a full transaction export."""
    raw = events_transactions(spark, sf_dir, keep=("event_id", "user_id"))
    extra = {
        "app": "concat('app', event_id % 7)",
        "source": "''",
        "ident": "CAST(event_id AS string)",
        "user_id": "CAST(user_id AS string)",
        "session_id": "substr(sha2(CAST(event_id AS string), 256), 1, 16)",
        "country": "concat('C', user_id % 40)",
        "device_type": "concat('type ', event_id % 3)",
        "device_os": "concat('os ', event_id % 5)",
        "device_os_ver": "CAST(event_id % 11 AS string)",
        "device_browser": "concat('browser ', user_id % 4)",
        "device_browser_ver": "concat(event_id % 13, '.', user_id % 9)",
    }
    return raw.selectExpr(*[f"{extra.get(name, name)} AS {name}" for name in WIDE_CSV_COLUMNS])


def trap_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw transactions that run through :data:`TRAPS`, with ``event_id`` and, for every third one, no project."""
    def case(k: int) -> str:
        whens = " ".join(f"WHEN {n} THEN {sql_text(t[k])}" for n, t in enumerate(TRAPS))
        return f"CASE event_id % {len(TRAPS)} {whens} END"

    e = table(spark, sf_dir, "events", ("event_id", "user_id", "event_type"))
    project = "CASE WHEN event_id % 3 = 0 THEN '' ELSE concat(' P', user_id % 20, ' ') END"
    return _raw_select(e, case(0), project, "event_type", case(2), case(1), keep=("event_id",))


def sql_text(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as raw transactions: ship date, supplier bucket, flag+status symbol, price."""
    li = table(spark, sf_dir, "lineitem",
               ("l_shipdate", "l_suppkey", "l_returnflag", "l_linestatus", "l_extendedprice"))
    return _raw_select(
        li,
        f"date_format(l_shipdate, '{TS_TEXT}')",
        "CAST(l_suppkey % 50 AS string)",
        "'SHIP'",
        props_text("concat(l_returnflag, l_linestatus)"),
        nums_text("CAST(l_extendedprice AS string)"),
    )


def orders_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as raw transactions: order date, customer bucket, USD amount = total price."""
    o = table(spark, sf_dir, "orders", ("o_orderdate", "o_custkey", "o_orderstatus", "o_totalprice"))
    return _raw_select(
        o,
        f"date_format(o_orderdate, '{TS_TEXT}')",
        "CAST(o_custkey % 100 AS string)",
        "o_orderstatus",
        props_text("'USD'"),
        nums_text("CAST(o_totalprice AS string)"),
    )


def part_price_rows(spark: SparkSession, sf_dir: str, spread_scan: bool = True) -> DataFrame:
    """``part`` as price rows (ID, Symbol, Name, Price (USD)) plus the order ``p_partkey``."""
    p = table(spark, sf_dir, "part", ("p_partkey", "p_brand", "p_name", "p_retailprice"), spread_scan)
    return p.select(
        F.col("p_partkey").cast("string").alias("ID"),
        F.col("p_brand").alias("Symbol"),
        F.col("p_name").alias("Name"),
        F.col("p_retailprice").alias("Price (USD)"),
        F.col("p_partkey"),
    )
