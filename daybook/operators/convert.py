"""USD conversion through the price lookup.

A transaction's symbol is matched exactly as written (case-sensitive) against
the upper-cased lookup symbols.  A symbol with no price either aborts the job
(``on_unknown="fail"``, the default) or becomes a dead letter
(``on_unknown="dead_letter"``).

The lookup is broadcast only after its bytes are summed and found small
(:func:`fits_broadcast`); otherwise a shuffle join is planned and AQE's skew
handling splits a hot symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.clean import RAW_COLUMNS, UNKNOWN_CURRENCY

# Largest lookup broadcast to every executor, in bytes of (symbol, price).
MAX_BROADCAST_BYTES = 16 << 20
ROW_BYTES = 32                  # a price and the row's own overhead
ON_UNKNOWN = ("fail", "dead_letter")


def lookup_size(lookup: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of the whole lookup."""
    row = lookup.agg(F.count(F.lit(1)).alias("n"),
                     F.coalesce(F.sum(F.octet_length("symbol").cast("bigint") + ROW_BYTES), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def fits_broadcast(lookup: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when the symbols and prices of ``lookup`` take at most ``max_bytes``."""
    return lookup_size(lookup)[1] <= max_bytes


def _lookup_side(lookup: DataFrame, broadcast: bool) -> DataFrame:
    side = lookup.select(
        F.col("symbol").alias("_lookup_symbol"),
        F.col("price").alias("_price"),
        F.lit(True).alias("_matched"),
    )
    return F.broadcast(side) if broadcast else side


def unknown_symbol_error(symbol: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"{UNKNOWN_CURRENCY}: "), symbol))


def with_price(rows: DataFrame, lookup: DataFrame, broadcast: bool) -> DataFrame:
    """``rows`` with ``_price`` and ``_matched`` (NULL where the symbol has no price)."""
    return rows.join(_lookup_side(lookup, broadcast), F.col("currency_symbol") == F.col("_lookup_symbol"), "left")


def require_price(joined: DataFrame) -> DataFrame:
    """Abort on a row without a price.

    The check is a filter, not a projected value: it runs whatever columns the
    consumer reads, so a count aborts as well.
    """
    known = F.when(F.col("_matched").isNull(), unknown_symbol_error(F.col("currency_symbol")).cast("boolean"))
    return joined.where(known.otherwise(F.lit(True)))


def attach_prices(
    clean: DataFrame,
    lookup: DataFrame,
    broadcast: bool | None = None,
) -> DataFrame:
    """Clean rows plus ``price`` and ``usd`` = price × volume; unknown symbols abort."""
    if broadcast is None:
        broadcast = fits_broadcast(lookup)
    return require_price(with_price(clean, lookup, broadcast)).select(
        *[F.col(c) for c in clean.columns],
        F.col("_price").alias("price"),
        (F.col("_price") * F.col("volume")).alias("usd"),
    )


def split_unknown(
    clean: DataFrame,
    lookup: DataFrame,
    broadcast: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Dead-letter mode: (priced rows, rows whose symbol has no price).

    The second frame carries ``Reason`` and ``reason_code`` first, then the
    clean row's columns (and any raw columns the caller kept).
    """
    if broadcast is None:
        broadcast = fits_broadcast(lookup)
    joined = with_price(clean, lookup, broadcast)
    priced = joined.where(F.col("_matched").isNotNull()).select(
        *[F.col(c) for c in clean.columns],
        F.col("_price").alias("price"),
        (F.col("_price") * F.col("volume")).alias("usd"),
    )
    unknown = joined.where(F.col("_matched").isNull()).select(
        F.concat(F.lit(f"{UNKNOWN_CURRENCY}: "), F.col("currency_symbol")).alias("Reason"),
        F.lit(UNKNOWN_CURRENCY).alias("reason_code"),
        *[F.col(c) for c in clean.columns],
    )
    return priced, unknown


def unknown_as_dead_letters(unknown: DataFrame) -> DataFrame:
    """Shape rows from :func:`split_unknown` like the cleaning dead letters.

    Needs the raw text kept through cleaning (``clean(..., keep_raw=True)``
    adds it as ``raw_<name>`` columns).
    """
    return unknown.select(
        "Reason", *[F.col(f"raw_{c}").alias(c) for c in RAW_COLUMNS], "reason_code"
    )
