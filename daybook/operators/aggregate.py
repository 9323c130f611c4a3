"""Daily volume per project.

Spark plans the map-side partial aggregate (count, sum per task) and the
final merge after one shuffle on (Date, ProjectId) by itself; a key holding a
third of all rows still sends only one partial row per map task.
:func:`merge_partials` is the same merge as a user operator over stored
partial results (micro-batches, buckets, earlier runs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import day_key
from daybook.operators.clean import UNKNOWN_CURRENCY
from daybook.operators.convert import attach_prices, fits_broadcast, require_price, with_price

AGG_COLUMNS = ("Date", "ProjectId", "NumberOfTransactions", "TotalVolumeUsd")


def _with_date_text(agg: DataFrame) -> DataFrame:
    """Turn the ``_day`` date key into ``Date`` text, once per group instead of once per row."""
    return agg.select(day_key("_day").alias("Date"), *[c for c in AGG_COLUMNS if c != "Date"])


def daily_totals(priced: DataFrame) -> DataFrame:
    """Priced clean rows → Date, ProjectId, NumberOfTransactions, TotalVolumeUsd.

    Rows group on the calendar date (an int) and the date text is formatted
    per group after the aggregate.
    """
    agg = priced.groupBy(
        F.to_date("ts").alias("_day"), F.col("project_id").alias("ProjectId")
    ).agg(
        F.count(F.lit(1)).alias("NumberOfTransactions"),
        F.sum("usd").alias("TotalVolumeUsd"),
    )
    return _with_date_text(agg)


def merge_partials(partials: DataFrame) -> DataFrame:
    """Combine partial aggregates (any number of rows per key) into final ones."""
    return partials.groupBy("Date", "ProjectId").agg(
        F.sum("NumberOfTransactions").alias("NumberOfTransactions"),
        F.sum("TotalVolumeUsd").alias("TotalVolumeUsd"),
    )


def symbol_partials(clean: DataFrame) -> DataFrame:
    """Clean rows → one row per (day, project, symbol) with the count and the summed volume."""
    return clean.groupBy(
        F.to_date("ts").alias("_day"), F.col("project_id").alias("ProjectId"), "currency_symbol"
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))


def _priced_totals(joined: DataFrame) -> DataFrame:
    agg = joined.groupBy("_day", "ProjectId").agg(
        F.sum("n").alias("NumberOfTransactions"),
        F.sum(F.col("_price") * F.col("volume")).alias("TotalVolumeUsd"),
    )
    return _with_date_text(agg)


def daily_volume(clean: DataFrame, lookup: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Clean transactions + price lookup → daily totals; an unknown symbol aborts.

    With a broadcast lookup rows are priced where they are read, and the only
    shuffle moves partials per (day, project).  With a larger one rows are first
    reduced to one partial per (day, project, symbol), so the join on symbol moves
    partials instead of rows and a hot symbol cannot skew it.  The two add in
    different orders, as do any two partitionings; :mod:`daybook.operators.exact` has sums without that.
    """
    if broadcast is None:
        broadcast = fits_broadcast(lookup)
    if broadcast:
        return daily_totals(attach_prices(clean, lookup, True))
    return _priced_totals(require_price(with_price(symbol_partials(clean), lookup, broadcast)))


def daily_volume_with_unknown(
    clean: DataFrame, lookup: DataFrame, broadcast: bool | None = None
) -> tuple[DataFrame, DataFrame]:
    """Dead-letter mode: (daily totals of priced rows, rows whose symbol has no price).

    The totals are computed as in :func:`daily_volume`.  The symbols without a
    price are a set bounded by the distinct symbols in the data; only that set
    is joined back to the rows, and AQE broadcasts it when it turns out small.
    """
    if broadcast is None:
        broadcast = fits_broadcast(lookup)
    joined = with_price(symbol_partials(clean), lookup, broadcast)
    agg = _priced_totals(joined.where(F.col("_matched").isNotNull()))
    missing = joined.where(F.col("_matched").isNull()).select(
        F.col("currency_symbol").alias("_missing_symbol")).distinct()
    unknown = clean.join(missing, F.col("currency_symbol") == F.col("_missing_symbol"), "left_semi").select(
        F.concat(F.lit(f"{UNKNOWN_CURRENCY}: "), F.col("currency_symbol")).alias("Reason"),
        F.lit(UNKNOWN_CURRENCY).alias("reason_code"),
        *[F.col(c) for c in clean.columns],
    )
    return agg, unknown
