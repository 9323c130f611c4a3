"""End-to-end jobs (E1, E2) and their run counters (M3).

E1, :func:`daily_volume_job`: price file + transaction file(s) → daily
aggregates (CSV or table) + dead letters (CSV).  The transaction files are read
and parsed once: every row's outcome is landed as one narrow parquet table in
the cluster's shared folder (which also cuts the lineage, so a lost executor
never re-parses the source), and both outputs are read from it.

E2, :func:`price_snapshot`: landed price pages → price CSV.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.functions import MAX_VOLUME
from daybook.operators.aggregate import daily_volume
from daybook.operators.clean import DEAD_LETTER_COLUMNS, MALFORMED_ROW, RAW_COLUMNS, UNKNOWN_CURRENCY, classify
from daybook.operators.convert import (
    MAX_BROADCAST_BYTES,
    ON_UNKNOWN,
    ROW_BYTES,
    lookup_size,
    unknown_symbol_error,
    with_price,
)
from daybook.operators.prices import PRICE_CSV_COLUMNS
from daybook.session import configure, remove_scratch, scratch_path
from daybook.sinks.files import csv_writer, write_dead_letters_csv
from daybook.sinks.table import aggregate_sink
from daybook.sources.files import (
    CORRUPT,
    ON_MALFORMED,
    PAGE_SIZE,
    malformed_reason,
    read_price_pages,
    read_prices,
    read_raw,
    reject_malformed,
    resolve_path,
)

# What can become of a row.
CLEAN, REJECTED, UNKNOWN, MALFORMED = "clean", "rejected", "unknown", "malformed"


@dataclass
class RunReport:
    """Counters of one run; rows_read = clean_rows + rejected_rows."""

    rows_read: int
    prices_read: int
    clean_rows: int
    rejected_rows: int
    aggregates_written: int


def outcomes(raw: DataFrame, lookup: DataFrame, broadcast: bool, on_unknown: str = "fail",
             max_volume: float = MAX_VOLUME) -> DataFrame:
    """Every raw row with its ``kind``: the clean columns where clean, reason and raw text elsewhere.

    ``raw`` may carry the corrupt-record column (rows that have one are
    malformed).  With a broadcast lookup clean rows are looked up as they are read: one whose symbol has no
    price becomes a dead letter (``on_unknown="dead_letter"``) or stops the job
    before anything else is done.  With a larger lookup raw rows are not joined: :func:`landing` finds unknown symbols
    on the landed rows, which keep their raw text for that in dead-letter mode, and the aggregate aborts on them otherwise.
    """
    has_corrupt = CORRUPT in raw.columns
    rows = classify(raw, max_volume).withColumn("currency_symbol", F.col("_props.value"))
    bad = F.col(CORRUPT).isNotNull() if has_corrupt else F.lit(False)
    rejected = F.col("reason_code").isNotNull()
    missing = F.lit(False)
    if broadcast:
        # A NULL symbol (of a rejected row) matches nothing and is not asked about.
        rows = with_price(rows, lookup, True)
        missing = F.col("_matched").isNull()
        if on_unknown == "fail":
            missing = F.when(missing, unknown_symbol_error(F.col("currency_symbol")).cast("boolean")).otherwise(F.lit(False))
    kind = (F.when(bad, MALFORMED).when(rejected, REJECTED).when(missing, UNKNOWN).otherwise(CLEAN))
    reason = (F.when(F.col("kind") == REJECTED, F.col("Reason"))
              .when(F.col("kind") == UNKNOWN, unknown_reason(F.col("currency_symbol"))))
    code = (F.when(F.col("kind") == REJECTED, F.col("reason_code")).when(F.col("kind") == UNKNOWN, UNKNOWN_CURRENCY)
            .when(F.col("kind") == MALFORMED, MALFORMED_ROW))
    if has_corrupt:
        reason = reason.when(F.col("kind") == MALFORMED, malformed_reason())
    is_clean = F.col("kind") == CLEAN
    with_raw = F.lit(True) if on_unknown == "dead_letter" and not broadcast else ~is_clean
    return rows.withColumn("kind", kind).select(
        "kind",
        F.when(is_clean, F.col("_ts")).alias("ts"),
        F.when(is_clean, F.col("project_id")).alias("project_id"),
        F.when(is_clean, F.col("currency_symbol")).alias("currency_symbol"),
        F.when(is_clean, F.col("_volume")).alias("volume"),
        reason.alias("Reason"),
        code.alias("reason_code"),
        *[F.when(with_raw, F.col(c)).alias(f"raw_{c}") for c in RAW_COLUMNS],
    )


def unknown_reason(symbol: Column) -> Column:
    return F.concat(F.lit(f"{UNKNOWN_CURRENCY}: "), symbol)


def land(rows: DataFrame, path: str) -> tuple[Observation, DataFrame]:
    """Write :func:`outcomes` once, in the order they come; returns the row counter and the table read back.

    The table is not split by kind, which would sort every row; kind is a
    dictionary column that both readers filter on.
    """
    obs = Observation()
    rows.observe(obs, F.count(F.lit(1)).alias("rows_read")).write.mode("overwrite").parquet(path)
    return obs, rows.sparkSession.read.schema(rows.schema).parquet(path)


def _mark_unknown(landed: DataFrame, lookup: DataFrame, path: str, max_bytes: int) -> DataFrame:
    """Landed rows in which clean ones with a symbol that a large lookup lacks have become dead letters.

    The symbols are found on their distinct values; only the set of missing ones, written to ``path``, meets the rows,
    broadcast where its bytes are few.
    """
    spark = landed.sparkSession
    symbols = landed.where(F.col("kind") == CLEAN).select("currency_symbol").distinct()
    symbols.join(lookup, symbols.currency_symbol == lookup.symbol, "left_anti").select(
        F.col("currency_symbol").alias("_missing")).write.parquet(path)
    missing = spark.read.schema("_missing string").parquet(path)
    size = missing.agg(F.coalesce(F.sum(F.octet_length("_missing") + ROW_BYTES), F.lit(0))).first()[0]
    if not size:
        return landed
    if size <= max_bytes:
        missing = F.broadcast(missing)
    found = landed.join(missing, F.col("currency_symbol") == F.col("_missing"), "left")
    unknown = F.col("_missing").isNotNull()
    return found.select(
        F.when(unknown, UNKNOWN).otherwise(F.col("kind")).alias("kind"), "ts", "project_id", "currency_symbol", "volume",
        F.when(unknown, unknown_reason(F.col("currency_symbol"))).otherwise(F.col("Reason")).alias("Reason"),
        F.when(unknown, UNKNOWN_CURRENCY).otherwise(F.col("reason_code")).alias("reason_code"), *[f"raw_{c}" for c in RAW_COLUMNS])


class Landed:
    """Landed outcomes and their counters; ``dead_rows`` is there once what ``count_dead`` returned has been written."""

    def __init__(self, rows: DataFrame, obs: Observation):
        self.rows, self._obs, self._dead = rows, obs, Observation()

    def count_dead(self, dead: DataFrame) -> DataFrame:
        return dead.observe(self._dead, F.count(F.lit(1)).alias("n"))

    @property
    def rows_read(self) -> int:
        return int(self._obs.get["rows_read"])

    @property
    def dead_rows(self) -> int:
        return int(self._dead.get["n"])


@contextmanager
def landing(spark: SparkSession, raw: DataFrame, lookup: DataFrame, broadcast: bool, on_unknown: str, max_volume: float,
            name: str, keep_scratch: bool = False, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> Iterator[Landed]:
    """The outcomes of ``raw`` as a table in the shared folder, removed at the end, also when the work inside fails."""
    path, missing = scratch_path(spark, name), scratch_path(spark, f"{name}-missing")
    try:
        obs, rows = land(outcomes(raw, lookup, broadcast, on_unknown, max_volume), path)
        if on_unknown == "dead_letter" and not broadcast:
            rows = _mark_unknown(rows, lookup, missing, max_broadcast_bytes)
        yield Landed(rows, obs)
    finally:
        if not keep_scratch:
            remove_scratch(spark, path)
            remove_scratch(spark, missing)


def landed_clean(landed: DataFrame) -> DataFrame:
    return landed.where(F.col("kind") == CLEAN).select("ts", "project_id", "currency_symbol", "volume")


def landed_dead(landed: DataFrame, *keep: str | Column) -> DataFrame:
    return landed.where(F.col("kind") != CLEAN).select(
        "Reason", *[F.col(f"raw_{c}").alias(c) for c in RAW_COLUMNS], *keep)


def daily_volume_job(
    spark: SparkSession,
    transactions: str,
    prices: str,
    output: str,
    errors: str,
    on_unknown: str = "fail",
    on_malformed: str = "fail",
    max_volume: float = MAX_VOLUME,
    table_mode: str = "append",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    multi_line: bool | None = None,
    mixed_headers: bool = False,
    keep_scratch: bool = False,
) -> RunReport:
    """Clean, price and aggregate transactions; write aggregates and dead letters.

    ``on_unknown``: ``"fail"`` aborts the job on a symbol without a price
    (nothing is written to ``output``); ``"dead_letter"`` routes those rows to
    ``errors``.  ``on_malformed``: ``"fail"`` stops on a CSV row with the wrong
    number of fields; ``"dead_letter"`` routes it to ``errors``.  ``multi_line``
    and ``mixed_headers``: see :func:`~daybook.sources.files.read_transactions`.
    The landed rows are removed at the end, also of a job that fails, unless ``keep_scratch``.
    """
    if on_unknown not in ON_UNKNOWN:
        raise ValueError(f"on_unknown must be one of {ON_UNKNOWN}")
    if on_malformed not in ON_MALFORMED:
        raise ValueError(f"on_malformed must be one of {ON_MALFORMED}")
    configure(spark)
    lookup_path = scratch_path(spark, "lookup")
    try:
        read_prices(spark, prices).write.parquet(lookup_path)
        lookup = spark.read.schema("symbol string, price double").parquet(lookup_path)
        prices_read, lookup_bytes = lookup_size(lookup)
        broadcast = lookup_bytes <= max_broadcast_bytes

        raw = read_raw(spark, transactions, multi_line, mixed_headers)
        if on_malformed == "fail":
            raw = reject_malformed(raw)
        agg_obs = Observation()
        with landing(spark, raw, lookup, broadcast, on_unknown, max_volume, "outcomes", keep_scratch) as landed:
            aggregate_sink(output, mode=table_mode, obs=agg_obs)(daily_volume(landed_clean(landed.rows), lookup, broadcast))
            dead = landed_dead(landed.rows).select(*DEAD_LETTER_COLUMNS)
            write_dead_letters_csv(landed.count_dead(dead), errors)
            rows_read, dead_rows = landed.rows_read, landed.dead_rows
    finally:
        if not keep_scratch:
            remove_scratch(spark, lookup_path)
    return RunReport(
        rows_read=rows_read,
        prices_read=prices_read,
        clean_rows=rows_read - dead_rows,
        rejected_rows=dead_rows,
        aggregates_written=int(agg_obs.get["n"]),
    )


def price_snapshot(spark: SparkSession, pages: str, output: str, multi_line: bool = False, page_size: int | None = PAGE_SIZE) -> int:
    """Landed price pages → price CSV with header ``ID,Symbol,Name,Price (USD)``; returns rows written."""
    configure(spark)
    obs = Observation()
    coins = read_price_pages(spark, pages, multi_line, page_size)
    csv_writer(coins.select(*[F.col(f"`{c}`") for c in PRICE_CSV_COLUMNS])
               .observe(obs, F.count(F.lit(1)).alias("n"))).csv(resolve_path(output))
    return int(obs.get["n"])
