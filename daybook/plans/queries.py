"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the shared parquet tables (through the adapters in
:mod:`daybook.sources.tables`) in full.  USD sums are rounded to a few
decimals past the exact scale of the products so that two engines summing
in different orders print the same value.
"""

from __future__ import annotations

import math
import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.aggregate import daily_volume, merge_partials
from daybook.operators.clean import RAW_COLUMNS, classify, clean, dead_letters, reject_counts
from daybook.operators.convert import (
    MAX_BROADCAST_BYTES,
    ROW_BYTES,
    attach_prices,
    split_unknown,
    unknown_as_dead_letters,
)
from daybook.operators.exact import exact_daily_volume
from daybook.operators.prices import inline_prices
from daybook.operators.replicate import replicate
from daybook.plans.jobs import daily_volume_job, price_snapshot
from daybook.session import configure, scratch_path
from daybook.sinks.files import (
    csv_writer,
    read_aggregates_csv,
    read_dead_letters_csv,
    write_aggregates_csv,
    write_dead_letters_csv,
)
from daybook.sinks.runs import read_runs, write_run
from daybook.sinks.table import write_table
from daybook.sources import tables as T
from daybook.sources.files import PAGE_SIZE, read_price_pages, read_price_rows, read_prices, read_transactions
from daybook.streaming.microbatch import (
    merged_daily_volume,
    run_daily_volume_stream,
    stream_dead_letters,
    transaction_stream,
)
from daybook.streaming.rowbatches import RowBatches
from daybook.streaming.running import run_running_daily_volume, running_daily_volume

# Decimal places kept in USD sums (see module doc).
EVENT_USD_PLACES = 5
LINEITEM_USD_PLACES = 4
# Amount ceiling used by the outlier query on order totals.
ORDER_MAX_VOLUME = 400_000.0
# Number of hash buckets the partial-merge query splits events into.
PARTIAL_BUCKETS = 8
# Copies made by the replicate query.
REPLICAS = 3
TS_TEXT = T.TS_TEXT


def _small(prices: dict[str, float]) -> bool:
    """A literal price mapping's size is known without counting it."""
    return sum(len(s.encode()) + ROW_BYTES for s in prices) <= MAX_BROADCAST_BYTES


def _rounded(agg: DataFrame, places: int) -> DataFrame:
    return agg.withColumn("TotalVolumeUsd", F.round("TotalVolumeUsd", places))


def events_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: events → clean → USD → daily volume per project."""
    configure(spark)
    raw = T.events_transactions(spark, sf_dir)
    agg = daily_volume(clean(raw), inline_prices(spark, T.EVENT_PRICES), broadcast=_small(T.EVENT_PRICES))
    return _rounded(agg, EVENT_USD_PLACES)


def lineitem_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark job: 6M-rows-per-SF lineitem adapter through the same pipeline."""
    configure(spark)
    raw = T.lineitem_transactions(spark, sf_dir)
    agg = daily_volume(clean(raw), inline_prices(spark, T.LINEITEM_PRICES), broadcast=_small(T.LINEITEM_PRICES))
    return _rounded(agg, LINEITEM_USD_PLACES)


def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    c = classify(T.events_transactions(spark, sf_dir))
    return c.select("ts", F.date_format("_ts", TS_TEXT).alias("parsed_ts"))


def extract_nums(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    c = classify(T.events_transactions(spark, sf_dir))
    return c.select("nums", F.col("_nums.ok").alias("json_ok"), F.col("_nums.value").alias("amount_text"))


def extract_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    c = classify(T.events_transactions(spark, sf_dir))
    return c.select("props", F.col("_props.ok").alias("json_ok"), F.col("_props.value").alias("symbol"))


def parse_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    c = classify(T.events_transactions(spark, sf_dir))
    return c.where(F.col("_nums.ok")).select(
        F.col("_nums.value").alias("amount_text"), F.col("_volume").alias("volume")
    )


def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    cl = clean(T.events_transactions(spark, sf_dir))
    return cl.withColumn("ts", F.date_format("ts", TS_TEXT))


def events_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return dead_letters(T.events_transactions(spark, sf_dir))


def events_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return reject_counts(T.events_transactions(spark, sf_dir))


def volume_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals above a lower ceiling are rejected by the range rule."""
    configure(spark)
    return dead_letters(T.orders_transactions(spark, sf_dir), max_volume=ORDER_MAX_VOLUME)


def usd_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    cl = clean(T.events_transactions(spark, sf_dir))
    priced = attach_prices(cl, inline_prices(spark, T.EVENT_PRICES), broadcast=_small(T.EVENT_PRICES))
    return priced.select(
        F.date_format("ts", TS_TEXT).alias("ts"),
        "project_id",
        "currency_symbol",
        "volume",
        "price",
        F.round("usd", EVENT_USD_PLACES).alias("usd"),
    )


def unknown_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead-letter mode with a price list lacking MATIC: the MATIC rows come back."""
    configure(spark)
    prices = WITHOUT_MATIC
    cl = clean(T.events_transactions(spark, sf_dir), keep_raw=True)
    _, unknown = split_unknown(cl, inline_prices(spark, prices), broadcast=_small(prices))
    return unknown_as_dead_letters(unknown)


def merge_bucket_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials per hash bucket of event_id, then merged into final daily totals."""
    configure(spark)
    cl = clean(T.events_transactions(spark, sf_dir, keep=("event_id",)), keep=("event_id",))
    priced = attach_prices(cl, inline_prices(spark, T.EVENT_PRICES), broadcast=_small(T.EVENT_PRICES))
    bucket = F.pmod(F.xxhash64("event_id"), F.lit(PARTIAL_BUCKETS))
    partials = (
        priced.groupBy(bucket.alias("bucket"), F.to_date("ts").alias("day"), F.col("project_id").alias("ProjectId"))
        .agg(F.count(F.lit(1)).alias("NumberOfTransactions"), F.sum("usd").alias("TotalVolumeUsd"))
        .withColumn("Date", F.date_format("day", "yyyy-MM-dd"))
    )
    return _rounded(merge_partials(partials), EVENT_USD_PLACES)


def replicate_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events copied REPLICAS times, then the flagship aggregate."""
    configure(spark)
    raw = replicate(T.events_transactions(spark, sf_dir), REPLICAS)
    agg = daily_volume(clean(raw), inline_prices(spark, T.EVENT_PRICES), broadcast=_small(T.EVENT_PRICES))
    return _rounded(agg, EVENT_USD_PLACES)


# --- queries over files staged from the tables -------------------------------------------

# Rows of one staged transaction file, about.
STAGED_ROWS = 25_000
# Files of a staged export, or so, at most: a larger table makes larger files.
STAGED_FILES = 32
# The landed price page that lacks a coin, which ends the list (counted from 0), and the place of that coin.
SHORT_PAGE, LOST_COIN = 3, 6
# Rows of a micro-batch cut by row count.
BATCH_ROWS = 3_000
# Micro-batches cut by row count that are worked on together.
BATCHES_AT_ONCE = 1_000
# The price list before a symbol was added to it.
LATE_SYMBOL = "SFL"


def rows_a_file(spark: SparkSession, sf_dir: str, least: int, rows: float = 1.0) -> int:
    """Rows of a staged file: ``least``, or a multiple that cuts this share of the events into STAGED_FILES files."""
    n = T.table(spark, sf_dir, "events", spread_scan=False).count() * rows
    return least * max(1, math.ceil(n / (least * STAGED_FILES)))


def stage_events_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the 16-column events export as CSV under the shared folder; returns its path.

    One file per STAGED_ROWS or so rows, or more of them in a table that would make more than STAGED_FILES files.
    """
    path = scratch_path(spark, "events-csv")
    csv_writer(T.events_wide(spark, sf_dir)).option("maxRecordsPerFile", rows_a_file(spark, sf_dir, STAGED_ROWS)).csv(path)
    return path


def stage_prices_csv(spark: SparkSession, prices: dict[str, float]) -> str:
    """Write a literal price mapping as a price CSV (ID, Symbol, Name, Price (USD))."""
    path = scratch_path(spark, "prices-csv")
    rows = [(s.lower(), s.lower(), s, str(p)) for s, p in prices.items()]
    csv_writer(spark.createDataFrame(rows, "ID string, Symbol string, Name string, `Price (USD)` string")
               .coalesce(1)).csv(path)
    return path


# event_id moduli of the damaged export.
LOST_FIELD_MOD, EXTRA_FIELD_MOD, LINE_BREAK_MOD, STRAY_QUOTE_MOD = 61, 59, 53, 47


def _csv_line(columns: list[str]) -> str:
    """SQL of one CSV line with every field in quotes."""
    return "concat_ws(',', " + ", ".join(f"""concat('"', replace({c}, '"', '""'), '"')""" for c in columns) + ")"


def stage_damaged_csv(spark: SparkSession, sf_dir: str) -> str:
    """The events export as text files in which some rows lost or gained a field, some have a quoted line break, some
    begin with a bare quote inside an unquoted field, and every other file has its columns in reverse order."""
    path = scratch_path(spark, "damaged-csv")
    columns = list(T.WIDE_CSV_COLUMNS)
    wide = T.events_wide(spark, sf_dir).selectExpr("*", "CAST(ident AS bigint) AS id").selectExpr(
        *[f"CASE WHEN id % {LINE_BREAK_MOD} = 0 THEN concat(event, '\\n', 'again') ELSE event END AS event"
          if c == "event" else c for c in columns], "id", f"CAST(id DIV {STAGED_ROWS} AS int) AS file")
    forward, backward = columns, columns[::-1]

    def damaged(order: list[str]) -> str:
        return (f"CASE WHEN id % {LOST_FIELD_MOD} = 0 THEN {_csv_line(order[:-1])} "
                f"WHEN id % {EXTRA_FIELD_MOD} = 0 THEN concat({_csv_line(order)}, ',\"more\"') "
                f"WHEN id % {STRAY_QUOTE_MOD} = 0 AND id % {LINE_BREAK_MOD} <> 0 THEN concat('x', {_csv_line(order)}) "
                f"ELSE {_csv_line(order)} END")

    lines = wide.selectExpr("file", "id", f"CASE WHEN file % 2 = 0 THEN {damaged(forward)} ELSE {damaged(backward)} END AS line")
    heads = wide.select("file").distinct().selectExpr(
        "file", "CAST(-1 AS bigint) AS id",
        f"CASE WHEN file % 2 = 0 THEN '{','.join(forward)}' ELSE '{','.join(backward)}' END AS line")
    (lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "id").select("file", "line")
     .write.partitionBy("file").text(path))
    return path


def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide export is read back by header name; only the five raw columns remain."""
    configure(spark)
    return read_transactions(spark, stage_events_csv(spark, sf_dir))


def price_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part rows as a price file in p_partkey order; last row per upper-cased brand wins."""
    configure(spark)
    path = scratch_path(spark, "part-prices")
    csv_writer(T.part_price_rows(spark, sf_dir, spread_scan=False).orderBy("p_partkey").drop("p_partkey")).csv(path)
    return read_prices(spark, path)


# SQL: the project with blanks before, after or around it.
BLANK_PROJECT = "concat(repeat(' ', CAST(project_id AS int) % 3), project_id, repeat(' ', CAST(project_id AS int) % 2))"


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: daily aggregates written as CSV with a header and read back; project ids with blanks at either end."""
    configure(spark)
    path = scratch_path(spark, "agg-csv")
    raw = T.events_transactions(spark, sf_dir).withColumn("project_id", F.expr(BLANK_PROJECT))
    agg = daily_volume(clean(raw), inline_prices(spark, T.EVENT_PRICES), broadcast=_small(T.EVENT_PRICES))
    write_aggregates_csv(agg, path)
    return _rounded(read_aggregates_csv(spark, path), EVENT_USD_PLACES)


def dead_letter_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: dead letters written as header-less CSV (Reason first) and read back; texts with blanks and line breaks."""
    configure(spark)
    path = scratch_path(spark, "dead-csv")
    raw = T.events_transactions(spark, sf_dir).withColumn("project_id", F.expr(BLANK_PROJECT)).withColumn(
        "event", F.concat(F.col("event"), F.lit("\n \"next\", line ")))
    write_dead_letters_csv(dead_letters(raw), path)
    return read_dead_letters_csv(spark, path)


def partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3/K4/K7: aggregates into a Date-partitioned catalog table, written twice (a replay)."""
    configure(spark)
    location = scratch_path(spark, "daily-table")
    name = "daily_volume_" + location.rsplit("-", 1)[-1]
    raw = T.events_transactions(spark, sf_dir)
    agg = daily_volume(clean(raw), inline_prices(spark, T.EVENT_PRICES), broadcast=_small(T.EVENT_PRICES))
    for _ in range(2):
        write_table(agg, name, mode="replace", location=location)
    table = spark.table(name)
    return _rounded(table.select(F.date_format("Date", "yyyy-MM-dd").alias("Date"), "ProjectId",
                                 "NumberOfTransactions", "TotalVolumeUsd"), EVENT_USD_PLACES)


def stream_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/M1: the export streamed one file per micro-batch; partials merged at the end."""
    configure(spark)
    source = stage_events_csv(spark, sf_dir)
    run = run_daily_volume_stream(
        spark, transaction_stream(spark, source, max_files_per_trigger=1), inline_prices(spark, T.EVENT_PRICES)
    )
    return _rounded(merged_daily_volume(spark, run), EVENT_USD_PLACES)


def stage_price_pages(spark: SparkSession, sf_dir: str) -> str:
    """Part rows landed as JSON pages of PAGE_SIZE coins, one of which lacks a coin; returns their folder."""
    path = scratch_path(spark, "price-pages")
    at = F.col("p_partkey")
    coins = T.part_price_rows(spark, sf_dir).select(
        F.floor(at / PAGE_SIZE).cast("bigint").alias("page"), (at % PAGE_SIZE).alias("place"),
        F.struct(F.col("ID").alias("id"), F.lower("Symbol").alias("symbol"), F.col("Name").alias("name"),
                 F.col("`Price (USD)`").alias("current_price")).alias("coin"),
    ).where((F.col("page") != SHORT_PAGE) | (F.col("place") != LOST_COIN))
    pages = coins.groupBy("page").agg(F.to_json(F.collect_list("coin")).alias("value"))
    pages.orderBy("page").select("value").write.text(path)
    return path


def price_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part rows landed as JSON pages of PAGE_SIZE coins, read back into price rows up to the first short page."""
    configure(spark)
    return read_price_pages(spark, stage_price_pages(spark, sf_dir)).withColumnRenamed("Price (USD)", "price_usd")


def job_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from CSV files to an aggregate CSV, read back."""
    configure(spark)
    out = scratch_path(spark, "job-out")
    daily_volume_job(
        spark,
        transactions=stage_events_csv(spark, sf_dir),
        prices=stage_prices_csv(spark, T.EVENT_PRICES),
        output=out,
        errors=scratch_path(spark, "job-errors"),
    )
    return _rounded(read_aggregates_csv(spark, out), EVENT_USD_PLACES)


def job_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 in dead-letter mode with a price list lacking MATIC: the dead-letter CSV, read back."""
    configure(spark)
    errors = scratch_path(spark, "job-errors")
    daily_volume_job(
        spark,
        transactions=stage_events_csv(spark, sf_dir),
        prices=stage_prices_csv(spark, WITHOUT_MATIC),
        output=scratch_path(spark, "job-out"),
        errors=errors,
        on_unknown="dead_letter",
    )
    return read_dead_letters_csv(spark, errors)


def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged export (fields lost and gained, stray quotes, quoted line breaks, two column orders) read in
    dead-letter mode, its files in splits."""
    configure(spark)
    rows, bad = read_transactions(spark, stage_damaged_csv(spark, sf_dir), on_malformed="dead_letter", mixed_headers=True)
    return rows.select(F.lit("").alias("Reason"), "*").unionByName(
        bad.select("Reason", *[F.lit("").alias(c) for c in rows.columns]))


def price_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part rows as a price file whose names hold line breaks and quotes, in p_partkey order; its rows."""
    configure(spark)
    path = scratch_path(spark, "part-prices")
    named = T.part_price_rows(spark, sf_dir, spread_scan=False).withColumn(
        "Name", F.when(F.col("p_partkey") % 3 == 0, F.concat("Name", F.lit('\n"second", '), "Name")).otherwise(F.col("Name")))
    csv_writer(named.orderBy("p_partkey").drop("p_partkey")).csv(path)
    return read_price_rows(spark, path).select("ID", "Symbol", "Name", F.col("`Price (USD)`").cast("double").alias("price_usd"))


def trap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard timestamps, payloads and amounts with outcomes fixed per case."""
    configure(spark)
    c = classify(T.trap_transactions(spark, sf_dir))
    clean_row = F.col("reason_code").isNull()
    return c.select("event_id", "reason_code", F.when(clean_row, F.col("project_id")).alias("project_id"),
                    F.when(clean_row, F.col("_props.value")).alias("symbol"),
                    F.when(clean_row, F.col("_volume")).alias("volume"))


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: two halves of the events appended to one table, the default mode; read back by date and project."""
    configure(spark)
    location = scratch_path(spark, "daily-append")
    name = "daily_append_" + location.rsplit("-", 1)[-1]
    raw = T.events_transactions(spark, sf_dir, keep=("event_id",))
    for half in (0, 1):
        part = clean(raw.where(F.col("event_id") % 2 == half))
        write_table(daily_volume(part, inline_prices(spark, T.EVENT_PRICES), broadcast=_small(T.EVENT_PRICES)),
                    name, location=location)
    total = spark.table(name).groupBy("Date", "ProjectId").agg(
        F.sum("NumberOfTransactions").alias("NumberOfTransactions"), F.sum("TotalVolumeUsd").alias("TotalVolumeUsd"),
        F.count(F.lit(1)).alias("n_rows"))
    return _rounded(total.withColumn("Date", F.date_format("Date", "yyyy-MM-dd")), EVENT_USD_PLACES)


def price_snapshot_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part rows landed as JSON pages and written as a price CSV by the snapshot job; the CSV's rows."""
    configure(spark)
    out = scratch_path(spark, "snapshot")
    n = price_snapshot(spark, stage_price_pages(spark, sf_dir), out)
    return read_price_rows(spark, out).select(
        "ID", "Symbol", "Name", F.col("`Price (USD)`").cast("double").alias("price_usd"),
        F.lit(n).cast("bigint").alias("n_written"))


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: counters of the job in both unknown-currency modes and into both sinks."""
    configure(spark)
    rows = []
    tx = stage_events_csv(spark, sf_dir)
    table = "counters_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    for mode, sink, prices in (("fail", "csv", T.EVENT_PRICES), ("fail", "table", T.EVENT_PRICES),
                               ("dead_letter", "csv", WITHOUT_MATIC)):
        output = scratch_path(spark, "counters") if sink == "csv" else f"table://spark_catalog/default/{table}"
        report = daily_volume_job(spark, tx, stage_prices_csv(spark, prices), output, scratch_path(spark, "counters-err"),
                                  on_unknown=mode)
        rows.append((mode, sink, report.rows_read, report.prices_read, report.clean_rows, report.rejected_rows,
                     report.aggregates_written))
    return spark.createDataFrame(rows, "mode string, sink string, rows_read bigint, prices_read bigint, "
                                       "clean_rows bigint, rejected_rows bigint, aggregates_written bigint")


def unknown_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2, abort mode: a count over the priced rows, which reads no price, stops at a symbol without one."""
    configure(spark)
    priced = attach_prices(clean(T.events_transactions(spark, sf_dir)), inline_prices(spark, WITHOUT_MATIC),
                           broadcast=_small(WITHOUT_MATIC))
    try:
        message = f"counted {priced.count()}"
    except PySparkException as e:
        found = re.search(r"currency symbol not supported: \w+", str(e))
        message = found[0] if found else "other error"
    return spark.createDataFrame([(message,)], "message string")


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the stream with a price list lacking MATIC, in dead-letter mode: its dead letters."""
    configure(spark)
    run = run_daily_volume_stream(
        spark, transaction_stream(spark, stage_events_csv(spark, sf_dir), on_malformed="dead_letter"),
        inline_prices(spark, WITHOUT_MATIC), on_unknown="dead_letter")
    return stream_dead_letters(spark, run).select("Reason", *RAW_COLUMNS, "reason_code")


def daily_volume_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: the flagship with sums that no order of addition changes: unrounded totals, equal bit by bit."""
    configure(spark)
    raw = T.events_transactions(spark, sf_dir)
    return exact_daily_volume(clean(raw), inline_prices(spark, T.EVENT_PRICES), broadcast=_small(T.EVENT_PRICES))


def stage_events_in_turns(spark: SparkSession, sf_dir: str):
    """Two calls of the function returned write the two halves of the export into one folder, one after the other."""
    path, size = scratch_path(spark, "events-turns"), rows_a_file(spark, sf_dir, STAGED_ROWS // 10, 0.5)

    def land(half: int) -> str:
        rows = T.events_wide(spark, sf_dir).where(F.col("ident").cast("bigint") % 2 == half)
        csv_writer(rows).mode("append").option("maxRecordsPerFile", size).csv(path)
        return path

    return land


def stream_running_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the aggregate in the state store: half of the export, a restart, the other half; unrounded totals."""
    configure(spark)
    land, work = stage_events_in_turns(spark, sf_dir), scratch_path(spark, "running")
    run = None
    for half in (0, 1):
        stream = transaction_stream(spark, land(half), max_files_per_trigger=2)
        run = run_running_daily_volume(spark, stream, inline_prices(spark, T.EVENT_PRICES), work_dir=work)
    return running_daily_volume(spark, run)


def stream_price_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run stops at a symbol that its price list lacks; a later run in its folder, whose list has it, succeeds."""
    configure(spark)
    source, work = stage_events_csv(spark, sf_dir), scratch_path(spark, "versions")
    first = {s: p for s, p in T.EVENT_PRICES.items() if s != LATE_SYMBOL}
    stopped = "no"
    try:
        run_daily_volume_stream(spark, transaction_stream(spark, source), inline_prices(spark, first), work_dir=work)
    except PySparkException as e:
        stopped = LATE_SYMBOL if f"currency symbol not supported: {LATE_SYMBOL}" in str(e) else "other error"
    run = run_daily_volume_stream(spark, transaction_stream(spark, source), inline_prices(spark, T.EVENT_PRICES), work_dir=work)
    return _rounded(merged_daily_volume(spark, run), EVENT_USD_PLACES).withColumn("stopped_at", F.lit(stopped)).withColumn(
        "price_version", F.lit(run.price_version))


def table_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: two runs, A and B, with Dates in common, then A again, into the table by run id: the rows of A and B."""
    configure(spark)
    base = scratch_path(spark, "runs-table")
    raw = T.events_transactions(spark, sf_dir, keep=("event_id",))
    for name, half in (("A", 0), ("B", 1), ("A", 0)):
        part = clean(raw.where(F.col("event_id") % 2 == half))
        write_run(daily_volume(part, inline_prices(spark, T.EVENT_PRICES), broadcast=_small(T.EVENT_PRICES)), base, name)
    return _rounded(read_runs(spark, base).withColumn("Date", F.date_format("Date", "yyyy-MM-dd")), EVENT_USD_PLACES)


def row_count_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the export in micro-batches of BATCH_ROWS rows, across file borders: rows and first and last event of each."""
    configure(spark)
    source, out = scratch_path(spark, "events-rows"), scratch_path(spark, "row-batches")
    # Files in the order of event_id, of a size that no batch border meets; the names of their tasks keep that order.
    ordered = T.events_wide(spark, sf_dir).orderBy(F.col("ident").cast("bigint")).withColumn("event", F.col("ident"))
    csv_writer(ordered).option("maxRecordsPerFile", rows_a_file(spark, sf_dir, 1_700)).csv(source)
    rounds: list[str] = []

    def count(batches: DataFrame, first_id: int) -> None:
        ident = F.col("event").cast("bigint")
        rounds.append(f"{out}/from={first_id}")
        batches.groupBy("batch_id").agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(ident).alias("first_event"), F.max(ident).alias("last_event")).write.mode(
            "overwrite").parquet(rounds[-1])

    RowBatches(spark, source, scratch_path(spark, "row-work"), BATCH_ROWS, by_name=True).run(count, at_once=BATCHES_AT_ONCE)
    return spark.read.parquet(*rounds)


# A price list without one of the symbols in the data.
WITHOUT_MATIC = {s: p for s, p in T.EVENT_PRICES.items() if s != "MATIC"}

QUERIES = {
    "daily_volume": events_daily_volume,
    "daily_volume_lineitem": lineitem_daily_volume,
    "parse_timestamp": parse_timestamp,
    "extract_nums": extract_nums,
    "extract_props": extract_props,
    "parse_volume": parse_volume,
    "clean_transactions": clean_transactions,
    "dead_letters": events_dead_letters,
    "reject_counts": events_reject_counts,
    "volume_outliers": volume_outliers,
    "usd_lookup": usd_lookup,
    "unknown_currency": unknown_currency,
    "merge_partials": merge_bucket_partials,
    "replicate": replicate_daily_volume,
    "scan_project": scan_project,
    "price_last_wins": price_last_wins,
    "csv_round_trip": csv_round_trip,
    "dead_letter_round_trip": dead_letter_round_trip,
    "partitioned_table": partitioned_table,
    "stream_daily_volume": stream_daily_volume,
    "price_pages": price_pages,
    "job_daily_volume": job_daily_volume,
    "job_dead_letters": job_dead_letters,
    "malformed_rows": malformed_rows,
    "price_quoted_lines": price_quoted_lines,
    "trap_rows": trap_rows,
    "table_append": table_append,
    "price_snapshot": price_snapshot_csv,
    "run_counters": run_counters,
    "unknown_abort": unknown_abort,
    "stream_dead_letters": stream_rejects,
    "daily_volume_exact": daily_volume_exact,
    "stream_running_reduce": stream_running_reduce,
    "stream_price_versions": stream_price_versions,
    "table_rerun": table_rerun,
    "row_count_batches": row_count_batches,
}
