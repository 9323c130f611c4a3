"""File sources: transaction CSV (S1, S2), price CSV (S4), price pages (S5), paths.

CSV columns are bound by header name: all files of one read must share one
header (a file with another one fails the read), or, with ``mixed_headers``,
files are grouped by header and each group is read by its own names.  A quote
inside a quoted field is written as two quotes, quoted fields may hold line breaks
(:mod:`daybook.sources.records`).  Empty fields become ``""`` (the raw model has no NULLs).

Every record is split whole, whatever columns are used, and keeps its text in the
corrupt-record column if it has too few or too many fields or breaks the quoting rule.
"""

from __future__ import annotations

import urllib.parse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import parse_json_strict_sql, strict_double_sql
from daybook.operators.clean import MALFORMED_ROW, RAW_COLUMNS, evaluate_once
from daybook.operators.prices import PRICE_CSV_COLUMNS, latest_prices
from daybook.sources.balance import spread
from daybook.sources.records import csv_records, header_line, line_records, parse_records

ON_MALFORMED = ("fail", "dead_letter")
CORRUPT = "_corrupt_record"

# URI schemes that go by another name in Hadoop.
SCHEME_MAP = {"s3": "s3a"}

# Field names of one coin in a price page, and their CSV header names.
PAGE_FIELDS = (("id", "ID"), ("symbol", "Symbol"), ("name", "Name"), ("current_price", "Price (USD)"))
# Fixed value: coins in a full price page.
PAGE_SIZE = 250


def resolve_path(path: str) -> str:
    """Map a user path to a Hadoop URI.

    ``s3://`` becomes ``s3a://`` (the Hadoop S3 connector); other URIs and
    bare paths pass through, so a bare path resolves against the cluster's
    default file system.
    """
    if "://" not in path:
        return path
    scheme, rest = path.split("://", 1)
    return f"{SCHEME_MAP.get(scheme, scheme)}://{rest}"


def _csv_options(reader, multi_line: bool):
    return reader.option("header", True).option("escape", '"').option("multiLine", multi_line)


def csv_schema(header: list[str]) -> T.StructType:
    """All-text schema of a header, with the corrupt-record column."""
    return T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])


def checked_csv(reader, header: list[str], multi_line: bool = False):
    """``reader`` (batch or stream) set to read files with exactly this header.

    Rows that do not fit keep their text in the corrupt-record column; a file
    whose header differs fails the read instead of being bound by position.
    """
    return (
        _csv_options(reader, multi_line)
        .schema(csv_schema(header))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", False)
        .option("columnPruning", False)     # else a row's fields are not counted when columns are left out
    )


def with_guard(df: DataFrame) -> DataFrame:
    """A checked read whose corrupt-record column also refers to the first file column.

    Spark refuses a query that reads the corrupt-record column alone, which a
    count over checked rows would be.
    """
    nothing = F.coalesce(F.substring(F.col(f"`{df.columns[0]}`"), 1, 0), F.lit(""))
    return df.withColumn(CORRUPT, F.concat(F.col(CORRUPT), nothing))


def csv_header(spark: SparkSession, uri: str | list[str], multi_line: bool = False) -> list[str]:
    """Column names of the first file."""
    names = _csv_options(spark.read, multi_line).csv(uri).columns
    if not names:
        raise ValueError(f"no header: {uri} has no line")
    return names


def _files_by_header(spark: SparkSession, uri: str, multi_line: bool) -> list[tuple[list[str], list[str]]]:
    """(header, files) groups.  Reads each file's first line; one row per distinct header is collected with its files."""
    lines = spark.read.text(uri).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value",
        F.monotonically_increasing_id().alias("line"))
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "line").alias("head"))
    groups = first.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    out = []
    for g in sorted(groups, key=lambda r: r.files[0]):
        files = [urllib.parse.unquote(f) for f in g.files]
        out.append((csv_header(spark, files[:1], multi_line), files))
    return out


def conform_raw(df: DataFrame, *keep: str) -> DataFrame:
    """The five raw columns by name (NULL or missing ones become ``""``), and the columns ``keep``."""
    present = set(df.columns)
    return df.select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in present else F.lit("").alias(c)
          for c in RAW_COLUMNS], *keep
    )


def reject_malformed(df: DataFrame) -> DataFrame:
    """Rows of a checked CSV read without the corrupt-record column; a malformed row fails the job.

    The check is a filter, so it also holds when no column of the row is used.
    """
    text = F.concat(F.lit(f"{MALFORMED_ROW}: "), F.col(CORRUPT))
    fits = F.when(F.col(CORRUPT).isNotNull(), F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
    return df.where(fits).drop(CORRUPT)


def malformed_reason() -> Column:
    return F.concat(F.lit(f"{MALFORMED_ROW}: "), F.coalesce(F.col(CORRUPT), F.lit("")))


def read_records(spark: SparkSession, uri: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """CSV files with one header as text columns, the corrupt-record column, and ``file``, ``block``, ``n``: the record's place."""
    header = csv_header(spark, uri)
    records = csv_records(spark, uri, multi_line)
    clash = {c.lower() for c in header}
    place = {c: c if c not in clash else f"_{c}" for c in ("file", "block", "n", "record")}
    parsed = parse_records(records.select("record", F.struct("file", "block", "n").alias("_place")), header, CORRUPT)
    return parsed.select(*[F.col(f"`{c}`") for c in header], CORRUPT, *[F.col(f"_place.{c}").alias(place[c]) for c in ("file", "block", "n")])


def stream_records(spark: SparkSession, uri: str, header: list[str], reader) -> DataFrame:
    """Streaming counterpart of :func:`read_records`, each line a record, for a configured stream reader."""
    return parse_records(line_records(reader, uri, header_line(spark, uri)), header, CORRUPT)


def read_raw(spark: SparkSession, path: str, multi_line: bool | None = None, mixed_headers: bool = False) -> DataFrame:
    """Transaction CSV file(s) as the five raw text columns and the corrupt-record column (NULL where a row fits)."""
    uri = resolve_path(path)
    groups = [files for _, files in _files_by_header(spark, uri, False)] if mixed_headers else [uri]
    out = None
    for files in groups:
        part = conform_raw(read_records(spark, files, multi_line), CORRUPT)
        out = part if out is None else out.unionByName(part)
    return spread(out)


def read_transactions(
    spark: SparkSession,
    path: str,
    on_malformed: str = "fail",
    multi_line: bool | None = None,
    mixed_headers: bool = False,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Read transaction CSV file(s) into the five raw text columns.

    A row with the wrong number of fields or a misplaced quote fails the job
    (``on_malformed="fail"``), or, with ``"dead_letter"``, the call returns
    ``(rows, malformed)`` where ``malformed`` has dead-letter shape with reason
    ``malformed CSV row``.  Quoted fields may hold line breaks; files are read in
    splits all the same.  Whether there are any takes one pass over the lines, which
    ``multi_line=False`` (every line is a record) or ``True`` (they are put together in any case) saves.
    ``mixed_headers`` reads files whose headers differ, at the price of one more
    pass over their lines.
    """
    if on_malformed not in ON_MALFORMED:
        raise ValueError(f"on_malformed must be one of {ON_MALFORMED}")
    raw = read_raw(spark, path, multi_line, mixed_headers)
    if on_malformed == "fail":
        return reject_malformed(raw)
    rows = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    malformed = raw.where(F.col(CORRUPT).isNotNull()).select(
        malformed_reason().alias("Reason"), *RAW_COLUMNS, F.lit(MALFORMED_ROW).alias("reason_code"))
    return rows, malformed


def read_price_rows(spark: SparkSession, path: str) -> DataFrame:
    """Price CSV rows with a ``_row_order`` that follows the files' line order.

    A row with the wrong number of fields or a misplaced quote fails the job.  The order is (file path, split
    start, position in the split), which is the order of records across all input files sorted by path.
    """
    df = read_records(spark, resolve_path(path))
    missing = [c for c in ("Symbol", "Price (USD)") if c not in df.columns]
    if missing:
        raise ValueError(f"price file lacks columns {missing}")
    rows = df.select(
        *[F.col(f"`{c}`") if c in df.columns else F.lit("").alias(c) for c in PRICE_CSV_COLUMNS],
        F.struct(*[F.col(f"`{c}`") for c in df.columns[-3:]]).alias("_row_order"),
        CORRUPT,
    )
    return reject_malformed(rows)


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Price CSV → lookup table (symbol upper-cased, last row per symbol wins).

    A price text that is not a finite number fails the job (it would poison every
    sum that it enters); an empty price is 0.0.
    """
    rows = read_price_rows(spark, path)
    text = "trim(coalesce(`Price (USD)`, ''))"
    number = strict_double_sql(text)
    parsed = F.expr(
        f"CASE WHEN {text} = '' THEN 0D "
        f"ELSE coalesce(nullif(nullif(nullif({number}, double('NaN')), double('inf')), double('-inf')), "
        f"CAST(raise_error(concat('price is not a number: ', {text})) AS double)) END"
    )
    return latest_prices(rows.withColumn("Price (USD)", parsed))


def read_price_pages(spark: SparkSession, path: str, multi_line: bool = False, page_size: int | None = PAGE_SIZE) -> DataFrame:
    """Landed price pages (JSON arrays of coins) → ID, Symbol, Name, Price (USD).

    Each array becomes one row per element.  ``multi_line`` reads pretty-printed
    page files (one document per file); otherwise each line is one page.
    Pages count in the order of file path and line, up to and with the first one of fewer than
    ``page_size`` coins, which ends the list (None: all pages count).  A missing price is 0.0, a
    missing text ``""``; a page that is no array, a number for a text or a text for a price fails the job.
    """
    texts = spark.read.text(resolve_path(path), wholetext=multi_line, lineSep=None if multi_line else "\n")
    lines = texts.where("trim(value, ' \t\r\n') <> ''").select(
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("n")).alias("place"),
        "value")
    pages = evaluate_once(lines, doc=parse_json_strict_sql("value"))
    is_array = F.expr("doc IS NOT NULL AND startswith(schema_of_variant(doc), 'ARRAY')")
    fault = F.raise_error(F.concat(F.lit("a price page is not a JSON array: "), F.left("value", F.lit(200)))).cast("boolean")
    pages = pages.where(F.when(is_array, True).otherwise(fault)).select("place", F.expr("variant_get(doc, '$', 'array<variant>')").alias("coins"))
    if page_size is not None:
        # One value comes back: the place of the first short page.
        short = pages.where(F.size("coins") < page_size).agg(F.min("place")).first()[0]
        if short is not None:
            last = F.struct(F.lit(short[0]), *[F.lit(v).cast("bigint") for v in short[1:]])
            pages = pages.where(F.col("place") <= last)
    coins = pages.select(F.explode("coins").alias("coin")).select(
        "coin", *[F.expr(f"try_variant_get(coin, '$.{name}')").alias(f"_{name}") for name, _ in PAGE_FIELDS])

    def fits(name: str) -> str:
        kind = f"schema_of_variant(_{name})"
        numeric = f"({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT', 'VOID') OR startswith({kind}, 'DECIMAL'))"
        return f"(_{name} IS NULL OR {numeric if name == 'current_price' else f"{kind} IN ('STRING', 'VOID')"})"

    is_coin = "(is_variant_null(coin) OR startswith(schema_of_variant(coin), 'OBJECT'))"
    typed = F.expr(" AND ".join([is_coin, *(fits(name) for name, _ in PAGE_FIELDS)]))
    fault = F.raise_error(F.concat(F.lit("a coin of a price page has a field of another type: "), F.to_json("coin"))).cast("boolean")
    return coins.where(F.when(typed, True).otherwise(fault)).select(*[
        F.expr(f"coalesce(try_variant_get(_{src}, '$', 'double'), 0D)" if src == "current_price"
               else f"coalesce(try_variant_get(_{src}, '$', 'string'), '')").alias(dst)
        for src, dst in PAGE_FIELDS])
