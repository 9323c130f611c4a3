"""Table sink: daily aggregates partitioned by Date, clustered by ProjectId (K3-K7).

``table://<catalog>/<database>/<table>`` names a catalog table; anything else
is a file location (:mod:`daybook.sinks.files`).  The table is created when
missing and left alone when present.  ``mode="append"``, the default, adds rows
(a re-run duplicates them); ``mode="replace"`` overwrites exactly the Date
partitions present in the new data (dynamic partition overwrite), so a re-run
of the same input is idempotent, but a second input for a Date replaces the
first.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.sinks.files import write_aggregates_csv

TABLE_SCHEME = "table"
TABLE_COLUMNS_DDL = "Date DATE, ProjectId STRING, NumberOfTransactions BIGINT, TotalVolumeUsd DOUBLE"
WRITE_MODES = ("append", "replace")


def parse_table_uri(uri: str) -> tuple[str, str, str]:
    """``table://catalog/database/table`` → (catalog, database, table); exactly two path parts."""
    if not uri.startswith(f"{TABLE_SCHEME}://"):
        raise ValueError(f"not a {TABLE_SCHEME}:// target: {uri!r}")
    parsed = urlparse(uri)
    parts = parsed.path.strip("/").split("/")
    if not parsed.netloc or len(parts) != 2 or not all(parts):
        raise ValueError(f"a table target names catalog, database and table, not {uri!r}")
    return parsed.netloc, parts[0], parts[1]


def table_rows(agg: DataFrame) -> DataFrame:
    """Aggregates as table rows: typed Date and every column required (non-NULL)."""
    def required(name: str, value):
        return F.when(value.isNull(), F.raise_error(F.lit(f"{name} must not be NULL"))).otherwise(value)

    return agg.select(
        required("ProjectId", F.col("ProjectId")).alias("ProjectId"),
        required("NumberOfTransactions", F.col("NumberOfTransactions").cast("bigint")).alias("NumberOfTransactions"),
        required("TotalVolumeUsd", F.col("TotalVolumeUsd").cast("double")).alias("TotalVolumeUsd"),
        required("Date", F.to_date("Date")).alias("Date"),
    )


def clustered(rows: DataFrame) -> DataFrame:
    """Range-partition on (Date, ProjectId) and sort, so each task writes few, ordered files.

    Range partitioning samples the keys, so a Date holding most rows is split
    across tasks instead of landing in one.
    """
    return rows.repartitionByRange("Date", "ProjectId").sortWithinPartitions("Date", "ProjectId")


TABLE_LAYOUT = {
    "ProjectId": "string",
    "NumberOfTransactions": "bigint",
    "TotalVolumeUsd": "double",
    "Date": "date",
}


def ensure_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the aggregate table if it does not exist; an existing table is kept as is.

    An existing table must have the aggregate layout (rows are inserted by
    position), otherwise this raises instead of writing misplaced values.
    """
    if spark.catalog.tableExists(name):
        found = {f.name: f.dataType.simpleString() for f in spark.table(name).schema}
        if found != TABLE_LAYOUT or list(found) != list(TABLE_LAYOUT):
            raise ValueError(f"table {name} exists with columns {found}, expected {TABLE_LAYOUT}")
        return
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({TABLE_COLUMNS_DDL}) USING parquet PARTITIONED BY (Date){where}"
    )


def _observed(rows: DataFrame, obs: Observation | None) -> DataFrame:
    """Counts rows as they are written.  Placed above the range partitioning, whose sampling job also runs its input."""
    return rows.observe(obs, F.count(F.lit(1)).alias("n")) if obs is not None else rows


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Dynamic partition overwrite for the insert inside (a catalog insert takes no such write option), then as before."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _inserted(rows: DataFrame, name: str, mode: str) -> None:
    with _dynamic_overwrite(rows.sparkSession):
        rows.write.insertInto(name, overwrite=(mode == "replace"))


def write_table(agg: DataFrame, name: str, mode: str = "append", location: str | None = None,
                obs: Observation | None = None) -> None:
    """Write aggregates into catalog table ``name`` (created when missing)."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    ensure_table(agg.sparkSession, name, location)
    # table_rows puts Date last, matching the table's column order (partition column last).
    _inserted(_observed(clustered(table_rows(agg)), obs), name, mode)


def write_partitioned(agg: DataFrame, path: str, mode: str = "append") -> None:
    """Path-based variant of :func:`write_table`: parquet files under ``Date=...`` folders."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    (clustered(table_rows(agg)).write.mode("overwrite" if mode == "replace" else "append")
     .option("partitionOverwriteMode", "dynamic").partitionBy("Date").parquet(path))


def aggregate_sink(target: str, mode: str = "append", location: str | None = None,
                   obs: Observation | None = None) -> Callable[[DataFrame], None]:
    """Pick the writer for ``target``: a ``table://`` URI or a CSV location.

    ``obs``, if given, observes ``n``, the rows written.
    """
    if target.startswith(f"{TABLE_SCHEME}://"):
        catalog, database, table = parse_table_uri(target)
        name = f"{catalog}.{database}.{table}"
        return lambda agg: write_table(agg, name, mode, location, obs)
    return lambda agg: write_aggregates_csv(_observed(agg, obs), target)
