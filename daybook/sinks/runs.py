"""Aggregate table with re-runs by run id (K7).

Every row carries the id of the run that wrote it.  Writing a run again replaces
that run's rows, on whatever Dates they are, and leaves the rows of other runs
for the same Dates.

The table is a folder of immutable versions and a log.  A write copies the
touched Dates (those of the new rows and those of the run's earlier rows): the
current rows of other runs plus the new rows go to a new version folder, then one
row in the log makes it current for these Dates.  A reader takes each Date
from the latest version in the log that touched it, so it sees all of a write or
nothing, and a write that fails before its log entry leaves no trace but an unread folder.
Work and space of a write grow with the touched Dates, not with the table.

One writer at a time; versions that no Date reads any more may be deleted (:func:`unread_versions`).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sinks.table import clustered, table_rows

LOG_SCHEMA = "number bigint, version string, run_id string, dates array<date>"
DATA_SCHEMA = "ProjectId string, NumberOfTransactions bigint, TotalVolumeUsd double, run_id string, version string, Date date"


def _existing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_log(spark: SparkSession, base: str) -> DataFrame:
    """(number, version, run_id, dates): one row for each write."""
    return _existing(spark, f"{base}/log", LOG_SCHEMA)


def _current_versions(spark: SparkSession, base: str) -> DataFrame:
    """(Date, version): where each Date is read from."""
    log = run_log(spark, base).select("number", "version", F.explode("dates").alias("Date"))
    return log.groupBy("Date").agg(F.max_by("version", "number").alias("version"))


def read_runs(spark: SparkSession, base: str) -> DataFrame:
    """Current rows: Date, ProjectId, NumberOfTransactions, TotalVolumeUsd, run_id."""
    rows = _existing(spark, f"{base}/data", DATA_SCHEMA)
    # Both are partition columns: a version's Dates that another version replaced are pruned by the join.
    return rows.join(_current_versions(spark, base), ["Date", "version"]).select(
        "Date", "ProjectId", "NumberOfTransactions", "TotalVolumeUsd", "run_id")


def write_run(agg: DataFrame, base: str, run_id: str) -> str:
    """Make ``agg`` (Date, ProjectId, NumberOfTransactions, TotalVolumeUsd) the rows of ``run_id``; returns the new version."""
    spark = agg.sparkSession
    version = uuid.uuid4().hex
    target = f"{base}/data/version={version}"
    # The new rows alone first: their Dates are then read from the files, and ``agg`` is computed once.
    staged_path = f"{base}/staged/version={version}"
    table_rows(agg).write.parquet(staged_path)
    staged = spark.read.schema("ProjectId string, NumberOfTransactions bigint, TotalVolumeUsd double, Date date").parquet(staged_path)
    current = read_runs(spark, base)
    touched = staged.select("Date").union(current.where(F.col("run_id") == run_id).select("Date")).distinct()
    kept = current.where(F.col("run_id") != run_id).join(touched, "Date", "left_semi")
    columns = ["ProjectId", "NumberOfTransactions", "TotalVolumeUsd", "run_id", "Date"]
    rows = staged.withColumn("run_id", F.lit(run_id)).select(*columns).unionByName(kept.select(*columns))
    clustered(rows).write.partitionBy("Date").parquet(target)
    # One row, one file: its commit is the switch-over.  Its size is that of the touched Dates.
    number = run_log(spark, base).agg(F.coalesce(F.max("number"), F.lit(-1)) + 1).first()[0]
    entry = touched.agg(F.sort_array(F.collect_list("Date")).alias("dates"))
    (entry.select(F.lit(number).cast("bigint").alias("number"), F.lit(version).alias("version"), F.lit(run_id).alias("run_id"), "dates")
     .coalesce(1).write.mode("append").parquet(f"{base}/log"))
    _remove(spark, staged_path)
    return version


def _remove(spark: SparkSession, path: str) -> None:
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unread_versions(spark: SparkSession, base: str) -> DataFrame:
    """(version): versions in the log that no Date is read from any more."""
    return run_log(spark, base).select("version").distinct().join(
        _current_versions(spark, base).select("version").distinct(), "version", "left_anti")
