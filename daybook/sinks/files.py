"""CSV sinks: daily aggregates with a header (K1), dead letters without one (K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.aggregate import AGG_COLUMNS
from daybook.operators.clean import DEAD_LETTER_COLUMNS
from daybook.sources.files import resolve_path

AGG_CSV_SCHEMA = T.StructType([
    T.StructField("Date", T.StringType()),
    T.StructField("ProjectId", T.StringType()),
    T.StructField("NumberOfTransactions", T.LongType()),
    T.StructField("TotalVolumeUsd", T.DoubleType()),
])
DEAD_LETTER_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in DEAD_LETTER_COLUMNS])


def csv_writer(df: DataFrame, mode: str = "overwrite", header: bool = True):
    """A CSV writer that keeps every text as it is: doubled quotes, blanks at either end kept."""
    return (df.write.mode(mode).option("header", header).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_aggregates_csv(agg: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``Date,ProjectId,NumberOfTransactions,TotalVolumeUsd`` CSV with a header."""
    csv_writer(agg.select(*AGG_COLUMNS), mode, True).csv(resolve_path(path))


def write_dead_letters_csv(dead: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write dead letters as CSV without a header: Reason, then the raw row."""
    csv_writer(dead.select(*DEAD_LETTER_COLUMNS), mode, False).csv(resolve_path(path))


def read_aggregates_csv(spark: SparkSession, path: str) -> DataFrame:
    df = (spark.read.option("header", True).option("escape", '"').option("mode", "FAILFAST")
          .option("multiLine", True).option("enforceSchema", False).schema(AGG_CSV_SCHEMA).csv(resolve_path(path)))
    return df.withColumn("ProjectId", F.coalesce("ProjectId", F.lit("")))


def read_dead_letters_csv(spark: SparkSession, path: str) -> DataFrame:
    df = (spark.read.option("header", False).option("escape", '"').option("mode", "FAILFAST")
          .option("multiLine", True)      # a raw field may hold line breaks
          .schema(DEAD_LETTER_SCHEMA).csv(resolve_path(path)))
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in DEAD_LETTER_COLUMNS])
