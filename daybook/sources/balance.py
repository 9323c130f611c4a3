"""Spreading an under-split scan over the cluster."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# A scan with fewer splits than this share of the cores is spread.
UNDER_SPLIT = 0.25


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """``df`` over ``min_partitions`` tasks (the cores) when its scan yields few splits for them.

    A file that cannot be split (one parquet row group, a gzip CSV, a
    multi-line CSV) arrives in a single task, and all per-row parsing would
    then run on one core.  A shuffle of raw rows pays only then: a scan with at
    least a quarter as many splits as cores is returned unchanged.
    Counting partitions plans the scan but runs no job.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        partitions = df.rdd.getNumPartitions()
    except (AttributeError, NotImplementedError, PySparkException):   # a Spark Connect session has no RDD view
        return df
    if partitions >= target * UNDER_SPLIT:
        return df
    # Hash on the row's position in its input split: unique, so even a run of
    # identical rows is spread, and the same on a task retry, so no sort is
    # needed to make the redistribution deterministic.
    position = F.monotonically_increasing_id()
    return df.repartition(target, position)
