"""Row replication to scale a sample up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Copies of one row that are generated inside one task.
COPIES_PER_TASK = 64


def replicate(df: DataFrame, copies: int, copy_col: str | None = None) -> DataFrame:
    """Each row ``copies`` times, generated in place (no join).

    ``copy_col`` optionally names a column holding the copy number 0..copies-1.
    Few copies stay in the task that reads the row.  For many, each row first
    becomes one row per ``COPIES_PER_TASK`` copies, these are dealt over all
    tasks by a hash of the copy number and the row's position, and the copies
    are generated there; so a sample of one split uses the whole cluster, and
    only 1/``COPIES_PER_TASK`` of the result is shuffled.
    """
    if copies < 1:
        raise ValueError("copies must be at least 1")
    name = copy_col or "_copy"
    if copies <= COPIES_PER_TASK:
        out = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(name))
    else:
        starts = F.sequence(F.lit(0), F.lit(copies - 1), F.lit(COPIES_PER_TASK))
        portions = (df.select("*", F.monotonically_increasing_id().alias("_row"))
                    .select("*", F.explode(starts).alias("_first")))
        last = F.least(F.col("_first") + (COPIES_PER_TASK - 1), F.lit(copies - 1))
        tasks = df.sparkSession.sparkContext.defaultParallelism
        out = (portions.repartition(tasks, "_row", "_first")
               .select(*df.columns, F.explode(F.sequence("_first", last)).alias(name)))
    return out if copy_col else out.drop(name)
