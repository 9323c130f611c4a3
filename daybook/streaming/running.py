"""Daily volume as a running reduce: the aggregate lives in Spark's state store (M1).

Two streaming queries, each with its own checkpoint:

1. *landing*: the source is read and classified once, and every row's outcome
   is appended to one table by the file sink, whose commit log makes a replayed batch count once;
2. *reducing*: the landed clean rows are priced and added to a stateful
   aggregation keyed by (Date, project, bucket of size), whose state holds counts and
   exact sums (:mod:`daybook.operators.exact`).  Each batch writes the keys it changed
   under its batch id, so a replay replaces its own rows.

The result is the latest row of each key.  As the state is exact, it has the
same bits however the input is cut into batches and wherever a run stops.
A later run with the same folder goes on from the state; its price list holds for the rows that it adds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import MAX_VOLUME
from daybook.operators.convert import MAX_BROADCAST_BYTES, ON_UNKNOWN, attach_prices, fits_broadcast
from daybook.operators.exact import EXACT_PARTIAL_COLUMNS, LIMBS, exact_totals, with_limbs
from daybook.plans.jobs import CLEAN, landed_clean, landed_dead, outcomes
from daybook.session import configure, scratch_path

CHANGED_SCHEMA = ("Date string, ProjectId string, bucket int, NumberOfTransactions bigint, _h bigint, _m bigint, _l bigint, "
                  "_special double, batch_id bigint")


@dataclass
class RunningReduce:
    """Where one running reduce keeps its landed rows, its checkpoints and its result."""

    work_dir: str

    @property
    def landed(self) -> str:
        return f"{self.work_dir}/landed"

    @property
    def changed(self) -> str:
        return f"{self.work_dir}/changed"

    def checkpoint(self, query: str) -> str:
        return f"{self.work_dir}/checkpoint-{query}"


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def run_running_daily_volume(
    spark: SparkSession,
    raw_stream: DataFrame,
    lookup: DataFrame,
    work_dir: str | None = None,
    max_volume: float = MAX_VOLUME,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    on_unknown: str = "fail",
) -> RunningReduce:
    """Add everything that is there now to the running totals, then stop."""
    if on_unknown not in ON_UNKNOWN:
        raise ValueError(f"on_unknown must be one of {ON_UNKNOWN}")
    configure(spark)
    run = RunningReduce(work_dir or scratch_path(spark, "running"))
    broadcast = fits_broadcast(lookup, max_broadcast_bytes)
    if on_unknown == "dead_letter" and not broadcast:
        raise ValueError("unknown symbols can only become dead letters here if the price list is small enough to broadcast")
    rows = outcomes(raw_stream, lookup, broadcast, on_unknown, max_volume)
    _finish(rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", run.checkpoint("landing"))
            .trigger(availableNow=True).start(run.landed))

    landed = spark.readStream.schema(rows.schema).parquet(run.landed)
    priced = attach_prices(landed_clean(landed), lookup, broadcast)
    limbs = with_limbs(priced.select(F.date_format("ts", "yyyy-MM-dd").alias("Date"), F.col("project_id").alias("ProjectId"), "usd"), "usd")
    totals = limbs.groupBy("Date", "ProjectId", "bucket").agg(
        F.count(F.lit(1)).alias("NumberOfTransactions"), *[F.sum(c).alias(c) for c in (*LIMBS, "_special")])

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(run.changed))

    _finish(totals.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", run.checkpoint("reducing"))
            .trigger(availableNow=True).start())
    return run


def running_daily_volume(spark: SparkSession, run: RunningReduce) -> DataFrame:
    """Current totals: Date, ProjectId, NumberOfTransactions, TotalVolumeUsd."""
    from daybook.streaming.microbatch import _existing

    changed = _existing(spark, run.changed, CHANGED_SCHEMA)
    values = [c for c in EXACT_PARTIAL_COLUMNS if c not in ("Date", "ProjectId", "bucket")]
    latest = changed.groupBy("Date", "ProjectId", "bucket").agg(F.max_by(F.struct(*values), "batch_id").alias("_last"))
    return exact_totals(latest.select("Date", "ProjectId", "bucket", "_last.*"))


def running_dead_letters(spark: SparkSession, run: RunningReduce) -> DataFrame:
    """Rejected rows of all batches: Reason, the raw row, reason_code (read through the file sink's commit log)."""
    landed = spark.read.parquet(run.landed)
    return landed_dead(landed, "reason_code")


def running_counters(spark: SparkSession, run: RunningReduce) -> tuple[int, int]:
    """(rows read, clean rows) of all batches."""
    row = spark.read.parquet(run.landed).agg(F.count(F.lit(1)), F.count_if(F.col("kind") == CLEAN)).first()
    return int(row[0]), int(row[1])
