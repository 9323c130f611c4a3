"""Micro-batch pipeline with Structured Streaming (S3, M1, M2, M3).

``readStream`` over a folder of transaction CSV files → ``foreachBatch``:
each micro-batch is read and classified once and its outcomes are landed (as the
batch job lands them); clean rows are reduced to partial daily aggregates, and
both the partials and the dead letters are written under ``batch_id=<n>`` with
dynamic partition overwrite, so a batch replayed after a failure replaces its
own output instead of adding to it.  The final aggregate is the merge of all
partials (A2).

Micro-batch size is set in files or bytes per trigger (``max_files_per_trigger``
/ ``max_bytes_per_trigger``); Spark's file source has no row-count trigger.
Price lists are kept in the work folder as versions: a run whose list differs from the latest one
writes a new folder and then notes it in a log, so a half-written list is never read.  A batch whose outputs
are written is noted with its version, and a replay of it is priced as it was the first time; a batch that has
failed is priced by the list of the run that works on it again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import MAX_VOLUME
from daybook.operators.aggregate import daily_volume, merge_partials
from daybook.operators.clean import DEAD_LETTER_COLUMNS
from daybook.operators.convert import MAX_BROADCAST_BYTES, ON_UNKNOWN, fits_broadcast
from daybook.plans.jobs import landed_clean, landed_dead, landing
from daybook.session import configure, scratch_path
from daybook.sources.files import (
    CORRUPT,
    ON_MALFORMED,
    checked_csv,
    conform_raw,
    csv_header,
    reject_malformed,
    resolve_path,
    stream_records,
    with_guard,
)

# A micro-batch holds about this many bytes of files unless told otherwise.
BATCH_BYTES = 1 << 30
PARTIAL_SCHEMA = ("Date string, ProjectId string, NumberOfTransactions bigint, TotalVolumeUsd double, batch_id bigint")
PRICE_LOG_SCHEMA = "version int, path string, n bigint, digest decimal(38,0)"
DEAD_SCHEMA = ", ".join(f"{c} string" for c in (*DEAD_LETTER_COLUMNS, "reason_code")) + ", batch_id bigint"

BatchFn = Callable[[DataFrame, int], None]


@dataclass
class StreamRun:
    """Where one streaming run keeps its state and outputs, and its counters (M3)."""

    checkpoint: str
    partials: str
    dead_letters: str
    lookup: str = ""
    price_version: int = -1
    batches: int = 0
    rows_read: int = 0
    clean_rows: int = 0
    rejected_rows: int = 0
    compacted: str | None = None
    compacted_through: int = -1


def header_schema(spark: SparkSession, source_dir: str, multi_line: bool = False) -> T.StructType:
    """All-text schema from the header of the files already in ``source_dir``."""
    return T.StructType([T.StructField(c, T.StringType()) for c in csv_header(spark, resolve_path(source_dir), multi_line)])


def transaction_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    on_malformed: str = "fail",
    multi_line: bool = False,
) -> DataFrame:
    """Streaming raw transactions (five text columns) from CSV files landing in ``source_dir``.

    Micro-batches hold ``max_files_per_trigger`` files or about
    ``max_bytes_per_trigger`` bytes (whole files, at least one per batch;
    ``BATCH_BYTES`` if neither is given).  Rows are checked as in the batch read:
    a malformed one fails the stream, or with ``"dead_letter"`` keeps its text in
    the corrupt-record column, which the per-batch function turns into a dead letter.
    """
    if on_malformed not in ON_MALFORMED:
        raise ValueError(f"on_malformed must be one of {ON_MALFORMED}")
    header = (schema or header_schema(spark, source_dir, multi_line)).names
    reader = checked_csv(spark.readStream, header, multi_line) if multi_line else spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger or not max_files_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger or BATCH_BYTES))
    uri = resolve_path(source_dir)
    rows = with_guard(reader.csv(uri)) if multi_line else stream_records(spark, uri, header, reader)
    raw = conform_raw(rows, CORRUPT)
    return reject_malformed(raw) if on_malformed == "fail" else raw


class PriceVersions:
    """The price lists of a work folder, and which one each finished batch was priced by."""

    def __init__(self, spark: SparkSession, work_dir: str, max_broadcast_bytes: int = MAX_BROADCAST_BYTES):
        self.work_dir, self.max_broadcast_bytes = work_dir, max_broadcast_bytes
        self.paths = {r.version: r.path for r in self._log(spark).collect()}      # one row a list
        self.current = max(self.paths, default=-1)
        self._broadcast: dict[int, bool] = {}

    def _log(self, spark: SparkSession) -> DataFrame:
        return _existing(spark, f"{self.work_dir}/price-log", PRICE_LOG_SCHEMA)

    def take(self, lookup: DataFrame) -> int:
        """Make ``lookup`` the current list: a new version, unless it equals the latest one."""
        spark = lookup.sparkSession
        path = f"{self.work_dir}/prices/{uuid.uuid4().hex}"
        lookup.write.parquet(path)
        facts = spark.read.schema(lookup.schema).parquet(path).agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.xxhash64("symbol", "price").cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("digest"))
        n, digest = facts.first()
        latest = self._log(spark).where(F.col("version") == self.current).first()
        if latest is None or (latest.n, latest.digest) != (n, digest):
            self.current += 1
            self.paths[self.current] = path
            (spark.createDataFrame([(self.current, path, n, digest)], PRICE_LOG_SCHEMA).coalesce(1)
             .write.mode("append").parquet(f"{self.work_dir}/price-log"))
        return self.current

    def _noted(self, batch_id: int) -> str:
        return f"{self.work_dir}/batch-prices/batch_id={batch_id}"

    def of_batch(self, spark: SparkSession, batch_id: int) -> int:
        """The version of a batch: the one it was finished with, else the current one."""
        try:
            rows = spark.read.schema("version int").parquet(self._noted(batch_id))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.current      # as a rule: no job asks an empty table
        noted = rows.agg(F.max("version")).first()[0]
        return self.current if noted is None else noted

    def note(self, spark: SparkSession, batch_id: int, version: int) -> None:
        spark.range(1, numPartitions=1).select(F.lit(version).cast("int").alias("version")).write.mode("overwrite").parquet(self._noted(batch_id))

    def lookup(self, spark: SparkSession, version: int) -> tuple[DataFrame, bool]:
        """A version's list, and whether it is small enough to broadcast."""
        rows = spark.read.schema("symbol string, price double").parquet(self.paths[version])
        if version not in self._broadcast:
            self._broadcast[version] = fits_broadcast(rows, self.max_broadcast_bytes)
        return rows, self._broadcast[version]


def daily_volume_batches(
    prices: PriceVersions,
    partials_path: str,
    dead_path: str,
    max_volume: float = MAX_VOLUME,
    counters: dict[int, tuple[int, int]] | None = None,
    on_unknown: str = "fail",
) -> BatchFn:
    """The per-batch function: land the outcomes once, write partials and dead letters for ``batch_id``.

    When ``counters`` is given, (rows, clean rows) of each batch are recorded
    under its id, so a replayed batch is counted once.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        configure(spark)
        version = prices.of_batch(spark, batch_id)
        lookup, broadcast = prices.lookup(spark, version)
        with landing(spark, batch, lookup, broadcast, on_unknown, max_volume, f"batch-{batch_id}") as landed:
            for rows, target in ((daily_volume(landed_clean(landed.rows), lookup, broadcast=broadcast), partials_path),
                                 (landed.count_dead(landed_dead(landed.rows, "reason_code")), dead_path)):
                (rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target))
            if counters is not None:
                counters[batch_id] = (landed.rows_read, landed.rows_read - landed.dead_rows)
        prices.note(spark, batch_id, version)

    return run


def _counted(fn: BatchFn, spark: SparkSession, name: str, seen: dict[int, int]) -> BatchFn:
    """``fn``, noting before each batch the rows of the one before from the progress of the query called ``name``.

    A query keeps only its last progress updates; taking them down batch by batch
    makes the counters exact for a run of any length.  Other queries of the session do not count.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        for query in spark.streams.active:
            if query.name == name:
                _note(query, seen)
        fn(batch, batch_id)

    return run


def _note(query, seen: dict[int, int]) -> None:
    for p in query.recentProgress:
        p = json.loads(p.json) if hasattr(p, "json") else p
        seen[int(p["batchId"])] = max(seen.get(int(p["batchId"]), 0), int(p["numInputRows"]))


def open_run(spark: SparkSession, work_dir: str) -> StreamRun:
    """The run kept in ``work_dir``, with what has been compacted there."""
    run = StreamRun(checkpoint=f"{work_dir}/checkpoint", partials=f"{work_dir}/partials",
                    dead_letters=f"{work_dir}/dead_letters")
    prices = PriceVersions(spark, work_dir)
    run.price_version, run.lookup = prices.current, prices.paths.get(prices.current, "")
    done = _existing(spark, f"{work_dir}/compactions", "through bigint, path string").orderBy(F.desc("through")).first()
    if done is not None:
        run.compacted, run.compacted_through = done["path"], int(done["through"])
    return run


def _existing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The parquet table at ``path``, or an empty one where nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_daily_volume_stream(
    spark: SparkSession,
    raw_stream: DataFrame,
    lookup: DataFrame,
    work_dir: str | None = None,
    max_volume: float = MAX_VOLUME,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    on_batch: BatchFn | None = None,
    on_unknown: str = "fail",
) -> StreamRun:
    """Run the micro-batch pipeline over everything available now, then stop.

    ``on_batch`` replaces the per-batch function (M2: any DataFrame → output
    function of (batch, batch_id)); the default is :func:`daily_volume_batches`.
    A later run with the same ``work_dir`` continues where the last one stopped.
    """
    if on_unknown not in ON_UNKNOWN:
        raise ValueError(f"on_unknown must be one of {ON_UNKNOWN}")
    configure(spark)
    work_dir = work_dir or scratch_path(spark, "stream")
    prices = PriceVersions(spark, work_dir, max_broadcast_bytes)
    prices.take(lookup)
    run = open_run(spark, work_dir)
    counters: dict[int, tuple[int, int]] = {}
    seen: dict[int, int] = {}
    name = f"daily-volume-{uuid.uuid4().hex}"
    fn = (_counted(on_batch, spark, name, seen) if on_batch is not None else daily_volume_batches(
        prices, run.partials, run.dead_letters, max_volume, counters, on_unknown))
    query = (
        raw_stream.writeStream.queryName(name).foreachBatch(fn)
        .option("checkpointLocation", run.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if on_batch is None:
        run.batches = sum(1 for rows, _ in counters.values() if rows > 0)
        run.rows_read = sum(rows for rows, _ in counters.values())
        run.clean_rows = sum(clean for _, clean in counters.values())
        run.rejected_rows = run.rows_read - run.clean_rows
    else:
        _note(query, seen)
        run.batches = sum(1 for rows in seen.values() if rows > 0)
        run.rows_read = sum(seen.values())
    return run


def _open_partials(spark: SparkSession, run: StreamRun) -> DataFrame:
    """Compacted partials plus the partials of later batches (pruned on batch_id)."""
    later = (_existing(spark, run.partials, PARTIAL_SCHEMA).where(F.col("batch_id") > run.compacted_through)
             .drop("batch_id"))
    if run.compacted is None:
        return later
    return spark.read.parquet(run.compacted).unionByName(later)


def merged_daily_volume(spark: SparkSession, run: StreamRun) -> DataFrame:
    """Final daily aggregates: merge of every batch's partials."""
    return merge_partials(_open_partials(spark, run))


def compact_partials(spark: SparkSession, run: StreamRun, through_batch: int) -> StreamRun:
    """Fold the partials of batches up to ``through_batch`` into one table.

    The result goes to a new folder (the input is never overwritten) which is
    noted beside the partials, so a later run finds it; merges then read it plus
    the partials of later batches only.  A batch that has not been written yet
    is never counted as folded: ``through_batch`` is lowered to the last one there.
    """
    partials = _existing(spark, run.partials, PARTIAL_SCHEMA)
    newest = partials.agg(F.max("batch_id")).first()[0]
    through_batch = min(through_batch, -1 if newest is None else int(newest))
    if through_batch <= run.compacted_through:
        return run
    current = (spark.read.parquet(run.compacted) if run.compacted is not None else None)
    newer = (partials.where((F.col("batch_id") > run.compacted_through) & (F.col("batch_id") <= through_batch))
             .drop("batch_id"))
    folded = merge_partials(newer if current is None else current.unionByName(newer))
    base = run.partials.rsplit("/", 1)[0]
    target = f"{base}/compacted-through-{through_batch}"
    folded.write.mode("overwrite").parquet(target)
    (spark.createDataFrame([(through_batch, target)], "through bigint, path string").coalesce(1)
     .write.mode("append").parquet(f"{base}/compactions"))
    run.compacted, run.compacted_through = target, through_batch
    return run


def stream_dead_letters(spark: SparkSession, run: StreamRun) -> DataFrame:
    return _existing(spark, run.dead_letters, DEAD_SCHEMA)
