"""Micro-batches of a fixed number of rows (S3).

Rows are numbered through all files of a folder: files in the order in which
they were first seen (by time of change, then path), records in file order.  Batch
k holds the rows from k * n on, n of them, across file borders; what is left at the
end is flushed as a smaller last batch.  A later run finds the files that came since
and goes on behind the last row.

Two small logs keep the bounds: each file's first row and number of rows, and
each batch's range of rows, which is noted before the batch is worked on and closed after it.
A batch that failed is worked on again with the same rows, before any new one, and its id
lets its function replace what it has written.

Counting takes one pass over new files.  A batch reads only the files that hold
its rows; the place of a record in its file comes from the counts of the file's splits,
so no data is shuffled or sorted.

A batch costs some Spark jobs whatever its rows, so many small ones are worked on in rounds: with
``at_once``, consecutive batches are read, given to the function and noted together, each row with its batch's id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.sources.files import CORRUPT, ON_MALFORMED, conform_raw, csv_header, reject_malformed, resolve_path
from daybook.sources.records import csv_records, parse_records

FILES_SCHEMA = "file string, first bigint, n bigint"
BATCHES_SCHEMA = "batch_id bigint, first bigint, last bigint, done boolean"

BatchFn = Callable[[DataFrame, int], None]


def _existing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    from daybook.streaming.microbatch import _existing as existing

    return existing(spark, path, schema)


def _append(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("append").parquet(path)


class RowBatches:
    """Batches of ``rows_per_batch`` rows over the CSV files landing in ``source_dir``; state in ``work_dir``."""

    def __init__(self, spark: SparkSession, source_dir: str, work_dir: str, rows_per_batch: int,
                 on_malformed: str = "fail", multi_line: bool | None = None, by_name: bool = False):
        if rows_per_batch < 1:
            raise ValueError("rows_per_batch must be at least 1")
        if on_malformed not in ON_MALFORMED:
            raise ValueError(f"on_malformed must be one of {ON_MALFORMED}")
        self.spark, self.uri, self.work_dir, self.size = spark, resolve_path(source_dir), work_dir, rows_per_batch
        self.on_malformed, self.multi_line = on_malformed, multi_line
        # by_name: files that are new in one run come by path alone, as tasks that write side by side number them.
        self.order = ["path"] if by_name else ["modificationTime", "path"]

    @property
    def files(self) -> DataFrame:
        return _existing(self.spark, f"{self.work_dir}/row-files", FILES_SCHEMA)

    @property
    def batches(self) -> DataFrame:
        log = _existing(self.spark, f"{self.work_dir}/row-batches", BATCHES_SCHEMA)
        return log.groupBy("batch_id").agg(F.max("first").alias("first"), F.max("last").alias("last"), F.bool_or("done").alias("done"))

    def _records(self, held: DataFrame, names: list[str]) -> DataFrame:
        """(record, row) of the files ``held`` (file, first), which are ``names``: row is the record's number through all files."""
        records = csv_records(self.spark, names, self.multi_line)
        # n orders a split's records; its rank is n less the split's least, as they are consecutive there.
        splits = records.groupBy("file", "block").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("rows"))
        before = F.coalesce(F.sum("rows").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        # One row for each split of the batch's files.
        starts = splits.withColumn("before", before).join(held, "file").select(
            "file", "block", (F.col("first") + F.col("before") - F.col("least")).alias("shift"))
        return records.join(F.broadcast(starts), ["file", "block"]).select("record", (F.col("n") + F.col("shift")).alias("row"))

    def find_files(self) -> int:
        """Number the rows of files that are not in the log yet; returns how many rows there are in all."""
        spark = self.spark
        listed = (spark.read.format("binaryFile").load(self.uri).select("path", "modificationTime", "length")
                  .where("length > 0"))
        new = listed.join(self.files.select(F.col("file").alias("path")), "path", "left_anti")
        total = int(self.files.agg(F.coalesce(F.max(F.col("first") + F.col("n")), F.lit(0))).first()[0])
        # The names of files that came since the last run.
        names = [r.path for r in new.select("path").collect()]
        if not names:
            return total
        counts = csv_records(spark, names, self.multi_line).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
        rows = new.join(counts.withColumnRenamed("file", "path"), "path", "left").select(
            "path", "modificationTime", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
        order = Window.orderBy(*self.order).rowsBetween(Window.unboundedPreceding, -1)
        _append(rows.select(F.col("path").alias("file"), (F.lit(total) + F.coalesce(F.sum("n").over(order), F.lit(0))).cast("bigint").alias("first"), "n"),
                f"{self.work_dir}/row-files")
        return int(self.files.agg(F.max(F.col("first") + F.col("n"))).first()[0])

    def _note(self, first_id: int, first: int, last: int, done: bool) -> None:
        """Note the batches from ``first_id`` on that the rows ``first`` ... ``last`` (exclusive) make."""
        at = F.lit(first) + F.col("id") * self.size
        _append(self.spark.range(-(-(last - first) // self.size)).select(
            (F.lit(first_id) + F.col("id")).alias("batch_id"), at.alias("first"), F.least(at + self.size, F.lit(last)).alias("last"),
            F.lit(done).alias("done")), f"{self.work_dir}/row-batches")

    def rows(self, first: int, last: int, first_id: int | None = None) -> DataFrame:
        """The raw rows numbered ``first`` ... ``last`` (exclusive); with ``first_id``, the id of the first one's batch, also ``batch_id``."""
        held = self.files.where((F.col("first") < last) & (F.col("first") + F.col("n") > first)).select("file", "first")
        # The files that the rows lie in.
        names = sorted(r.file for r in held.select("file").collect())
        header = csv_header(self.spark, names)
        number = "_row"
        while number in {c.lower() for c in header}:
            number += "_"
        records = self._records(held, names).where((F.col("row") >= first) & (F.col("row") < last)).withColumnRenamed("row", number)
        raw = conform_raw(parse_records(records, header, CORRUPT), CORRUPT, number)
        if first_id is not None:
            raw = raw.withColumn("batch_id", F.lit(first_id) + F.floor((F.col(number) - first) / self.size))
        raw = raw.drop(number)
        return reject_malformed(raw) if self.on_malformed == "fail" else raw

    def _todo(self, total: int, at_once: int) -> list[tuple[int, int, int, bool]]:
        """(first batch, first row, end, noted) of each round: the batches that are open, in order, then the new ones."""
        log = self.batches
        at, number = log.agg(F.coalesce(F.max("last"), F.lit(0)), F.coalesce(F.max("batch_id"), F.lit(-1)) + 1).first()
        # One row a batch that was begun and not ended, which one round holds.
        spans = [(r.batch_id, r.first, r.last, True) for r in log.where("NOT done").orderBy("batch_id").collect()]
        if at < total:
            spans.append((number, at, total, False))
        rounds: list[tuple[int, int, int, bool]] = []
        for first_id, first, last, noted in spans:
            if rounds:
                a_id, a, b, known = rounds[-1]
                # Only a round's last batch may be a smaller one.
                if known == noted and b == first and (b - a) == (first_id - a_id) * self.size and last - a <= at_once * self.size:
                    rounds[-1] = (a_id, a, last, known)
                    continue
            step = at_once * self.size
            rounds += [(first_id + k * at_once, x, min(x + step, last), noted) for k, x in enumerate(range(first, last, step))]
        return rounds

    def run(self, fn: BatchFn, at_once: int | None = None) -> int:
        """Give every pending batch to ``fn`` (batch, batch_id); returns how many there were.

        With ``at_once``, ``fn`` gets up to so many consecutive batches in a call: their rows, which have a column
        ``batch_id``, and the first one's id.  What it writes under that id replaces what a failed call has written there.
        """
        if at_once is not None and at_once < 1:
            raise ValueError("at_once must be at least 1")
        n = 0
        for first_id, first, last, noted in self._todo(self.find_files(), at_once or 1):
            if not noted:
                self._note(first_id, first, last, False)
            fn(self.rows(first, last, None if at_once is None else first_id), first_id)
            self._note(first_id, first, last, True)
            n += -(-(last - first) // self.size)
        return n
