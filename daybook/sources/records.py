"""CSV records of files that are read in splits, line breaks in quoted fields included.

A CSV record may span lines, if a quoted field holds a line break; where a split of a
file begins, it is not known whether its first line starts a record.  A reader that
counts quotes from the start of the file needs one task per file.  Here splits
are read independently:

1. ``find_open_lines``: one pass counts the quotes of each line.  Without a line
   that has an odd number of them every line is a record, which is the usual case.
2. Otherwise every split is scanned twice in one pass over its lines, from
   outside and from inside a quoted field; the result is a function of two states, one row for
   each split.  Composing these functions in the order of a file's splits, by windows over
   the small table of splits, gives the state in which each split begins.
3. Each split, now with a known first state, puts its lines together.  What begins
   in one split and ends in another one (at most two fragments a split) is
   joined by a grouping over these fragments alone.

Quotes are strict: a quoted field starts and ends at a comma or at the record's
ends, a quote inside it is doubled, and an unquoted field holds none.  A
line that breaks the rule ends the record, which is malformed; reading goes on
with the next line, so a stray quote costs one record and not the rest of the file.

A line ends at ``\\n``; ``\\r`` before it is dropped, in quoted fields as well.
Blank lines between records are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daybook.session import scratch_path

# A separator that no line holds: the CSV source then gives whole lines, and drops and checks each file's header.
NO_SEPARATOR = "\u0001\u0002\u0003"
# One field, and a whole record, by the strict quoting rule (possessive: no backtracking, no recursion).
FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
RECORD = rf"^{FIELD}(?:,{FIELD})*+\z"
MAX_BROADCAST_BYTES = 16 << 20

RECORD_SCHEMA = "file string, block bigint, n bigint, record string"


def strict_record(record: str) -> Column:
    """The text follows the strict quoting rule."""
    return F.expr(f"NOT contains({record}, '\"') OR {record} RLIKE r'{RECORD}'")


def _whole_lines(reader):
    return (reader.option("header", True).option("sep", NO_SEPARATOR).option("quote", "").option("escape", "")
            .option("lineSep", "\n").option("mode", "FAILFAST"))


def header_line(spark: SparkSession, uri: str | list[str]) -> str:
    """The first line of the first file (with its ``\\r``, if it has one)."""
    names = _whole_lines(spark.read).csv(uri).columns
    if not names:
        raise ValueError(f"no header: {uri} has no line")
    return names[0]


def line_records(reader, uri: str | list[str], head: str) -> DataFrame:
    """``record``: every line but the headers, for ``reader`` (batch or stream); a file with another header fails the read."""
    lines = _whole_lines(reader).schema(T.StructType([T.StructField(head, T.StringType())])).option("enforceSchema", False).csv(uri)
    name = "`" + head.replace("`", "``") + "`"
    return lines.select(F.expr(f"CASE WHEN endswith({name}, '\\r') THEN left({name}, length({name}) - 1) ELSE {name} END").alias("record"),
                        *([] if lines.isStreaming else
                          [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                           F.monotonically_increasing_id().alias("n")]))


def parse_records(records: DataFrame, header: list[str], corrupt: str) -> DataFrame:
    """``records`` with the columns of ``header`` and ``corrupt``: the record's text where it does not fit.

    The parse stands in a one-row generator, a plan boundary that no filter
    is pushed through, so each record is split once, whatever columns are read.
    """
    ddl = ", ".join("`" + c.replace("`", "``") + "` string" for c in [*header, corrupt])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    fields = F.from_csv("record", ddl, options)
    once = records.select("*", F.inline(F.array(F.struct(fields.alias("_fields"), strict_record("record").alias("_strict")))))
    text = F.when(F.col("_strict"), F.col("_fields").getField(corrupt)).otherwise(F.col("record"))
    return once.select(*records.columns, *[F.col("_fields").getField(c).alias(c) for c in header], text.alias(corrupt))


def text_lines(spark: SparkSession, uri: str | list[str]) -> DataFrame:
    """(file, block, line, at): all lines as they stand in the splits of the files; ``at`` orders a split's lines."""
    return spark.read.option("lineSep", "\n").text(uri).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"),
        F.monotonically_increasing_id().alias("at"))


def find_open_lines(lines: DataFrame) -> bool:
    """Whether any line has an odd number of quotes (one pass; nothing but a flag comes back)."""
    quotes = F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    return bool(lines.agg(F.coalesce(F.max(quotes % 2), F.lit(0))).first()[0])


# --- the two states of a line's start: 0 outside and 1 inside a quoted field -------------------


def _between(parts: list[str]) -> bool:
    """Whether the texts between quoted stretches are separators or doubled quotes."""
    return all(p == "" or p[0] == "," == p[-1] for p in parts)


def opens(line: str) -> bool:
    """A line with an odd number of quotes, begun outside, follows the rule and ends inside a field."""
    parts = line.split('"')
    return (parts[0] == "" or parts[0][-1] == ",") and _between(parts[2::2])


def stays(line: str) -> bool:
    """A line with an even number of quotes, begun inside, follows the rule (and ends inside a field)."""
    return _between(line.split('"')[1::2])


def continued(lines: pa.Array, state: int) -> tuple[np.ndarray, int]:
    """Which lines begin inside a quoted field, and the state after the last one.

    Only lines with an odd number of quotes are looked at outside, and only lines with quotes inside.
    """
    count = pc.count_substring(lines, '"').to_numpy()
    odd, some = np.flatnonzero(count % 2), np.flatnonzero(count)
    inside = np.zeros(len(lines), bool)
    at, n = 0, len(lines)
    while at < n:
        if state == 0:
            k = np.searchsorted(odd, at)
            if k == len(odd):
                break
            state, at = int(opens(lines[odd[k]].as_py())), int(odd[k]) + 1
        else:
            k = np.searchsorted(some, at)
            to = int(some[k]) if k < len(some) else n - 1
            inside[at:to + 1] = True
            if k < len(some):
                state = int(count[to] % 2 == 0 and stays(lines[to].as_py()))
            at = to + 1
    return inside, state


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The consecutive rows of one split in a batch (file, block, ...)."""
    file, block = batch.column(0), batch.column(1)
    n = len(batch)
    same = np.asarray(pc.and_(pc.equal(file.slice(1), file.slice(0, n - 1)), pc.equal(block.slice(1), block.slice(0, n - 1))).to_numpy(
        zero_copy_only=False), bool) if n > 1 else np.zeros(0, bool)
    cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), n]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield file[a].as_py(), block[a].as_py(), batch.slice(a, b - a)


def _scan_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a split: the states after it if it begins outside, and inside."""
    key, ends = None, [0, 1]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, *ends), (pa.string(), pa.int64(), pa.int32(), pa.int32()),
                                                                           strict=True)], ["file", "block", "outside", "inside"])

    for batch in batches:
        for file, block, part in _segments(batch):
            if key is not None and key != (file, block):
                yield row()
                ends = [0, 1]
            key = (file, block)
            lines = part.column(2)
            first = continued(lines, ends[0])[1]
            ends = [first, first] if ends[0] == ends[1] else [first, continued(lines, ends[1])[1]]
    if key is not None:
        yield row()


def split_states(lines: DataFrame) -> DataFrame:
    """(file, block, start, end): the state in which each split begins and ends."""
    spark = lines.sparkSession
    path = scratch_path(spark, "splits")
    lines.select("file", "block", "line").mapInArrow(_scan_splits, "file string, block bigint, outside int, inside int").write.parquet(path)
    found = spark.read.schema("file string, block bigint, outside int, inside int").parquet(path)
    in_file = Window.partitionBy("file").orderBy("block")
    # A split whose end does not depend on its start heads a run; in a run, every other one is the identity or a swap.
    fixed = F.col("outside") == F.col("inside")
    run = found.withColumn("run", F.sum(fixed.cast("int")).over(in_file))
    in_run = Window.partitionBy("file", "run").orderBy("block")
    base = F.coalesce(F.first(F.when(fixed, F.col("outside"))).over(in_run), F.lit(0))
    swaps = F.sum(F.when(~fixed & (F.col("outside") == 1), 1).otherwise(0)).over(in_run)
    ended = run.withColumn("end", ((base + swaps) % 2).cast("int"))
    return ended.select("file", "block", F.lag("end", 1, 0).over(in_file).alias("start"), "end")


def _assembler(head: str, fragments: bool):
    """Rows (file, block, line, start) of splits → complete records, or only the fragments at the ends of splits.

    A fragment's ``n`` is -1 if it ends a record begun in an earlier split, -2
    if it is the middle of one, and otherwise the place of the record that it begins.
    """
    head = head.rstrip("\r")

    def batch_of(file: str, block: int, n: np.ndarray, records: pa.Array) -> pa.RecordBatch:
        size = len(records)
        return pa.RecordBatch.from_arrays([pa.array([file] * size, pa.string()), pa.array([block] * size, pa.int64()),
                                           pa.array(n, pa.int64()), records.cast(pa.string())], ["file", "block", "n", "record"])

    def check(file: str, block: int, n: int, record: str) -> bool:
        """A header, which must be the expected one."""
        if block or n:
            return False
        if record != head:
            raise ValueError(f"the header of {file} is {record!r}, expected {head!r}")
        return True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, n, held, orphan = None, 0, 0, [], False
        # held: the lines of the record that is open; orphan: it was begun in an earlier split.

        def rest() -> Iterator[pa.RecordBatch]:
            """What is held at the end of a split: a whole record, or one that goes on in the next split, if there is one."""
            if not held:
                return
            record = "\n".join(held)
            if orphan or state == 1:
                if fragments:
                    yield batch_of(*key, np.array([n if not orphan else -1 if state == 0 else -2]), pa.array([record]))
            elif not check(*key, n, record) and not fragments:
                yield batch_of(*key, np.array([n]), pa.array([record]))

        for batch in batches:
            for file, block, part in _segments(batch):
                if key != (file, block):
                    yield from rest()
                    key, state, n, held = (file, block), int(part.column(3)[0].as_py()), 0, []
                    orphan = state == 1
                lines = pc.replace_substring_regex(part.column(2), r"\r$", "")
                inside, state = continued(lines, state)
                # Records of this part: lines from one start to the next; the first may go on an open one, the last stays open.
                first = np.flatnonzero(~inside)
                if not len(first):
                    held += lines.to_pylist()
                    continue
                if first[0] or held:
                    held += lines.slice(0, first[0]).to_pylist()
                    if held:
                        record = "\n".join(held)
                        if orphan:
                            if fragments:
                                yield batch_of(file, block, np.array([-1]), pa.array([record]))
                        elif not check(file, block, n, record) and not fragments:
                            yield batch_of(file, block, np.array([n]), pa.array([record]))
                        n += not orphan
                    held, orphan = [], False
                # What this part leaves open: its last record, if the next line begins inside it or is not known yet.
                last = int(first[-1])
                records = first[:-1] if state == 1 else first
                if state == 1:
                    held = lines.slice(last).to_pylist()
                if not len(records):
                    continue
                stop = last if state == 1 else len(lines)
                size = np.diff(np.append(records, stop))
                whole = lines.slice(int(records[0]), stop - int(records[0]))
                if (size > 1).any():
                    offsets = pa.array((np.append(records, stop) - records[0]).astype(np.int32))
                    whole = pc.binary_join(pa.ListArray.from_arrays(offsets, whole), "\n")
                place = n + np.arange(len(records))
                n += len(records)
                keep = np.asarray(pc.not_equal(pc.utf8_trim_whitespace(whole), "").to_numpy(zero_copy_only=False), bool)
                if check(file, block, int(place[0]), whole[0].as_py()):
                    keep[0] = False
                if not fragments and keep.any():
                    mask = pa.array(keep)
                    yield batch_of(file, block, place[keep], whole.filter(mask))
        yield from rest()

    return run


def assembled_records(lines: DataFrame, head: str, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(file, block, n, record): the records of files whose quoted fields hold line breaks; n orders a split's records."""
    states = split_states(lines)
    crossing = states.where("start = 1 OR end = 1")
    size = crossing.agg(F.coalesce(F.sum(F.octet_length("file") + 64), F.lit(0))).first()[0]
    rows = ["file", "block", "line", "start"]
    if not size:
        return lines.withColumn("start", F.lit(0)).select(*rows).mapInArrow(_assembler(head, False), RECORD_SCHEMA)
    # One row for each split that a record crosses into or out of.
    side = crossing.select("file", "block", "start")
    if size <= max_broadcast_bytes:
        side = F.broadcast(side)

    def started(how: str) -> DataFrame:
        found = lines.join(side, ["file", "block"], how).withColumn("start", F.coalesce("start", F.lit(0)))
        if size > max_broadcast_bytes:      # a shuffle loses the order of the lines
            found = found.repartition("file", "block").sortWithinPartitions("file", "block", "at")
        return found.select(*rows)

    pieces = started("inner").mapInArrow(_assembler(head, True), RECORD_SCHEMA)
    in_file = Window.partitionBy("file").orderBy("block", F.col("n") >= 0)
    owner = F.last(F.when(F.col("n") >= 0, F.struct("block", "n")), True).over(in_file)
    whole = (pieces.withColumn("owner", owner).groupBy("file", "owner")
             .agg(F.sort_array(F.collect_list(F.struct("block", (F.col("n") >= 0).alias("begins"), "record"))).alias("parts"))
             .select("file", "owner.block", "owner.n", F.array_join(F.transform("parts", lambda p: p.record), "\n").alias("record")))
    return started("left").mapInArrow(_assembler(head, False), RECORD_SCHEMA).unionByName(whole)


def csv_records(spark: SparkSession, uri: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """(record, file, block, n) of CSV files with one common header.

    ``multi_line``: whether records may span lines; None finds out by a pass over the lines.
    """
    head = header_line(spark, uri)
    if multi_line is not False:
        lines = text_lines(spark, uri)
        if multi_line or find_open_lines(lines):
            return assembled_records(lines, head).select("record", "file", "block", "n")
    return line_records(spark.read, uri, head)
