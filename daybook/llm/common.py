"""Small helpers shared by the training-text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.session import scratch_path

#: Upper bound on the text bytes one numpy step works on inside a task.
CHUNK_BYTES = 1 << 20
#: Rows in one Arrow batch, at most.
ARROW_ROWS = 1_000
#: Keys of a join whose facts are broadcast, at most, and rows from which a key can be one of them.
HOT_KEYS, HOT_ROWS = 50_000, 1_000

#: A-Z to a-z, every ASCII byte that is no letter or digit to a blank; bytes of
#: other characters stay.  ``bytes.translate(FOLD).split()`` then gives the runs
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z in lower case.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


POWERS = np.cumprod(np.full(64, 0xD1B54A32D192ED03, np.uint64))
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text."""
    return text.translate(FOLD).split()


def prepare(spark: SparkSession) -> SparkSession:
    """Smaller Arrow batches for this session: at the default 10,000 rows, one batch of long texts takes hundreds of
    MB, several times over, in the JVM and in each Python worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def replace_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add (names compared as Spark does)."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends in files all executors see."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_counted(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """``rows`` joined on ``key`` with ``facts``, which has one row a key and in ``n_rows`` how many of the rows have it.

    The facts of keys with more than 1 / HOT_KEYS of all rows, at most HOT_KEYS by pigeonhole, are broadcast, and the rows of
    those keys stay where they are; the rest meets by a shuffle in which no key is large.  Both inputs should be tables.
    """
    total = facts.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    limit = max(HOT_ROWS, int(total) // HOT_KEYS)
    hot = facts.where(F.col("n_rows") > limit)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(facts.where(F.col("n_rows") <= limit), key))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as a column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def append_in_slices(df: DataFrame, size_of: Callable[[pa.RecordBatch], np.ndarray],
                     make: Callable[[pa.RecordBatch], list[pa.Array]], fields: str, limit: int) -> DataFrame:
    """``df`` with the columns ``fields`` (DDL) that ``make`` computes from its rows.

    Batches are worked on, and sent back, in slices of about ``limit`` by
    ``size_of``, so that neither side ever holds the results of a whole batch.
    """
    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(fields).fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(size_of(batch), limit):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *make(part)], names)
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> pa.Array:
    """The UTF-8 bytes of a string array; nulls become empty."""
    return column.cast(pa.binary()).fill_null(b"")


def chunks(sizes: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to about ``limit``; a larger single item gets its own range."""
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One uint8 array with all values of a binary array without nulls, and the n+1 offsets into it."""
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Uniform doubles in (0, 1) from scrambled uint64 values."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word between white space, A-Z as a-z, of a binary array without nulls, in order."""
    raw, offsets = flat_bytes(column)
    blank = SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([True], blank[:-1])) | edge[:-1] if len(raw) else np.zeros(0, bool)
    after = np.concatenate((blank[1:], [True])) | edge[1:] if len(raw) else np.zeros(0, bool)
    start, end = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row = np.searchsorted(offsets, start, "right") - 1
    size = end - start + 1
    first = np.cumsum(size) - size
    inside = np.arange(size.sum()) - np.repeat(first, size)
    value = (LOWER[raw[~blank]].astype(np.uint64) + np.uint64(1)) * POWERS[inside & 63] + inside.astype(np.uint64)
    return row, mix64(np.add.reduceat(value, first))


def bags(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) with their counts, rows in order."""
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (key[1:] != key[:-1]))) if len(row) else row > 0
    at = np.flatnonzero(new)
    return row[at], key[at], np.diff(np.append(at, len(row)))


def labelled_sample(labels: DataFrame, column: str, eligible, limit: int) -> DataFrame:
    """At most ``limit`` labelled documents as (doc_id, label), the same ones at every run.

    Rows with a null id or label are left out, several rows of one document
    become one by majority (a tie counts as 1), and the rows kept are those
    with the smallest hash of doc_id, so the sample follows no order of the
    table.  Its size is bounded by ``limit``.
    """
    rows = (
        labels.select(F.col("doc_id"), F.col(column).cast("double").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & eligible(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def crc_fold(doc_id, n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n
