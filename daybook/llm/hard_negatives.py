"""Hard negatives by rotated one-bit codes with certain score intervals.

Vectors are scaled to whole numbers, floor(scale * x), and scored by their inner
product, in whole numbers.  For an anchor, its positives are the best scored
other rows of its label; the hard negatives of a positive are the best scored
rows of another label whose score lies between ``LOW`` and ``HIGH`` percent of the positive's.

Not every score is computed.  Every vector o is rotated at random and kept as
its signs (Gao & Long 2024, "RaBitQ"): a code vector u of components +-1 / sqrt(D), the length |o|, and
the alignment A = <o, u> / |o|.  As o = |o| (A u + sqrt(1 - A^2) e) with a unit
vector e at right angles to u,

    <o, q> = |o| (A s + sqrt(1 - A^2) <e, q>),   s = <u, q>,

and by Cauchy and Schwarz |<e, q>| is at most sqrt(|q|^2 - s^2), the length of what u leaves of q.  s is found by
counting bits: the rotated query is rounded to ``QUERY_BITS`` bits a component,
whose planes are ANDed with the code; what rounding can change in s is at most the sum
of the rounding errors over sqrt(D), which widens the interval.  So every score
has a certain interval.  Candidates whose interval cannot reach the
results are dropped: those that end below the K-th best lower end, or
outside the window.  The scores of the others are computed in whole numbers, so the
result is exact.

Work is dealt in blocks: rows by hash into blocks of bounded size, coded once and
sorted by label, anchors into blocks of ``ANCHORS``; every block of anchors
meets every block of rows, as the task demands, and gives at most K rows for each
anchor (and positive), of which a windowed rank keeps the best.  No label,
however many rows it has, makes a block larger, and nothing is collected.

Rows whose id, label or vector is null, or whose vector has a null or non-finite
component (also after scaling), take no part.  Repeated rows are one row; different rows of one id are rows
of their own, but none is its own id's positive.  Rows only meet rows whose vectors have as many
components; an empty vector scores 0.  Ties go to the smaller id.  Scores beyond
a long are given, and compared, as its ends.  Labels are whole numbers.  Other columns of the
input, whatever their names, are not used; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import materialise

K = 5
LOW, HIGH = 80, 100      # percent of the positive's score
SCALE = 256
QUERY_BITS = 6
ANCHORS = 512            # anchors in one block
BLOCK_BYTES = 8 << 20    # bytes of the vectors in one block of rows, at most about
LEAST_ROWS = 1_024       # rows in a block, at least about (where there are so many)
TILE = 1 << 18           # intervals computed in one step
SEED = 11
SLACK = 1e-9             # relative room for rounding in the intervals
LONG = (-(1 << 63), (1 << 63) - 1)


@lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))[0]


def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes: n x words, uint64; lengths; alignments) of the rows of ``x``."""
    n, dims = x.shape
    with np.errstate(over="ignore", invalid="ignore"):
        y = x @ rotation(dims) if dims else x
        length = np.sqrt((x**2).sum(axis=1))
    bits = np.zeros((n, -(-max(dims, 1) // 64) * 64), np.uint8)
    bits[:, :dims] = y > 0
    codes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    with np.errstate(over="ignore", invalid="ignore"):
        align = np.divide(np.abs(y).sum(axis=1), np.sqrt(max(dims, 1)) * length, out=np.ones(n), where=length > 0)
    return codes, length, np.minimum(align, 1.0)


def intervals(q: np.ndarray, codes: np.ndarray, length: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Certain lower and upper ends (m x n) of the inner products of the rows of ``q`` with the coded vectors."""
    m, dims = q.shape
    if not dims:
        return np.zeros((m, len(codes))), np.zeros((m, len(codes)))
    with np.errstate(all="ignore"):
        low, high = _ends(q, codes, length, align)
    # Where lengths are beyond a double, nothing is known.
    return np.where(np.isfinite(low), low, -np.inf), np.where(np.isfinite(high), high, np.inf)


def _ends(q: np.ndarray, codes: np.ndarray, length: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    m, dims = q.shape
    y = q @ rotation(dims)
    root = np.sqrt(dims)
    least = y.min(axis=1, keepdims=True)
    step = (y.max(axis=1, keepdims=True) - least) / ((1 << QUERY_BITS) - 1)
    step[step == 0] = 1.0
    level = np.rint((y - least) / step).astype(np.uint8)
    rough = least + step * level
    eta = np.abs(y - rough).sum(axis=1, keepdims=True) / root
    padded = np.zeros((m, codes.shape[1] * 64), np.uint8)
    total = np.zeros((m, len(codes)))
    for k in range(QUERY_BITS):
        padded[:, :dims] = level >> k & 1
        plane = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
        for w in range(codes.shape[1]):
            total += (1 << k) * np.bitwise_count(plane[:, w, None] & codes[None, :, w]).astype(np.float64)
    ones = np.bitwise_count(codes).sum(axis=1).astype(np.float64)
    s = (2.0 * (least * ones + step * total) - rough.sum(axis=1, keepdims=True)) / root
    size = (q**2).sum(axis=1, keepdims=True)
    eta = eta + SLACK * np.sqrt(size)
    left = np.sqrt(np.maximum(size - np.maximum(np.abs(s) - eta, 0)**2, 0)) * np.sqrt(np.maximum(1 - align**2, 0) + SLACK)
    slack = SLACK * length * np.sqrt(size)
    return length * (align * (s - eta) - left) - slack, length * (align * (s + eta) + left) + slack


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers of ``q`` with the rows of ``x`` (whole numbers held in doubles)."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(len(q), 1)
    if most < 2.0**53:
        return (x @ q).astype(np.int64)
    whole = [int(v) for v in q.tolist()]
    exact = [sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in x.tolist()]
    return np.array([min(max(v, LONG[0]), LONG[1]) for v in exact], np.int64)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first: higher scores, then smaller ids."""
    return np.lexsort((ids, ~score))[:k]  # ~ turns the order round, for every long


def in_window(score, positive, low: int, high: int):
    """low % <= score / positive <= high %, in whole numbers."""
    score, positive = score.astype(object), int(positive)
    return np.array((low * positive <= 100 * score) & (100 * score <= high * positive), bool)


class Block:
    """Rows of one block: sorted by label, coded."""

    def __init__(self, dims: int, ids: bytes, labels: bytes, x: bytes, codes: bytes, facts: bytes):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.x = np.frombuffer(x, np.float64).reshape(len(self.ids), dims)
        self.codes = np.frombuffer(codes, np.uint64).reshape(len(self.ids), -1)
        self.length, self.align = np.frombuffer(facts, np.float64).reshape(2, -1)

    def tiles(self, q: np.ndarray, a: int, b: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(i, lower ends, upper ends) of each query with the rows a ... b."""
        step = max(1, TILE // max(b - a, 1))
        for i in range(0, len(q), step):
            low, high = intervals(q[i:i + step], self.codes[a:b], self.length[a:b], self.align[a:b])
            yield from zip(range(i, i + len(low)), low, high, strict=True)

    def positives(self, anchors: Anchors, k: int) -> list[tuple]:
        """(anchor, score, id): the anchors' best rows of their own label and another id."""
        out = []
        for label in np.unique(anchors.labels).tolist():
            a, b = np.searchsorted(self.labels, [label, label + 1]) if label < LONG[1] else \
                (np.searchsorted(self.labels, label), len(self.labels))
            who = np.flatnonzero(anchors.labels == label)
            if a == b:
                continue
            for i, low, high in self.tiles(anchors.x[who], a, b):
                other = self.ids[a:b] != anchors.ids[who[i]]
                fits = other & (high >= kth(low[other], k))
                at = a + np.flatnonzero(fits)
                score = scores(anchors.x[who[i]], self.x[at])
                out += [(int(anchors.key[who[i]]), int(score[j]), int(self.ids[at[j]])) for j in best(score, self.ids[at], k)]
        return out

    def negatives(self, anchors: Anchors, k: int, low_share: int, high_share: int) -> list[tuple]:
        """(anchor, place of the positive, score, id): the best rows of another label in each positive's window."""
        out = []
        for i, low, high in self.tiles(anchors.x, 0, len(self.ids)):
            other = self.labels != anchors.labels[i]
            fits = np.zeros(len(other), bool)
            for p in anchors.positive[i]:
                least, most = low_share * float(p) / 100, high_share * float(p) / 100
                least, most = least - SLACK * abs(least), most + SLACK * abs(most)
                sure = other & (low >= least + 2 * SLACK * abs(least)) & (high <= most - 2 * SLACK * abs(most))
                fits |= other & (high >= max(least, kth(low[sure], k))) & (low <= most)
            at = np.flatnonzero(fits)
            if not len(at):
                continue
            score = scores(anchors.x[i], self.x[at])
            for place, p in enumerate(anchors.positive[i]):
                inside = np.flatnonzero(in_window(score, p, low_share, high_share))
                for j in inside[best(score[inside], self.ids[at[inside]], k)]:
                    out.append((int(anchors.key[i]), place, int(score[j]), int(self.ids[at[j]])))
        return out


class Anchors:
    def __init__(self, key: bytes, ids: bytes, labels: bytes, x: bytes, positive: list[list[int]]):
        self.key, self.ids, self.labels = (np.frombuffer(b, np.int64) for b in (key, ids, labels))
        self.x = np.frombuffer(x, np.float64).reshape(len(self.ids), -1)
        self.positive = positive


def kth(value: np.ndarray, k: int) -> float:
    """The k-th largest value, minus infinity if there are fewer."""
    return float(np.partition(value, len(value) - k)[len(value) - k]) if len(value) >= k else -np.inf


def whole_vectors(vectors: DataFrame, label: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, label, x): the distinct rows that take part, x in whole numbers held in doubles."""
    x = F.transform(F.col(vector_col).cast("array<double>"), lambda v: v * scale)
    ok = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(ok)
    # Floor of a double as a double: beyond 2^52 a double is whole; adding 0.0 makes -0.0 the same row as 0.0.
    whole = F.transform("x", lambda v: F.when(F.abs(v) < 2.0**52, F.floor(v).cast("double")).otherwise(v) + F.lit(0.0))
    return rows.select("id", "label", "x", whole.alias("w")).distinct().select("id", "label", F.col("w").alias("x"))


def _packed(rows: DataFrame, keys: list[str], order: list[str], schema: str, make, limit: int | None = None) -> DataFrame:
    """One packed row for the rows of each value of ``keys`` (with ``limit``: of at most so many rows)."""
    count = len(keys)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group, size = None, 0

        def out() -> pa.RecordBatch:
            return make(pa.Table.from_batches(held).combine_chunks(), group)

        for batch in batches:
            marks = list(zip(*(batch.column(i).to_pylist() for i in range(count)), strict=True))
            a = 0
            while a < len(marks):
                b = a + 1
                while b < len(marks) and marks[b] == marks[a]:
                    b += 1
                if held and (marks[a] != group or limit and size >= limit):
                    yield out()
                    held, size = [], 0
                if limit:
                    b = min(b, a + limit - size)
                held.append(batch.slice(a, b - a))
                group, size, a = marks[a], size + b - a, b
        if held:
            yield out()

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(pack, schema)


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten()).reshape(len(column), dims)


def _one(*values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v[1]], v[2]) for v in values], [v[0] for v in values])


def _row_blocks(rows: DataFrame) -> DataFrame:
    """One row for each block: (dims, block, ids, labels, x, codes, facts)."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = F.least(F.lit(BLOCK_BYTES) / (F.greatest("dims", F.lit(1)) * 8), F.greatest(F.lit(LEAST_ROWS), F.col("n") / (4 * cores)))
    # A row for each length of vectors.
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n")).select("dims", F.ceil(F.col("n") / F.greatest(size, F.lit(1))).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "dims").select("dims", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("block"), "label", "id", "x")

    def make(table: pa.Table, group: tuple) -> pa.RecordBatch:
        x = _matrix(table.column("x"), group[0])
        codes, length, align = coded(x)
        return _one(("dims", group[0], pa.int32()), ("block", group[1], pa.int32()),
                    ("ids", np.asarray(table.column("id"), np.int64).tobytes(), pa.binary()),
                    ("labels", np.asarray(table.column("label"), np.int64).tobytes(), pa.binary()),
                    ("x", x.tobytes(), pa.binary()), ("codes", codes.tobytes(), pa.binary()),
                    ("facts", np.concatenate((length, align)).tobytes(), pa.binary()))

    return _packed(dealt, ["dims", "block"], ["label", "id"],
                   "dims int, block int, ids binary, labels binary, x binary, codes binary, facts binary", make)


def _anchor_blocks(anchors: DataFrame) -> DataFrame:
    """One row for at most ANCHORS anchors (a, id, label, dims, x, positive)."""
    sizes = anchors.groupBy("dims").agg(F.ceil(F.count("*") / F.lit(ANCHORS)).cast("int").alias("parts"))
    dealt = anchors.join(sizes, "dims").select("dims", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"),
                                               "label", "a", "id", "x", "positive")

    def make(table: pa.Table, group: tuple) -> pa.RecordBatch:
        return _one(("dims", group[0], pa.int32()),
                    *((f"a_{n}", np.asarray(table.column(c), np.int64).tobytes(), pa.binary())
                      for n, c in (("key", "a"), ("ids", "id"), ("labels", "label"))),
                    ("a_x", _matrix(table.column("x"), group[0]).tobytes(), pa.binary()),
                    ("a_positive", table.column("positive").to_pylist(), pa.list_(pa.list_(pa.int64()))))

    return _packed(dealt, ["dims", "part"], ["label", "a"],
                   "dims int, a_key binary, a_ids binary, a_labels binary, a_x binary, a_positive array<array<bigint>>", make, ANCHORS)


def _meet(blocks: DataFrame, anchors: DataFrame, schema: str, work) -> DataFrame:
    """``work(block, anchors)`` of every block of rows with every block of anchors."""
    places = blocks.select("dims", "block")
    wide = _anchor_blocks(anchors).join(places, "dims")
    # By a shuffle: every meeting of two blocks is work of its own, to be dealt over the tasks.
    pairs = blocks.hint("merge").join(wide, ["dims", "block"])
    fields = schema.split(", ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                out = work(Block(row["dims"], *(row[n] for n in ("ids", "labels", "x", "codes", "facts"))),
                           Anchors(*(row[f"a_{n}"] for n in ("key", "ids", "labels", "x", "positive"))))
                for a in range(0, len(out), 100_000):
                    part = out[a:a + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], pa.int64()) for k in range(len(fields))],
                                                     [f.split()[0] for f in fields])

    return pairs.mapInArrow(run, schema)


def mine(vectors: DataFrame, is_anchor: Column, label: Column | str = "label", k: int = K, positives: int = K, low: int = LOW,
         high: int = HIGH, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``id`` (and ``label``) of a row
    that takes part; ``label`` is a column or expression of the input.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = whole_vectors(vectors, label, id_col, vector_col, scale)
    rows = materialise(rows.select(F.monotonically_increasing_id().alias("a"), "id", "label", F.size("x").alias("dims"), "x"), "hn-rows")
    blocks = materialise(_row_blocks(rows), "hn-blocks")
    anchors = rows.where(is_anchor)
    none = F.array().cast("array<bigint>")
    found = _meet(blocks, anchors.withColumn("positive", none), "a long, score long, id long", lambda b, a: b.positives(a, positives))
    order = Window.partitionBy("a").orderBy(F.desc("score"), "id")
    first = materialise(found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives), "hn-positives")
    # At most ``positives`` values for each anchor.
    lists = first.groupBy("a").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "score"))), lambda s: s.score).alias("positive"))
    found = _meet(blocks, anchors.join(lists, "a"), "a long, place long, score long, id long", lambda b, a: b.negatives(a, k, low, high))
    order = Window.partitionBy("a", "place").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    pairs = first.select("a", (F.col("n") - 1).cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (ranked.join(pairs, ["a", "place"]).join(anchors.select("a", F.col("id").alias("anchor_id")), "a")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
