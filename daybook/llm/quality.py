"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms of two kinds are taken from the whole text: byte trigrams, hashed to
``TERMS`` buckets, and word shapes (``SHAPES`` kinds: does the word repeat the
one before, what does it begin and end with).  A document's vector is log tf x
idf of its trigrams (idf over all documents), scaled to length one, beside the
square roots of the shares of its word shapes, also of length one.  It is
projected on the leading singular directions of the labelled sample (latent
semantic analysis).  The labelled vectors, at most ``SAMPLE`` of
``DIMS`` float32 numbers, are broadcast; every document's cosine with all of
them is computed exactly, in blocks, inside the tasks.  The K nearest vote with
their labels, weighted by similarity; each label's votes are divided by its
share of the sample so that the rarer label is not outvoted, and the score is
the weight of label 1 among all votes.

Null and empty texts have a zero vector; they, and all documents when there is
no label, get ``EMPTY_SCORE``: an empty document is of no use.  With labels of
one kind every other document gets that label.  Equal similarities go to the
sample row with the smaller hash of doc_id, repeated rows are scored one by
one, input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import chunks, flat_bytes, labelled_sample, replace_columns, text_bytes

TERM_BITS = 11
TERMS = 1 << TERM_BITS
SHAPES = 2 * 4 * 5
DIMS = 64
SAMPLE = 4_000           # labelled documents used, at most
K = 15
SHARPNESS = 4.0          # votes weigh similarity to this power
EMPTY_SCORE = 0.0
BLOCK = 128              # documents in one block of cosine products


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Byte classes at the start of a word (4) and at its end (5)."""
    first, last = np.full(256, 3, np.int64), np.full(256, 4, np.int64)
    for table in (first, last):
        table[48:58] = 2
        table[65:91] = 1
        table[97:123] = 0
        table[128:] = 0
    for c in b".,;:?":
        last[c] = 3
    return first, last


FIRST, LAST = _classes()
POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))  # wraps: weights of a word's bytes in its hash


def shape_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of word-shape counts (texts x SHAPES) of concatenated texts; words stand between blanks and line ends."""
    n = len(offsets) - 1
    blank = np.concatenate(([True], (raw == 32) | (raw == 10), [True]))  # blank[i + 1] belongs to raw[i]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    start = np.flatnonzero(~blank[1:-1] & (blank[:-2] | cut[:-1]))
    if not len(start):
        return np.zeros((n, SHAPES))
    end = np.flatnonzero(~blank[1:-1] & (blank[2:] | cut[1:]))
    row = np.searchsorted(offsets, start, "right") - 1
    length = end - start + 1
    inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    value = (raw[np.repeat(start, length) + inside].astype(np.uint64) + np.uint64(1)) * POWERS[inside & 63]
    word = np.add.reduceat(value, np.cumsum(length) - length)
    same = np.concatenate(([False], (word[1:] == word[:-1]) & (row[1:] == row[:-1])))
    shape = (same * 4 + FIRST[raw[start]]) * 5 + LAST[raw[end]]
    return np.bincount(row * SHAPES + shape, minlength=n * SHAPES).reshape(n, SHAPES)


def term_counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of rows of trigram counts (texts x TERMS) and word-shape counts (texts x SHAPES), in order."""
    for start, stop in chunks(np.asarray(pc.binary_length(column)) + 1):
        raw, offsets = flat_bytes(column.slice(start, stop - start))
        code = np.zeros(len(raw), np.uint32)
        if len(raw) > 2:
            code[:-2] = (raw[:-2].astype(np.uint32) << 16) | (raw[1:-1].astype(np.uint32) << 8) | raw[2:]
            code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - TERM_BITS)
        shapes = shape_counts(raw, offsets)
        for i in range(0, stop - start, BLOCK):
            at = offsets[i:i + BLOCK + 1]
            row = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))
            inside = np.arange(at[0], at[-1]) + 2 < np.repeat(at[1:], np.diff(at))  # a text's last two bytes start none
            cell = (code[at[0]:at[-1]] + row * TERMS)[inside]
            yield (np.bincount(cell, minlength=(len(at) - 1) * TERMS).reshape(-1, TERMS), shapes[i:i + BLOCK])


def _vectors(counts: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Term vectors, TERMS + SHAPES wide."""
    trigrams, shapes = counts
    x = np.log1p(trigrams).astype(np.float32) * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    y = np.sqrt(shapes / np.maximum(shapes.sum(axis=1, keepdims=True), 1)).astype(np.float32)
    return np.hstack([x, y])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each bucket occurs, over all documents, and their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            for counts, _ in term_counts(text_bytes(batch.column(0))):
                total[:TERMS] += (counts > 0).sum(axis=0)
                total[TERMS] += len(counts)
            pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(total)], ["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    table = rows.toArrow()  # TERMS + 1 rows
    out = np.zeros(TERMS + 1)
    out[table.column("term").to_numpy()] = table.column("n").to_numpy()
    return out[:TERMS], int(out[TERMS])


@dataclass
class QualityModel:
    idf: np.ndarray          # TERMS
    directions: np.ndarray   # TERMS + SHAPES x DIMS
    vectors: np.ndarray      # sample x DIMS, unit length
    labels: np.ndarray       # sample
    k: int


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def vote(vectors: np.ndarray, model: QualityModel) -> np.ndarray:
    """Scores of unit vectors (zero vectors get EMPTY_SCORE)."""
    if not len(model.labels):
        return np.full(len(vectors), EMPTY_SCORE)
    sims = vectors @ model.vectors.T
    k = min(model.k, sims.shape[1])
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < sims.shape[1] else np.tile(np.arange(k), (len(sims), 1))
    weight = np.maximum(np.take_along_axis(sims, near, 1), 0).astype(np.float64) ** SHARPNESS + 1e-12
    share = np.array([max((model.labels == y).mean(), 1e-9) for y in (0, 1)])
    votes = [(weight * (model.labels[near] == y)).sum(axis=1) / share[y] for y in (0, 1)]
    out = votes[1] / (votes[0] + votes[1])
    return np.where(np.abs(vectors).max(axis=1) > 0, out, EMPTY_SCORE)


def fit(docs: DataFrame, labels: DataFrame, eligible: Callable[[Column], Column] = lambda c: F.lit(True),
        limit: int = SAMPLE, dims: int = DIMS, k: int = K) -> QualityModel:
    """idf over all documents; directions and labelled vectors from at most ``limit`` eligible labelled ones."""
    df, n = document_frequencies(docs)
    idf = np.log((n + 1) / (df + 1)).astype(np.float32) + np.float32(0.1)
    sample = labelled_sample(labels, "quality", eligible, limit)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in term_counts(text_bytes(batch.column(2))):
                x = _vectors(counts, idf).astype(np.float16)
                m = len(x)
                part, batch = batch.slice(0, m), batch.slice(m)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())],
                    ["mark", "label", "x"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The labelled vectors' main directions, and the vectors along them: one task's work on a bounded sample."""
        parts, y = [], []
        for batch in batches:
            parts.append(np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float16).reshape(len(batch), -1))
            y += batch.column(1).to_pylist()
        if not y:
            return
        gram = np.zeros((TERMS + SHAPES, TERMS + SHAPES), np.float32)
        for part in parts:
            for i in range(0, len(part), 512):
                x = part[i:i + 512].astype(np.float32)
                gram += x.T @ x
        _, basis = np.linalg.eigh(gram)
        directions = np.ascontiguousarray(basis[:, ::-1][:, :dims]).astype(np.float32)
        vectors = np.concatenate([part[i:i + 512].astype(np.float32) @ directions for part in parts for i in range(0, len(part), 512)])
        names = ["labels", "directions", "vectors"]
        values = [np.array(y, np.int64).tobytes(), directions.tobytes(), _unit(vectors).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names)

    # Bounded: at most ``limit`` rows of TERMS + SHAPES half floats (repeated documents count once) in the task, and
    # ``limit`` + TERMS + SHAPES rows of ``dims`` single floats on the driver.
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "label").agg(F.max("text").alias("text"))
            .select(F.xxhash64("doc_id").alias("mark"), "label", "text").mapInArrow(counted, "mark long, label int, x binary")
            .repartition(1).sortWithinPartitions("mark", "x").mapInArrow(fitted, "labels binary, directions binary, vectors binary"))
    found = rows.first()
    if found is None:
        return QualityModel(idf, np.zeros((TERMS + SHAPES, dims), np.float32), np.zeros((0, dims), np.float32), np.zeros(0, np.int64), k)
    directions = np.frombuffer(bytes(found.directions), np.float32).reshape(TERMS + SHAPES, -1)
    return QualityModel(idf, directions, np.frombuffer(bytes(found.vectors), np.float32).reshape(-1, directions.shape[1]),
                        np.frombuffer(bytes(found.labels), np.int64), k)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with score, from 0 to 1: the higher, the likelier label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for column in batches:
            parts = [vote(_unit(_vectors(c, m.idf) @ m.directions), m) for c in term_counts(text_bytes(column))]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
            pa.default_memory_pool().release_unused()

    base = replace_columns(docs, "score")
    return base.select("*", scored(F.col(text_col)).alias("score"))
