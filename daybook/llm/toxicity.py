"""Toxicity by maximum-scoring segments of token log-odds.

Token weights: log-odds ratio of a token in toxic against clean labelled
documents with an informative Dirichlet prior (Monroe, Colaresi & Quinn 2008)
whose pseudo-counts follow the token's count over *all* documents; a token
counts once in each document, so that one that is repeated in a line does not
weigh by its copies, and in a scan an immediate repetition weighs FLOOR.  The weight
is the lower confidence bound of the log-odds if that is positive, else a
negative value, so that a run of ordinary tokens always loses.  Tokens are
hashed to a fixed number of buckets; counts and weights are arrays of that
size, whatever the vocabulary, and that is all that is collected or broadcast.

Every document is scanned once, in linear time, for all its maximal scoring
segments (Ruzzo & Tompa 1999).  A segment of score S in n tokens has the
extreme-value (Karlin & Altschul 1990) expectation E = K n exp(-lambda S);
lambda solves sum p(s) exp(lambda s) = 1 over the clean token weights, K is fitted
on the maximal segments of clean labelled documents.  A document's evidence is
the sum of -ln(E) over its segments with E < 1; a one-variable logistic curve,
fitted on the labelled sample, turns it into a score between 0 and 1.

Null and empty texts have no segments.  Without labels of both kinds every
document gets the smoothed share of toxic labels, 0.5 without any label.
Ties and repeated rows are scored one by one; input columns named like an
output column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import fresh, labelled_sample, replace_columns, words_of

BUCKETS = 1 << 20
PRIOR_SHARE = 0.5          # sum of the Dirichlet pseudo-counts against the toxic counts
CONFIDENCE = 1.64          # one-sided 95 % bound
FLOOR = -1.0               # weight of a token that says nothing
SAMPLE = 20_000            # labelled documents used, at most

RESULT = "struct<evidence:double,best:double,segments:array<struct<first:int,last:int,score:double>>>"
SEGMENTS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))


def tokens(text: str | None) -> list[bytes]:
    """Words of a text in lower case (letters of every script)."""
    return words_of((text or "").lower().encode())


def token_buckets(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) & np.uint32(BUCKETS - 1)


def maximal_segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last + 1, score) in linear time; only positive tokens are visited."""
    out: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum after
    total = np.concatenate(([0.0], np.cumsum(weights)))
    for i in np.flatnonzero(weights > 0).tolist():
        first, last, left, right = i, i + 1, total[i], total[i + 1]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= left:
                j -= 1
            if j < 0 or out[j][3] >= right:
                out.append((first, last, left, right))
                break
            first, left = out[j][0], out[j][2]
            del out[j:]
    return [(a, b, float(r - x)) for a, b, x, r in out]


def count_tokens(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """How many documents, clean sampled and toxic sampled ones each bucket occurs in: shape (3, BUCKETS).

    Counted inside the tasks and summed by bucket, so what is shuffled is at
    most one row a bucket and task and what is collected at most BUCKETS rows.
    """
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left").select("text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((3, BUCKETS), np.int64)
        for batch in batches:
            label = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
            for text, y in zip(batch.column(0).to_pylist(), label.tolist(), strict=True):
                ids = np.unique(token_buckets(tokens(text)))
                counts[0][ids] += 1
                if y >= 0:
                    counts[1 + y][ids] += 1
        used = np.flatnonzero(counts[0])
        for i in range(0, len(used), 100_000):
            at = used[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(counts[k][at]) for k in range(3))],
                                             ["bucket", "n", "n0", "n1"])

    schema = "bucket long, n long, n0 long, n1 long"
    sums = rows.mapInArrow(count, schema).groupBy("bucket").agg(F.sum("n"), F.sum("n0"), F.sum("n1"))
    table = sums.toArrow()
    out = np.zeros((3, BUCKETS))
    for k in range(3):
        out[k][table.column(0).to_numpy()] = table.column(k + 1).to_numpy()
    return out


def token_weights(counts: np.ndarray) -> np.ndarray:
    """Weight of every bucket; buckets in which nothing was counted weigh FLOOR."""
    seen = counts[0] > 0
    n, n0, n1 = counts[:, seen]
    prior = PRIOR_SHARE * n1.sum() * n / n.sum()
    total, total0, total1 = prior.sum(), n0.sum(), n1.sum()
    odds = [np.log(y + prior) - np.log(t + total - y - prior) for y, t in ((n1, total1), (n0, total0))]
    delta = odds[0] - odds[1]
    bound = delta - CONFIDENCE * np.sqrt(1 / (n1 + prior) + 1 / (n0 + prior))
    out = np.full(len(seen), FLOOR, np.float32)
    out[seen] = np.where(bound > 0, bound, np.minimum(FLOOR, delta.clip(-4, 0)))
    return out


def gumbel_lambda(weights: np.ndarray, mass: np.ndarray) -> float:
    """The positive root of sum p(s) exp(lambda s) = 1; 1 if no clean token has a positive weight."""
    p, s = mass / max(mass.sum(), 1), weights.astype(float)
    used = p > 0
    p, s = p[used], s[used]
    if not (s > 0).any() or (p * s).sum() >= 0:
        return 1.0
    lo, hi = 0.0, 1.0
    while (p * np.exp(hi * s)).sum() < 1 and hi < 50:
        hi *= 2
    lo = 1e-9
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(mid * s)).sum() < 1 else (lo, mid)
    return hi


@dataclass
class ToxicityModel:
    weights: np.ndarray
    lam: float
    k: float
    slope: float
    bias: float


def _scan(weights, lam: float, k: float) -> Callable[[Column], Column]:
    """Arrow UDF: text to its evidence, best segment score and significant segments."""

    @F.arrow_udf(RESULT)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = weights.value
        for column in batches:
            evidence, best, segments = [], [], []
            for text in column.to_pylist():
                words = tokens(text)
                ids = token_buckets(words)
                gain = table[ids]
                gain[1:][ids[1:] == ids[:-1]] = FLOOR
                found = maximal_segments(gain)
                log_e = [lam * s - np.log(k * len(words)) for _, _, s in found]
                evidence.append(float(sum(x for x in log_e if x > 0)))
                best.append(max((s for _, _, s in found), default=0.0))
                segments.append([{"first": a, "last": b, "score": s}
                                 for (a, b, s), x in zip(found, log_e, strict=True) if x > 0])
            yield pa.StructArray.from_arrays(
                [pa.array(evidence, pa.float64()), pa.array(best, pa.float64()), pa.array(segments, SEGMENTS)],
                ["evidence", "best", "segments"])

    return scan


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a ridge-penalised one-variable logistic regression."""
    w = np.zeros(2)
    z = np.column_stack([x, np.ones_like(x)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        grad = z.T @ (p - y) + 1e-3 * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, eligible: Callable[[Column], Column] = lambda c: F.lit(True),
        limit: int = SAMPLE) -> ToxicityModel:
    """Token weights and calibration from ``labels.toxic`` of eligible documents.

    With labels of one kind only the weights are all FLOOR and the score is the
    smoothed share of toxic labels; with no label at all it is 0.5.
    """
    spark = docs.sparkSession
    sample = labelled_sample(labels, "toxic", eligible, limit).persist()
    counts = count_tokens(docs, sample)
    weights = token_weights(counts) if counts[1].any() and counts[2].any() else np.full(BUCKETS, FLOOR, np.float32)
    lam = gumbel_lambda(weights, counts[1])
    shared = spark.sparkContext.broadcast(weights)
    # Bounded: one row a sampled document.
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .select("label", F.regexp_count("text", F.lit("[0-9A-Za-z\\x{80}-\\x{10FFFF}]+")).alias("n"),
                    _scan(shared, lam, 1e-300)("text").alias("s"))  # so small a K that no segment is left out
            .select("label", F.coalesce("n", F.lit(0)).alias("n"), F.col("s.best").alias("best"),
                    F.col("s.segments.score").alias("scores")).toArrow())
    sample.unpersist()
    y = rows.column("label").to_numpy().astype(float)
    if not len(y):
        return ToxicityModel(weights, lam, 1.0, 0.0, 0.0)
    n, best = np.maximum(rows.column("n").to_numpy(), 1), rows.column("best").to_numpy()
    clean = (y == 0) & (best > 0)
    # Maximum-likelihood K of the extreme-value law on clean documents (those without a positive token included).
    k = max(clean.sum(), 1) / max((n * np.exp(-lam * best))[clean].sum() + n[(y == 0) & (best <= 0)].sum(), 1.0)
    scores = rows.column("scores").to_pylist()
    evidence = np.array([sum(max(0.0, lam * s - np.log(k * m)) for s in each or ())
                         for each, m in zip(scores, n.tolist(), strict=True)])
    if y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return ToxicityModel(weights, lam, k, 0.0, float(np.log(share / (1 - share))))
    slope, bias = _logistic(np.log1p(evidence), y)
    return ToxicityModel(weights, lam, k, slope, bias)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with score, evidence and segments (word ranges with their scores, E < 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    base = replace_columns(docs, "score", "evidence", "segments")
    keep = [F.col(f"`{c}`") for c in base.columns]
    found = fresh(base, "_s")
    logit = model.slope * F.log1p(F.col(f"{found}.evidence")) + model.bias
    return (base.select(*keep, _scan(shared, model.lam, model.k)(F.col(text_col)).alias(found))
            .select(*keep, (1 / (1 + F.exp(-logit))).alias("score"), f"{found}.evidence", f"{found}.segments"))
