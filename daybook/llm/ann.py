"""Approximate nearest neighbours by inner product: probed lists and an adaptive dimension scan.

Vectors are extended by one component so that the largest inner product is the
smallest Euclidean distance (sqrt(M^2 - |x|^2), M the largest length; 0 for a
query), then rotated at random (Gao & Long 2023, "ADSampling").  An index of
lists around k-means centres is fitted on a bounded sample (``SAMPLE`` rows by
hash); every row is put in the list of its nearest centre.  A query probes its
nearest lists.  Within a list, rotated vectors are read in blocks of columns:
from the partial distance over d of D dimensions the whole one is estimated,
and a candidate goes as soon as the estimate exceeds the query's current k-th
distance by the factor 1 + EPS / sqrt(d), a test that errs with a probability
that EPS bounds.  The first threshold is the query's k-th best score among
``SEEDS`` of the sampled rows, a bound that the whole table can only improve;
these rows count as found.  Survivors are scored in double precision on the
original vectors.

Repeated rows are one row from the start, for index, thresholds and scan alike.
An id with several vectors is one neighbour, at its best score, and a threshold
always rests on so many different ids.

Vectors that are null, zero, hold null or non-finite components, or have
another length than most take no part, neither as query nor as candidate.
Equal vectors are one candidate with the k + 1 smallest ids, which is all of
them that can be among a query's k nearest, and equal queries are searched
once; so a vector that fills a third of the table costs no more than another.
Lists are dealt in blocks over tasks, whatever their size, and queries of a
list in blocks as well.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import materialise

K = 20
SAMPLE = 16_384          # rows the index is fitted on, at most
SEEDS = 4_096            # of these, rows that give the first thresholds
LIST_ROWS = 1_000        # rows a list has on average, up to MAX_LISTS lists
MAX_LISTS = 256
PROBED = 0.8             # share of the lists that a query probes
EPS = 2.1
COLUMNS = 16             # columns of a block
DENSE = 0.05             # share of the pairs alive above which a block is taken for all of them
BLOCK = 4_096            # candidates in one block of a list
PORTION = 1_024          # candidates between two looks at a query's threshold
QUERY_BLOCK = 512        # queries in one block of a list
SEED = 7


@dataclass
class Index:
    dims: int
    longest: float            # M
    rotation: np.ndarray      # (dims + 1) x (dims + 1), orthogonal
    centres: np.ndarray       # lists x (dims + 1), rotated
    seeds: np.ndarray         # some rows of different ids, which give a query its first threshold
    seed_ids: np.ndarray

    def rotate(self, x: np.ndarray, query: bool) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest**2 - (x**2).sum(axis=1), 0.0))
        return np.column_stack([x, rest]) @ self.rotation

    def near(self, rotated: np.ndarray, n: int) -> np.ndarray:
        """The n nearest centres of each vector, nearest first."""
        d = (self.centres**2).sum(axis=1) - 2 * rotated @ self.centres.T
        return np.argsort(d, axis=1, kind="stable")[:, :n]

    def first(self, query: np.ndarray, k: int) -> tuple[list[int], np.ndarray]:
        """Ids and scores of a query's k best seeds."""
        best = np.argsort(-(self.seeds @ query), kind="stable")[:k]
        return self.seed_ids[best].tolist(), np.array([np.dot(self.seeds[i], query) for i in best])

    def bound(self, queries: np.ndarray, k: int) -> np.ndarray:
        """Each query's k-th best score among the seeds (-inf with fewer seeds)."""
        if len(self.seeds) < k:
            return np.full(len(queries), -np.inf)
        return -np.partition(-queries @ self.seeds.T, k - 1, axis=1)[:, k - 1]

    def limit(self, queries: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Squared distance of a score, with room for rounding."""
        d = (queries**2).sum(axis=1) + self.longest**2 - 2 * score
        return np.maximum(d, 0) * (1 + 1e-9) + 1e-9 * self.longest**2


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): rows whose vector can take part, x in doubles."""
    x = F.col(vector_col).cast("array<double>")
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(
        F.col("id").isNotNull() & F.col("x").isNotNull()).where(ok)
    sizes = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("x") == (sizes.n if sizes else 0))


def fit(rows: DataFrame, seed: int = SEED) -> Index | None:
    """The index of distinct rows, from at most SAMPLE of them chosen by hash; None for an empty table."""
    facts = rows.agg(F.max(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)), F.count("*")).first()
    if not facts[1]:
        return None
    # Bounded: SAMPLE rows.
    picked = rows.orderBy(F.xxhash64("id", "x"), "id", "x").limit(SAMPLE).collect()
    sample = np.array([r.x for r in picked])
    ids = np.array([r.id for r in picked])
    seeds = np.sort(np.unique(ids, return_index=True)[1])[:SEEDS]  # one row of an id
    dims, rng = sample.shape[1], np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(rng.standard_normal((dims + 1, dims + 1)))
    index = Index(dims, float(np.sqrt(facts[0])), rotation, np.zeros((0, dims + 1)),
                  sample[seeds], ids[seeds])
    points = index.rotate(sample, False)
    lists = int(np.clip(facts[1] // LIST_ROWS, 1, min(MAX_LISTS, len(np.unique(points, axis=0)))))
    index.centres = points[rng.permutation(len(points))[:lists]].copy()
    for _ in range(10):
        nearest = index.near(points, 1)[:, 0]
        for c in range(lists):
            own = points[nearest == c]
            if len(own):
                index.centres[c] = own.mean(axis=0)
    return index


def _placed(rows: DataFrame, index: Broadcast, probes: int, k: int) -> DataFrame:
    """Rows (id, ids, x) with ``list``: one for each of the ``probes`` nearest lists of a query, with ``least``, its
    first threshold; for 0 probes the one list of a candidate."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch.x.tolist()).reshape(len(batch), -1)
            lists = [index.value.near(index.value.rotate(x[i:i + 1024], probes > 0), max(probes, 1))
                     for i in range(0, len(x), 1024)]
            least = [index.value.bound(x[i:i + 1024], k) if probes else np.zeros(len(x[i:i + 1024])) for i in range(0, len(x), 1024)]
            yield batch.assign(lists=[r for part in lists for r in part], least=np.concatenate(least) if least else [])

    schema = "id long, ids array<long>, x array<double>, lists array<int>, least double"
    placed = rows.select("id", "ids", "x").mapInPandas(place, schema)
    return placed.select("id", "ids", "x", "least", F.explode("lists").alias("list"))


def kth(value: np.ndarray, k: int, label: np.ndarray | None = None) -> float:
    """The k-th smallest value, each label counted once; infinite if there are fewer."""
    if label is not None:
        order = np.argsort(value, kind="stable")
        value = value[order[np.unique(label[order], return_index=True)[1]]]
    return np.partition(value, k - 1)[k - 1] if len(value) >= k else np.inf


def scan_block(rq: np.ndarray, rx: np.ndarray, limit: np.ndarray, k: int, label: np.ndarray | None = None) -> list[np.ndarray]:
    """Candidates (rows of ``rx``, rotated) that survive for each of the rotated queries ``rq``.

    ``limit`` holds each query's squared distance beyond which a candidate is of
    no use.  Candidates come in portions, after each of which a query's limit
    falls to its k-th distance so far; candidates of one ``label`` count once.
    """
    dims, limit = rx.shape[1], limit.copy()
    kept = [np.zeros(0, np.int64) for _ in rq]
    held = [np.zeros(0) for _ in rq]

    def share(d: int) -> np.ndarray:
        """The partial distance over d dimensions up to which a candidate stays."""
        return limit * min(1.0, (1 + EPS / np.sqrt(d))**2 * d / dims)

    def block(part: np.ndarray, c: int) -> np.ndarray:
        """What columns c ... add to the distance of every query and candidate."""
        a, b = rq[:, c:c + COLUMNS], part[:, c:c + COLUMNS]
        return (a**2).sum(axis=1)[:, None] - 2 * a @ b.T + (b**2).sum(axis=1)

    for at in range(0, len(rx), PORTION):
        part = rx[at:at + PORTION]
        # While many pairs are alive all of them go through a block at once; then only those left.
        near, d = block(part, 0), min(COLUMNS, dims)
        while d < dims and (near <= share(d)[:, None]).mean() > DENSE:
            near += block(part, d)
            d = min(d + COLUMNS, dims)
        who, cand = np.nonzero(near <= share(d)[:, None])
        total = near[who, cand]
        while d < dims:
            total = total + ((rq[who, d:d + COLUMNS] - part[cand, d:d + COLUMNS])**2).sum(axis=1)
            d = min(d + COLUMNS, dims)
            alive = total <= share(d)[who]
            who, cand, total = who[alive], cand[alive], total[alive]
        cut = np.searchsorted(who, np.arange(len(rq) + 1))
        for i in np.unique(who).tolist():
            kept[i] = np.concatenate([kept[i], cand[cut[i]:cut[i + 1]] + at])
            held[i] = np.concatenate([held[i], total[cut[i]:cut[i + 1]]])
            if len(held[i]) > k:
                limit[i] = min(limit[i], kth(held[i], k, None if label is None else label[kept[i]]) * (1 + 1e-9) + 1e-12)
                close = held[i] <= limit[i]
                kept[i], held[i] = kept[i][close], held[i][close]
    return kept


def search(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
           probed: float = PROBED) -> DataFrame:
    """(query_id, rank, id_col, score): the k nearest found of every row for which ``is_query`` holds, but itself."""
    rows = materialise(usable(vectors.where(F.col(id_col).isNotNull()), id_col, vector_col).distinct(), "ann-rows")
    asked = usable(vectors.where(is_query), id_col, vector_col).select(F.col("id").alias("query_id"), "x").distinct()
    schema = f"query_id long, rank int, {id_col} long, score double"
    index = fit(rows)
    if index is None:
        return vectors.sparkSession.createDataFrame([], schema)
    asked = asked.where(F.size("x") == index.dims)
    lists = len(index.centres)
    shared = vectors.sparkSession.sparkContext.broadcast(index)  # SAMPLE rows and at most MAX_LISTS centres
    # Equal vectors: the k + 1 smallest ids; the rank limit is applied before the shuffle as well.
    nth = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    distinct = (rows.withColumn("n", nth).where(F.col("n") <= k + 1).groupBy("x")
                .agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("id", F.col("ids")[0]))
    base = materialise(_placed(distinct, shared, 0, k + 1), "ann-base")
    queries = materialise(asked.groupBy("x").agg(F.min("query_id").alias("id")).withColumn("ids", F.array("id")), "ann-queries")
    probes = _placed(queries, shared, max(1, int(np.ceil(probed * lists))), k + 1)

    # Both sides of a list in blocks; every block of candidates meets every block of queries.
    def blocks(side: DataFrame, size: int) -> DataFrame:
        return side.groupBy("list").agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias("blocks"))

    probes = materialise(probes, "ann-probes")
    n_base, n_query = blocks(base, BLOCK), blocks(probes, QUERY_BLOCK)

    def dealt(side: DataFrame, own: DataFrame, other: DataFrame, mine: str, theirs: str) -> DataFrame:
        return (side.join(F.broadcast(own.withColumnRenamed("blocks", "own")), "list")  # at most MAX_LISTS rows
                .join(F.broadcast(other.withColumnRenamed("blocks", "other")), "list")
                .withColumn(mine, F.pmod(F.xxhash64("id"), F.col("own")).cast("int"))
                .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col("other") - 1)))
                .select("list", "base_block", "query_block", "id", "ids", "x", "least"))

    left = dealt(base, n_base, n_query, "base_block", "query_block")
    right = dealt(probes, n_query, n_base, "query_block", "base_block")

    def scan(base_rows: pd.DataFrame, query_rows: pd.DataFrame) -> pd.DataFrame:
        if not len(base_rows) or not len(query_rows):
            return pd.DataFrame({"probe": [], "ids": [], "score": []})
        index = shared.value
        x, q = np.array(base_rows.x.tolist()), np.array(query_rows.x.tolist())
        limit = index.limit(q, query_rows.least.to_numpy())
        # The smallest id of equal vectors: it repeats only where an id has several vectors.
        label = base_rows.id.to_numpy()
        label = label if len(np.unique(label)) < len(label) else None
        survivors = scan_block(index.rotate(q, True), index.rotate(x, False), limit, k + 1, label)
        probe, ids, score = [], [], []
        for i, near in enumerate(survivors):
            if not len(near):
                continue
            exact = np.array([np.dot(x[j], q[i]) for j in near])
            best = np.argsort(-exact, kind="stable")
            best = best[exact[best] >= -kth(-exact, k + 1, None if label is None else label[near])]  # ties with the last one stay
            probe.extend([query_rows.id.iloc[i]] * len(best))
            ids.extend(base_rows.ids.iloc[near[j]] for j in best)
            score.extend(exact[best])
        return pd.DataFrame({"probe": probe, "ids": ids, "score": score})

    keys = ["list", "base_block", "query_block"]
    found = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
             .applyInPandas(scan, "probe long, ids array<long>, score double"))

    def seeded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            best = [shared.value.first(np.asarray(x), k + 1) for x in batch.x]
            yield pd.DataFrame({"probe": np.repeat(batch.id.to_numpy(), [len(ids) for ids, _ in best]),
                                "ids": [[i] for ids, _ in best for i in ids],
                                "score": [s for _, scores in best for s in scores]})

    found = found.unionByName(queries.select("id", "x").mapInPandas(seeded, "probe long, ids array<long>, score double"))
    order = Window.partitionBy("probe").orderBy(F.desc("score"), "vec")
    nearest = (found.select("probe", F.explode("ids").alias("vec"), "score").groupBy("probe", "vec").agg(F.max("score").alias("score"))
               .withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
               .groupBy("probe").agg(F.sort_array(F.collect_list(F.struct("n", "vec", "score"))).alias("near")))
    # Back to every query row: its representative's nearest without itself.
    asked = asked.join(queries.select("x", F.col("id").alias("probe")), "x").select("query_id", "probe")
    mine = (asked.join(nearest, "probe")
            .select("query_id", F.slice(F.filter("near", lambda v: v.vec != F.col("query_id")), 1, k).alias("near"))
            .select("query_id", F.posexplode("near").alias("at", "hit")))
    return mine.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec").alias(id_col),
                       F.col("hit.score").alias("score"))
