"""Near-duplicate classes by BagMinHash signatures, banding and exact verification.

A text is the multiset of its five-word shingles.  BagMinHash (Ertl 2018) gives
``SLOTS`` values whose share of agreement between two texts is an unbiased
estimate of their weighted Jaccard similarity: for each shingle, the weight axis
is cut into the dyadic intervals [0,1), [1,2), [2,4), ... and each interval is
an independent Poisson process of unit rate, seeded by shingle and interval.  A
point counts if its discretised level lies below the shingle's weight; a slot
keeps the earliest time among its points.  Points are made in time order and
only up to a time by which all slots are expected to be full (extended where
they are not), so the cost does not grow with weights.

``BANDS`` x ``ROWS`` slots are hashed into buckets (a pair of similarity 0.8
shares one but for 1 in 30,000).  Inside a bucket texts are compared with a
leader, not with each other, and each text at first only with one, the first of its
buckets' leaders; links of at least 0.8, verified exactly on the
multisets, are joined into components.  Texts in buckets that still hold several
components meet the first leaders of other components in another order, and at last
all texts of those buckets meet in blocks.  Texts of one family stand side by side
in blocks of about ``BLOCK`` bytes; a text moves once for each block in which a text
of another component shares a bucket with it, and a task compares the texts of two
blocks, by their overlaps exactly.  Members of one component are never paired, and
a text of which less than 0.8 lies on shingles that any other text in the two
blocks has drops out by this exact bound.  So a group of a million copies costs
about a million comparisons; of a group whose similarities lie on both sides of
0.8 every pair has to be compared if no link is to be lost, but rows that move
are fewer than these pairs by the number of texts in a block, and a task holds two blocks.

Exact copies are one node from the start.  Null texts have no shingles and stay
alone; empty and blank texts have none either and are linked to exact copies
only.  A text of fewer than five words is one shingle.  Nothing is capped; hot
leaders are dealt over several tasks.  Input columns named like an output
column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import bags, chunks, join_counted, materialise, mix64, replace_columns, text_bytes, uniform, word_hashes
from daybook.llm.graph import components

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 5, 26
SLOTS = ROWS * BANDS
CHUNK = 1 << 20           # text bytes whose signatures are made together
PAIRS = (1, 2)            # in each round with leaders: how many of them a text is compared with, at most
BLOCK = 1 << 20           # text bytes that are compared with as many others in one task, about
SALT_ROWS = 200           # members compared with one leader in one task, about
ROUNDING = 1e-9           # relative room for rounding in bounds on overlaps; the exact check follows

STRIDE = np.uint64(0x9E3779B97F4A7C15)
FACTORS = mix64(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every shingle of the texts (a binary array without nulls), in order."""
    row, word = word_hashes(column)
    n = len(word)
    padded = np.concatenate((word, np.zeros(SHINGLE, np.uint64)))
    rows = np.concatenate((row, np.full(SHINGLE, -1)))
    total = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        total += np.where(rows[j:n + j] == row, padded[j:n + j], np.uint64(0)) * FACTORS[j]
    opens = np.concatenate(([True], row[1:] != row[:-1]))
    full = rows[SHINGLE - 1:n + SHINGLE - 1] == row
    keep = full | opens & ~full  # a short text's first word starts its one shingle
    return row[keep], mix64(total[keep])


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """BagMinHash values (n x SLOTS, uint64 views of times); rows without shingles keep the largest value."""
    out = np.full(n * SLOTS, np.inf)
    total = np.bincount(row, weights=weight, minlength=n)
    limit = SLOTS * (np.log(SLOTS) + 3.0) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        use = todo[row]
        who, seed, most = row[use], shingle[use], weight[use]
        interval = 0
        while len(who):
            # Interval 0 is [0, 1), interval k is [2^(k-1), 2^k): as many levels, and that rate.
            low = 0 if interval == 0 else 1 << (interval - 1)
            _points(out, who, mix64(seed + np.uint64(interval * int(STRIDE) % (1 << 64))), most, low, max(low, 1), limit)
            interval += 1
            more = most > (1 << (interval - 1))
            who, seed, most = who[more], seed[more], most[more]
        todo &= np.isinf(out.reshape(n, SLOTS)).any(axis=1)
        limit = np.where(todo, limit * 2, limit)
    return out.view(np.uint64).reshape(n, SLOTS)


def _points(out, who, seed, most, low: int, levels: int, limit) -> None:
    """Adds the points of one interval of each shingle up to its row's time limit."""
    time = np.zeros(len(who))
    state = seed
    last = limit[who]
    while len(who):
        state = state + STRIDE
        draw = mix64(state)
        time = time - np.log(uniform(draw)) / levels
        alive = time <= last
        who, state, most, last, time, draw = (x[alive] for x in (who, state, most, last, time, draw))
        place = mix64(draw ^ STRIDE)
        slot = ((place >> np.uint64(40)) * np.uint64(SLOTS) >> np.uint64(24)).astype(np.int64)
        if levels == 1:
            np.minimum.at(out, who * SLOTS + slot, time)
        else:
            level = low + ((place & np.uint64(0xFFFFFFFF)) * np.uint64(levels) >> np.uint64(32)).astype(np.int64)
            inside = level < most
            np.minimum.at(out, who[inside] * SLOTS + slot[inside], time[inside])


def band_hashes(column: pa.Array) -> np.ndarray:
    """Bucket numbers (texts x BANDS, int64) and which texts have shingles."""
    parts = []
    for a, b in chunks(np.asarray(pc.binary_length(column)) + 1, CHUNK):
        row, shingle = shingles(column.slice(a, b - a))
        sig = signatures(*bags(row, shingle), b - a)
        hashed = np.zeros((b - a, BANDS), np.uint64)
        for r in range(ROWS):
            hashed = mix64(hashed * STRIDE + sig[:, r::ROWS])
        hashed = mix64(hashed + np.arange(BANDS, dtype=np.uint64) * STRIDE)
        parts.append((hashed.view(np.int64), np.bincount(row, minlength=b - a) > 0))
    if not parts:
        return np.zeros((0, BANDS), np.int64), np.zeros(0, bool)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def bands(text: Column | str) -> Column:
    """Bucket numbers of a text; none for a text without words."""

    @F.arrow_udf("array<bigint>")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            buckets, some = band_hashes(text_bytes(column))
            offsets = pa.array(np.concatenate(([0], np.cumsum(some * BANDS))).astype(np.int32))
            yield pa.ListArray.from_arrays(offsets, pa.array(buckets[some].ravel()))

    return hashed(text)


def weighted_jaccard(a: tuple, b: tuple) -> float:
    """Similarity of two multisets given as (sorted distinct hashes, counts)."""
    (x, m), (y, n) = a, b
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = np.minimum(m[i], n[j]).sum()
    return float(common / (m.sum() + n.sum() - common)) if len(x) and len(y) else 0.0


def text_key(text: Column | str) -> Column:
    return F.unhex(F.md5(F.col(text) if isinstance(text, str) else text))


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Of the pairs (a, b) of nodes those whose texts (node, text) are similar enough; pairs are compared by their a."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(SALT_ROWS)).cast("int").alias("salts"))
    members = (pairs.join(salts, "a")
               .select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.col("b").alias("node")))
    leaders = salts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                           F.col("a").alias("node"))
    wanted = members.unionByName(leaders)
    rows = (wanted.join(texts, "node").select("a", "salt", (F.col("a") != F.col("node")).alias("member"), "node", "text")
            .repartition("a", "salt").sortWithinPartitions("a", "salt", "member"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, leader = None, None
        for batch in batches:
            a, salt, member, node = (batch.column(k).to_pylist() for k in range(4))
            column = text_bytes(batch.column(4))
            found: list[tuple[int, int]] = []
            for x, y in chunks(np.asarray(pc.binary_length(column)) + 1):
                row, shingle, count = bags(*shingles(column.slice(x, y - x)))
                cut = np.searchsorted(row, np.arange(y - x + 1))
                for i in range(x, y):
                    bag = shingle[cut[i - x]:cut[i - x + 1]], count[cut[i - x]:cut[i - x + 1]]
                    if not member[i]:
                        group, leader = (a[i], salt[i]), bag
                    elif (a[i], salt[i]) == group and weighted_jaccard(leader, bag) >= similarity:
                        found.append((a[i], node[i]))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.int64())], ["a", "b"])

    return rows.mapInArrow(compare, "a long, b long")


def _open_buckets(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (band, node, comp) of buckets that hold more than one component."""
    rows = buckets.join(labels, "node", "left").select("band", "node", F.coalesce("comp", "node").alias("comp"))
    return _several(rows)


def _several(rows: DataFrame) -> DataFrame:
    rows = materialise(rows, "members")
    bands_ = rows.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("n_rows"))
    return join_counted(rows, materialise(bands_.where("low <> high").select("band", "n_rows"), "bands"), "band").select("band", "node", *[
        c for c in rows.columns if c not in ("band", "node")])


def _with_leaders(members: DataFrame, turn: int) -> DataFrame:
    """Pairs (x, y, a, b) of the texts of open buckets (band, node, comp) with the first PAIRS[turn] leaders of theirs.

    A bucket's leader is its first text, by number in the first turn, by a hash of number and turn later.
    """
    rank = F.col("node") if turn == 0 else F.xxhash64("node", F.lit(turn))
    lead = materialise(members.groupBy("band").agg(F.min(F.struct(rank.alias("rank"), "node", "comp")).alias("lead"),
                                                   F.count("*").alias("n_rows")), "leaders")
    # The leaders of a text's buckets are gathered before anything else moves; a text has BANDS of them at most.
    met = (join_counted(members, lead, "band").where("comp <> lead.comp").groupBy("node")
           .agg(F.slice(F.sort_array(F.collect_set("lead")), 1, PAIRS[turn]).alias("leads")))
    pairs = met.select("node", F.explode("leads.node").alias("lead"))
    return pairs.select(F.least("node", "lead").alias("x"), F.greatest("node", "lead").alias("y"),
                        F.col("lead").alias("a"), F.col("node").alias("b"))


def _in_blocks(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, comp, bands, text, block) of the members (band, node, comp): texts of one family side by side, cut by bytes.

    Nodes are in the order of the least node they share a bucket with, then of their component.  No family is held
    together for it: a shuffle by ranges sorts, and sums of the ranges' bytes turn places inside into places overall.
    """
    least = materialise(members.groupBy("band").agg(F.min("node").alias("least"), F.count("*").alias("n_rows")), "least")
    nodes = (join_counted(members, least, "band").groupBy("node", "comp")
             .agg(F.min("least").alias("least"), F.collect_set("band").alias("bands")))
    nodes = materialise(nodes.join(texts, "node"), "members")
    order = ["least", "comp", "node"]
    rows = materialise(nodes.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
                       .withColumn("size", F.octet_length("text") + 1), "ordered")
    before = F.sum("size").over(Window.partitionBy("part").orderBy(*order)) - F.col("size")
    parts = rows.groupBy("part").agg(F.sum("size").alias("bytes"))
    start = parts.select("part", (F.sum("bytes").over(Window.orderBy("part")) - F.col("bytes")).alias("start"))
    placed = rows.withColumn("before", before).join(F.broadcast(start), "part")
    block = F.floor((F.col("start") + F.col("before")) / F.lit(BLOCK)).alias("block")
    return materialise(placed.select("node", "comp", "bands", "text", block), "blocks")


def _block_pairs(placed: DataFrame) -> DataFrame:
    """Rows (low, high, node, comp, first, bands, text): a node in each pair of blocks in which a text of another component is in one of its buckets."""
    rows = materialise(placed.select("node", "comp", "block", F.explode("bands").alias("band")), "members")
    spans = rows.groupBy("band", "block").agg(F.min("comp").alias("least"), F.max("comp").alias("most"))
    found = spans.groupBy("band").agg(F.collect_list(F.struct("block", "least", "most")).alias("spans"))
    other = F.filter("spans", lambda x: (x["least"] != F.col("comp")) | (x["most"] != F.col("comp")))
    met = (rows.join(found, "band").select("node", F.sort_array(F.transform(other, lambda x: x["block"])).alias("blocks"))
           .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_set("blocks"))).alias("blocks")))
    return (met.join(placed, "node").select("node", "comp", "bands", "text", "block", F.explode("blocks").alias("other"))
            .select(F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "comp",
                    (F.col("block") <= F.col("other")).alias("first"), "bands", "text"))


def _block_links(node: np.ndarray, comp: np.ndarray, first: np.ndarray, bands: list, column: pa.Array, same: bool,
                 similarity: float) -> list[tuple[int, int]]:
    """Links that join components, between the texts of two blocks (``first``: those of the first) or of one (``same``)."""
    n = len(node)
    parts = [(x, bags(*shingles(column.slice(x, y - x)))) for x, y in chunks(np.asarray(pc.binary_length(column)) + 1)]
    row = np.concatenate([x + p[0] for x, p in parts])
    _, code, texts = np.unique(np.concatenate([p[1] for _, p in parts]), return_inverse=True, return_counts=True)
    count = np.concatenate([p[2] for _, p in parts])
    total = np.bincount(row, weights=count, minlength=n)
    # A shingle of one text only is in no overlap; a text has no partner if the others are too small a part of it.
    shared = np.bincount(row, weights=np.where(texts[code] > 1, count, 0), minlength=n)
    use = (texts[code] > 1) & (shared >= similarity * (1 - ROUNDING) * total)[row]
    row, code, count = row[use], code[use], count[use]
    cut = np.searchsorted(row, np.arange(n + 1))
    kept = np.flatnonzero(np.diff(cut))
    left = kept if same else kept[first[kept]]
    right = kept if same else kept[~first[kept]]
    at = cut[right]
    size = cut[right + 1] - at
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(at, size)
    code_r, count_r = code[inside], count[inside]
    starts = np.cumsum(size) - size
    label = np.unique(comp, return_inverse=True)[1]
    weight = np.zeros(len(texts), count.dtype)
    sets: dict[int, frozenset] = {}
    found = []
    for a in left:
        k = np.searchsorted(right, a, "right") if same else 0  # pairs inside a block once
        if k == len(right) or (label[right[k:]] == label[a]).all():
            continue
        own = code[cut[a]:cut[a + 1]]
        weight[own] = count[cut[a]:cut[a + 1]]
        common = np.add.reduceat(np.minimum(weight[code_r[starts[k]:]], count_r[starts[k]:]), starts[k:] - starts[k])
        weight[own] = 0
        near = right[k:][common / (total[a] + total[right[k:]] - common) >= similarity]
        for b in near[label[near] != label[a]]:
            if label[a] == label[b]:
                continue
            for i in (a, b):
                if i not in sets:
                    sets[i] = frozenset(bands[i])
            if not sets[a].isdisjoint(sets[b]):
                found.append((int(node[a]), int(node[b])))
                label[label == label[b]] = label[a]
    return found


def _possible(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between nodes in one bucket and different components, as many as join all components that have any.

    Blocks of texts meet, not texts: a text moves once for each block that holds a possible partner, and a task compares two blocks.
    """
    rows = _block_pairs(_in_blocks(members, texts)).repartition("low", "high").sortWithinPartitions("low", "high", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts).combine_chunks()
            (low, high), (node, comp, first, bands_, text) = key, (t.column(k).combine_chunks() for k in range(2, 7))
            found = _block_links(node.to_numpy(), comp.to_numpy(), first.to_numpy(zero_copy_only=False), bands_.to_pylist(),
                                 text_bytes(text), low == high, similarity)
            return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                               pa.array([f[1] for f in found], pa.int64())], ["a", "b"])

        key, held = None, []
        for batch in batches:
            low, high = (batch.column(k).to_numpy() for k in range(2))
            edges = np.flatnonzero((low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
            for x, y in zip([0, *edges], [*edges, len(low)], strict=True):
                if x == y:
                    continue
                if key != (low[x], high[x]):
                    if held:
                        yield links(held)
                    key, held = (low[x], high[x]), []
                held.append(batch.slice(x, y - x))
        if held:
            yield links(held)

    return rows.mapInArrow(compare, "a long, b long")


def classes(docs: DataFrame, text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(key, node, comp) of every distinct text: key is its md5, comp the smallest node of its class."""
    spark = docs.sparkSession
    source = docs.select(text_key(text_col).alias("key"), F.col(text_col).alias("text")).where("key IS NOT NULL")
    nodes = (source.select("key", bands("text").alias("bands")).groupBy("key").agg(F.first("bands").alias("bands"))
             .withColumn("node", F.monotonically_increasing_id()))
    nodes = materialise(nodes, "nodes")  # numbers are fixed from here
    exploded = nodes.select("node", F.explode("bands").alias("band"))
    shared = materialise(exploded.groupBy("band").agg(F.count("*").alias("n_rows")).where("n_rows > 1"), "shared")
    buckets = materialise(join_counted(exploded, shared, "band").select("band", "node"), "buckets")
    # One text for each node that may have a link; copies of a text are one row a task before the shuffle.
    wanted = buckets.select("node").distinct().join(nodes.select("node", "key"), "node")
    texts = materialise(source.groupBy("key").agg(F.first("text").alias("text")).join(wanted, "key")
                        .select("node", "text"), "texts")
    links = done = None
    labels = spark.createDataFrame([], "node long, comp long")
    for turn in range(len(PAIRS) + 1):
        members = materialise(_open_buckets(buckets, labels), "open")
        if turn < len(PAIRS):
            pairs = _with_leaders(members, turn).dropDuplicates(["x", "y"])
            if done is not None:
                pairs = pairs.join(done, ["x", "y"], "left_anti")
            pairs = materialise(pairs, "pairs")
            if not pairs.limit(1).count():
                continue
            found = _verified(pairs.select("a", "b"), texts, similarity)
            seen = pairs.select("x", "y")
            done = seen if done is None else done.unionByName(seen)
        elif members.limit(1).count():
            found = _possible(members, texts, similarity)
        else:
            continue
        found = materialise(found, "links")
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    return (nodes.select("key", "node").join(labels, "node", "left")
            .select("key", "node", F.coalesce("comp", "node").alias("comp")))


def near_duplicates(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with class_id and class_size.

    ``class_id`` is the smallest id in the class (null if it has none); a row
    with a null text is a class of its own.
    """
    comps = materialise(classes(docs, text_col, similarity), "classes").select("key", "comp")
    stats = (docs.select(text_key(text_col).alias("key"), F.col(key_col).alias("id")).join(comps, "key").groupBy("comp")
             .agg(F.min("id").alias("class_id"), F.count("*").cast("long").alias("class_size")))
    found = comps.join(stats, "comp").select("key", "class_id", "class_size")
    base = replace_columns(docs, "class_id", "class_size")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("_row"), text_key(text_col).alias("key"),
                       F.col(key_col).alias("id")).join(found, "key", "left")
    alone = F.col("class_size").isNull()
    return rows.select("_row.*", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                       F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))


def deduplicate(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text",
                similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, in the columns of ``docs``: the first by id (nulls last), then by text hash.

    Of repeated rows with that id and text one stays.  Rows with a null text
    are classes of their own and all stay.  The row to keep is found on ids and
    hashes alone; texts move once, to meet it.
    """
    comps = materialise(classes(docs, text_col, similarity), "classes").select("key", "comp")
    other = [F.col(f"`{f.name}`") for f in docs.schema.fields
             if f.name != text_col and f.dataType.typeName() not in ("map", "variant")]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text_key(text_col).alias("key"),
                        F.col(key_col).alias("id"), F.xxhash64(*other, F.lit(0)).alias("mark"))
    best = (keyed.select("key", "id", "mark").join(comps, "key").groupBy("comp", "key", "id", "mark").agg(F.count("*").alias("n"))
            .groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key", "mark", "n")).alias("b"))
            .select(F.col("b.key").alias("k"), F.col("b.id").alias("i"), F.col("b.mark").alias("m"), "b.n"))
    # On key and id, not on the key alone: a text that fills a third of the table is dealt by its rows' ids.
    kept = keyed.join(best, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")))
    kept = materialise(kept.select("_row", "key", "id", "mark", "n"), "kept")
    again = F.row_number().over(Window.partitionBy("key", "id", "mark").orderBy("n"))
    one = kept.where("n > 1").withColumn("_n", again).where("_n = 1").select("_row.*")
    return kept.where("n = 1").select("_row.*").unionByName(one).unionByName(docs.where(F.col(text_col).isNull()))
