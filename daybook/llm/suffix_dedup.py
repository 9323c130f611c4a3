"""Exact substring deduplication by longest-previous-factor arrays, over any number of tasks.

A byte position of the corpus starts a *repeat* if its next ``LENGTH`` bytes
(inside one text) also start anywhere else.  Repeats are read off suffix arrays.  In suffix order, with the
common prefixes of neighbours, the longest factor that a position shares with any
earlier one (its LPF value) is the larger of its common prefixes with two entries: the nearest
before it and the nearest after it whose positions are smaller (Crochemore & Ilie 2008).
The mirror, the nearest entries whose positions are larger, gives the longest factor shared with a
later one.  Values are capped at LENGTH.  A position has an earlier copy if its LPF
value is LENGTH, a later one if the mirror's is.

One suffix array of everything would be one task's work, so the positions are
dealt first.  The strings of LENGTH bytes at consecutive positions are cut into
*stretches* by their minimiser, the smallest hash among their 64-byte substrings:
equal strings have equal minimisers at equal offsets, so a string's copies are
all found in stretches with the same minimiser.

1. Every text gives its stretches: minimiser, digest of the stretch's bytes, place.
2. Minimisers that occur once have no repeats.  Stretches equal as a whole to
   another one consist of repeats.
3. What is left, different stretches of one minimiser, is compared by suffix
   arrays, built in the tasks over groups of minimisers.  A minimiser with more
   than ``GROUP`` different stretches is split by what stands left and right of
   it, in at most nine halvings of the range of offsets, until its parts are
   small or consist of one string each; so no group grows with the corpus.
   Facts about minimisers and groups that many rows have are broadcast; their rows stay where they are.

All copies of a repeat are removed; with ``keep_first`` the first one, in the
order (text digest, position), stays, and of equal texts the row with the
smallest id.

Equal texts are compared once; those of LENGTH bytes or more consist of
repeats.  A null text counts as empty.  Texts are read whole, of any length.
Repeated rows are copies of each other.  Input columns named like an output
column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import chunks, flat_bytes, join_counted, materialise, mix64, replace_columns, text_bytes

LENGTH = 400
GRAM = 64                          # bytes of a minimiser
REACH = LENGTH - GRAM              # largest offset of a minimiser in its string
GROUP = 1024                       # different stretches of a minimiser that are compared together
CHUNK = 1 << 20
PLACE_BITS = np.uint64(31)

RUNS = "struct<runs:array<struct<h:bigint,f:binary,start:int,n:int,anchor:int,times:int>>,own:array<struct<from:int,to:int>>>"
RUN = pa.struct([("h", pa.int64()), ("f", pa.binary()), ("start", pa.int32()), ("n", pa.int32()),
                 ("anchor", pa.int32()), ("times", pa.int32())])
RANGE = pa.struct([("from", pa.int32()), ("to", pa.int32())])


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each position, for all but the last GRAM - 1."""
    words = np.lib.stride_tricks.sliding_window_view(np.ascontiguousarray(raw), 8).copy().view(np.uint64).ravel()
    hashed, size = mix64(words + np.uint64(0x9E3779B97F4A7C15)), 8
    while size < GRAM:
        hashed = mix64(hashed[:-size] * np.uint64(0xD1B54A32D192ED03) + hashed[size:])
        size *= 2
    return hashed


def stretches(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, number of strings, minimiser's place and hash of every stretch of concatenated texts."""
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return none, none, none, none, none.astype(np.uint64)
    hashed = gram_hashes(raw)
    width = REACH + 1
    value = (hashed >> PLACE_BITS << PLACE_BITS) | np.arange(len(hashed), dtype=np.uint64)
    pad = -len(value) % width
    grid = np.concatenate((value, np.full(pad, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(raw) - LENGTH + 1
    least = (np.minimum(back[:count], ahead[REACH:REACH + count]) & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    size = np.diff(offsets)
    inside = np.zeros(count + 1, np.int64)
    long = np.flatnonzero(size >= LENGTH)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, np.minimum(offsets[long + 1] - LENGTH + 1, count), -1)
    valid = np.cumsum(inside[:count]) > 0
    start = np.flatnonzero(valid & np.concatenate(([True], (least[1:] != least[:-1]) | ~valid[:-1])))
    # Two texts can meet without a gap between their strings only if LENGTH is 1.
    ends = np.flatnonzero(valid & np.concatenate(((least[1:] != least[:-1]) | ~valid[1:], [True]))) + 1
    text = np.searchsorted(offsets, start, "right") - 1
    anchor = least[start]
    return text, start - offsets[text], ends - start, anchor - offsets[text], hashed[anchor]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def runs_of(text: Column | str, keep_first: bool = False) -> Column:
    """A text's different stretches, with how often each occurs in it, and the starts that repeat as whole stretches
    (with ``keep_first``: but for the first of each)."""

    def rows(column: pa.Array) -> Iterator[dict]:
        for a, b in chunks(np.asarray(pc.binary_length(column)) + 1, CHUNK):
            part = column.slice(a, b - a)
            raw, offsets = flat_bytes(part)
            found = [x.tolist() for x in stretches(raw, offsets)]
            at, total = 0, len(found[0])
            for i, data in enumerate(part.to_pylist()):
                seen: dict[tuple[int, bytes], dict] = {}
                places: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
                while at < total and found[0][at] == i:
                    _, start, n, anchor, h = (x[at] for x in found)
                    f = hashlib.blake2b(data[start:start + n - 1 + LENGTH], digest_size=16).digest()
                    h = h - (1 << 64) if h >> 63 else h
                    if (h, f) in seen:
                        seen[h, f]["times"] += 1
                    else:
                        seen[h, f] = {"h": h, "f": f, "start": start, "n": n, "anchor": anchor - start, "times": 1}
                    places.setdefault((h, f), []).append((start, start + n))
                    at += 1
                own = merged([x for p in places.values() if len(p) > 1 for x in p[keep_first:]])
                yield {"runs": list(seen.values()), "own": [{"from": x, "to": y} for x, y in own]}

    @F.arrow_udf(RUNS)
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(rows(text_bytes(column)), pa.struct([("runs", pa.list_(RUN)), ("own", pa.list_(RANGE))]))

    return udf(text)


def suffix_order(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts in suffix order by LENGTH bytes, equal ones by place, and the common prefix of each with the one before
    it (capped at LENGTH; 0 for the first).

    Prefix doubling (Manber & Myers 1993): ranks by 8 bytes, then 16, ... 256; the rank by LENGTH bytes is that of the
    pair of 256-byte ranks at both ends.  Common prefixes are put together from the same ranks, the largest first.
    """
    padded = np.concatenate((raw, np.zeros(2 * LENGTH + 8, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view(">u8").ravel()
    ranks, size = [(8, np.unique(words, return_inverse=True)[1].astype(np.int32))], 8
    while size * 2 <= LENGTH:
        rank = ranks[-1][1]
        pair = rank[:-size].astype(np.int64) * (len(padded) + 1) + rank[size:]
        size *= 2
        ranks.append((size, np.unique(pair, return_inverse=True)[1].astype(np.int32)))
    top = ranks[-1][1]
    pair = top[starts].astype(np.int64) * (len(padded) + 1) + top[starts + LENGTH - size]
    order = np.lexsort((starts, pair))
    at = starts[order]
    same = np.concatenate(([False], pair[order][1:] == pair[order][:-1])) if len(at) else np.zeros(0, bool)
    common = np.where(same, LENGTH, 0)
    todo = np.flatnonzero(~same)[1:]
    p, q, n = at[todo - 1].copy(), at[todo].copy(), np.zeros(len(todo), np.int64)
    for size, rank in reversed(ranks):
        equal = rank[p + n] == rank[q + n]
        n[equal] += size
    for _ in range(7):
        equal = padded[p + n] == padded[q + n]
        n[equal] += 1
        # A byte that differs ends it; the places then stay as they are.
        p, q = np.where(equal, p, -1 - n), np.where(equal, q, -1 - n)
        if not equal.any():
            break
        keep = np.flatnonzero(equal)
        common[todo] = np.maximum(common[todo], np.minimum(n, LENGTH))
        p, q, n, todo = p[keep], q[keep], n[keep], todo[keep]
    else:
        common[todo] = np.maximum(common[todo], np.minimum(n, LENGTH))
    if len(todo):
        common[todo] = np.maximum(common[todo], np.minimum(n, LENGTH))
    return order, common


def longest_factors(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The longest factor that each start shares with a smaller one, from suffix order: the LPF array, by start.

    ``order`` holds places, which stand for positions; the nearest smaller entries on both sides come by
    following links, with the least common prefix on the way.
    """
    n = len(order)

    def side(place: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Common prefix of each entry with the nearest one before it of a smaller place; ``least`` is that with its neighbour."""
        link = np.arange(-1, n - 1)
        least = least.copy()
        open_ = np.flatnonzero((link >= 0) & (place[link] > place))
        # Ends: an entry whose link is smaller, or none, is settled; others go on from their link's link, two at a time.
        while len(open_):
            to = link[open_]
            least[open_] = np.minimum(least[open_], least[to])
            link[open_] = link[to]
            now = link[open_]
            open_ = open_[(now >= 0) & (place[now] > place[open_])]
        return np.where(link >= 0, least, 0)

    before = side(order, common)
    after = side(order[::-1].copy(), np.concatenate((common[1:], [0]))[::-1].copy())[::-1]
    out = np.zeros(n, np.int64)
    out[order] = np.maximum(before, after)
    return out


def suffix_runs(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(has an earlier match, has a later match) of LENGTH bytes for each start; ``starts`` are ascending."""
    order, common = suffix_order(raw, starts)
    earlier = longest_factors(order, common) >= LENGTH
    # The mirror: places in reverse.
    later = longest_factors(len(order) - 1 - order, common)[::-1] >= LENGTH
    return earlier, later


def _compare(rows: DataFrame, keep_first: bool) -> DataFrame:
    """(key, from, to): repeats among the stretches (g, key, start, once, low, high, bytes) of each group g.

    low and high: the part of a stretch's strings that the group is about, as first and last + 1.
    """

    def work(held: list[tuple]) -> pa.RecordBatch:
        raw = np.frombuffer(b"".join(r[5] for r in held), np.uint8)
        base = np.concatenate(([0], np.cumsum([len(r[5]) for r in held])))
        count = np.array([r[4] - r[3] for r in held])
        owner = np.repeat(np.arange(len(held)), count)
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.array([r[3] for r in held])[owner]
        earlier, later = suffix_runs(raw, base[owner] + inside)
        out = []
        once = np.array([r[2] for r in held])[owner]
        hit = np.flatnonzero(earlier if keep_first else (earlier | later) & once)
        if len(hit):
            cut = np.flatnonzero(np.concatenate(([True], (np.diff(owner[hit]) != 0) | (np.diff(inside[hit]) != 1))))
            for a, b in zip(cut.tolist(), np.append(cut[1:], len(hit)).tolist(), strict=True):
                r = held[owner[hit[a]]]
                out.append((r[0], r[1] + int(inside[hit[a]]), r[1] + int(inside[hit[b - 1]]) + 1))
        return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int32()),
                                           pa.array([o[2] for o in out], pa.int32())], ["key", "from", "to"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, group = [], 0, None
        for batch in batches:
            for g, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= CHUNK and g != group:
                    yield work(held)
                    held, size = [], 0
                group = g
                held.append(tuple(row))
                size += len(row[5])
        if held:
            yield work(held)

    return (rows.select("g", "key", "start", "once", "low", "high", "bytes").repartition("g").sortWithinPartitions("g", "key", "start")
            .mapInArrow(compare, "key binary, from int, to int"))


def _halve(rows: DataFrame, turn: int) -> DataFrame:
    """The stretches of large groups in groups by the bytes that all strings with the minimiser at an offset of
    the same part of 0 ... 511 have in common; parts halve with every turn."""
    size = 512 >> turn

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(n).to_pylist() for n in ("h", "key", "start", "once", "anchor", "low", "high", "bytes")]
            for h, key, start, once, anchor, low, high, data in zip(*columns, strict=True):
                # String s (low <= s < high) has its minimiser at the offset anchor - s.
                for part in range((anchor - high + 1) // size, (anchor - low) // size + 1):
                    least, most = part * size, min(part * size + size - 1, REACH)
                    common = data[anchor - least:anchor + GRAM + REACH - most]
                    g = hashlib.blake2b(common, digest_size=16, key=b"%d %d %d" % (h, turn, part)).digest()
                    out.append((g, h, key, start, once, anchor, max(low, anchor - most), min(high, anchor - least + 1), data))
            names = ["g", "h", "key", "start", "once", "anchor", "low", "high", "bytes"]
            kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kinds[k]) for k in range(9)], names)

    return rows.mapInArrow(split, "g binary, h bigint, key binary, start int, once boolean, anchor int, low int, high int, "
                                  "bytes binary")


def _contested(rows: DataFrame, keep_first: bool) -> DataFrame:
    """Repeats (key, from, to) among different stretches (h, key, start, once, anchor, low, high, bytes, many) of one minimiser."""
    small = rows.where(f"many <= {GROUP}").withColumn("g", F.col("h").cast("string").cast("binary"))
    found = [_compare(small, keep_first)]
    large = rows.where(f"many > {GROUP}").drop("many")
    turn = 0
    while turn < 10 and large.limit(1).count():
        parts = materialise(_halve(large, turn), "halves")
        sizes = materialise(parts.groupBy("g").agg(F.count("*").alias("n_rows")).where("n_rows > 1"), "sizes")
        parts = join_counted(parts, sizes, "g").withColumnRenamed("n_rows", "many")
        if turn == 9:
            # Parts of one offset: what is common is the whole string.
            strings = parts.select("g", "once", "key", (F.col("start") + F.col("low")).alias("from"),
                                   (F.col("start") + F.col("high")).alias("to"))
            if keep_first:
                first = strings.groupBy("g").agg(F.min(F.struct("key", "from")).alias("first"))
                strings = strings.join(first, "g").where(F.struct("key", "from") != F.col("first"))
            else:
                strings = strings.where("once")
            found.append(strings.select("key", "from", "to"))
        else:
            parts = materialise(parts, "parts")
            found.append(_compare(parts.where(f"many <= {GROUP}"), keep_first))
            large = parts.where(f"many > {GROUP}").drop("g", "many")
        turn += 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _cut(of: DataFrame) -> DataFrame:
    """(h, key, start, once, anchor, low, high, bytes, many) of rows (key, text, wanted)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(w["h"], key, w["start"], w["once"], w["anchor"], 0, w["n"], data[w["start"]:w["start"] + w["n"] - 1 + LENGTH], w["many"])
                   for key, data, wanted in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)).to_pylist(),
                                                batch.column(2).to_pylist(), strict=True) for w in wanted]
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
            names = ["h", "key", "start", "once", "anchor", "low", "high", "bytes", "many"]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kinds[k]) for k in range(9)], names)

    return of.mapInArrow(cut, "h bigint, key binary, start int, once boolean, anchor int, low int, high int, bytes binary, many bigint")


def repeats(docs: DataFrame, text_col: str = "text", keep_first: bool = False) -> DataFrame:
    """(key, copies, ranges) of every distinct text: key is its md5, ranges the starts of repeats, as [from, to)
    (with ``keep_first``: of those that another text or place has before)."""
    source = docs.select(F.coalesce(text_col, F.lit("")).alias("text")).select(F.unhex(F.md5("text")).alias("key"), "text")
    texts = materialise(
        source.select("key", runs_of("text", keep_first).alias("r"))
        .groupBy("key").agg(F.count("*").alias("copies"), F.first("r").alias("r")).select("key", "copies", "r.*"), "stretches")
    runs = texts.select("key", F.explode("runs").alias("r")).select("key", "r.*")
    counts = runs.groupBy("h").agg(F.sum("times").alias("times"), F.count("*").alias("n_rows"))
    shared = materialise(join_counted(runs, materialise(counts.where("times > 1").select("h", "n_rows"), "counts"), "h").drop("n_rows"), "shared")
    whole = shared.groupBy("h", "f").agg(F.sum("times").alias("times"), F.count("*").alias("texts"),
                                         F.min(F.struct("key", "start", "n", "anchor")).alias("one"))
    whole = materialise(whole, "whole")
    many = materialise(whole.groupBy("h").agg(F.count("*").alias("n_rows")).where("n_rows > 1"), "many")
    # One stretch of each kind stands for its equals; only stretches that occur once need a decision.
    wanted = (join_counted(whole, many, "h").withColumnRenamed("n_rows", "many").groupBy("one.key").agg(F.collect_list(F.struct(
        "h", F.col("one.start").alias("start"), F.col("one.n").alias("n"), F.col("one.anchor").alias("anchor"),
        (F.col("times") == 1).alias("once"), "many")).alias("wanted")))
    cut = materialise(_cut(source.groupBy("key").agg(F.first("text").alias("text")).join(wanted, "key")
                           .select("key", "text", "wanted")), "cut")
    several = whole.where("texts > 1").select("f", F.col("texts").alias("n_rows"), F.col("one.key").alias("first"))
    equal = (join_counted(shared.drop("h"), materialise(several, "several"), "f")
             .where(F.col("key") != F.col("first") if keep_first else F.lit(True)).select("key", F.col("start").alias("from"), (F.col("start") + F.col("n")).alias("to")))
    found = (equal.unionByName(_contested(cut, keep_first)).groupBy("key")
             .agg(F.collect_list(F.struct("from", "to")).alias("found")))
    return texts.select("key", "copies", "own").join(found, "key", "left").select(
        "key", "copies", F.concat("own", F.coalesce("found", F.array().cast("array<struct<from:int,to:int>>"))).alias("ranges"))


RESULT = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                    ("kept_sha256", pa.string()), ("kept", pa.binary())])


def remove_repeats(docs: DataFrame, text_col: str = "text", with_kept: bool = True, keep_first: bool = False,
                   key_col: str = "doc_id") -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, ``kept``: the remaining bytes.

    ``keep_first``: see the module.  Of equal texts it keeps the row with the
    smallest ``key_col`` (a null one if all are null; all rows with that id).
    """
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    found = repeats(docs, text_col, keep_first)

    def rows(texts: pa.Array, copied: pa.Array, ranges: pa.Array) -> Iterator[dict]:
        for data, copy, pairs in zip(text_bytes(texts).to_pylist(), copied.to_pylist(), ranges.to_pylist(), strict=True):
            gone = merged([(p["from"], p["to"] - 1 + LENGTH) for p in pairs or ()])
            if copy and len(data) >= LENGTH:
                gone = [(0, len(data))]
            kept, at = [], 0
            for a, b in gone:
                kept.append(data[at:a])
                at = b
            kept = b"".join([*kept, data[at:]])
            yield {"n_bytes": len(data), "n_removed": len(data) - len(kept), "n_spans": len(gone),
                   "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept if with_kept else None}

    @F.arrow_udf("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string,kept:binary>")
    def removed(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, copied, ranges in batches:
            yield pa.array(rows(texts, copied, ranges), RESULT)

    base = replace_columns(docs, *names)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("_row"),
                        F.coalesce(text_col, F.lit("")).alias("_text"),
                        (F.col(key_col) if keep_first else F.lit(None)).alias("_id"))
    keyed = keyed.withColumn("key", F.unhex(F.md5("_text")))
    copied = F.col("copies") > 1
    if keep_first:
        found = found.join(keyed.groupBy("key").agg(F.min("_id").alias("_first")), "key")
        copied = copied & ~F.col("_id").eqNullSafe(F.col("_first"))
    out = keyed.join(found, "key").withColumn("_copied", copied).select("_row", removed("_text", "_copied", "ranges").alias("_r"))
    return out.select("_row.*", *[f"_r.{n}" for n in names[:4 + with_kept]])
