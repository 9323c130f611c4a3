"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its words (between white space, A-Z as a-z), each with its count
as the weight.  For every word and each of ``SLOTS`` slots three numbers are
drawn from a hash of (word, slot): r and c from a Gamma(2, 1) distribution, b
uniform in (0, 1).  For the weight S (Ioffe 2010)

    t = floor(ln S / r + b),   ln a = ln c - r (t - b + 1),

and the slot's sample is the (word, t) with the smallest a.  Two texts have the
same sample in a slot with a probability equal to the generalised Jaccard
similarity of their weights, the sum of the minima over the sum of the maxima;
``likeness`` is the share of equal slots, an unbiased estimate of it with a standard
error of at most 1 / (2 sqrt(SLOTS)).  A fingerprint writes 16 bits of each
sample as four hex digits; two different samples agree in them once in 65,536.

Draws are made once for each distinct word of a chunk of texts, so an edited text costs little
beyond its text.

Texts without words (null, empty or blank ones) have the empty fingerprint, like
each other (1) and no other text (0).  Texts of any length count whole; bounded
memory comes from working in chunks of texts and of words.  Equal texts have
equal fingerprints whatever the run or partitioning.

``compare_with_next`` puts rows in descending order of their key, nulls last,
rows of one key by a hash of the text: one range shuffle, in which each text moves once and
a key of many rows is split by position.  Tasks stream through their sorted
rows; only the last and the first row of each task meet in a join.  The result
holds the key and the columns stated, whatever other columns the input has.
The text after the last row's is the first row's; a single row follows itself; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daybook.llm.common import bags, chunks, materialise, mix64, replace_columns, text_bytes, word_hashes

SLOTS = 64
CHUNK = 1 << 20        # text bytes whose words share their draws
WORDS = 1 << 11        # words whose draws are made in one step
PAIRS = 1 << 13        # (text, word) pairs compared in one step
DIGITS = 4             # hex digits of a slot

STRIDE = np.uint64(0x9E3779B97F4A7C15)
SLOT_SEEDS = mix64(np.arange(1, SLOTS + 1, dtype=np.uint64) * STRIDE)
NO_SAMPLE = np.uint64(0)


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two uniforms in (0, 1) from the halves of scrambled uint64 values."""
    return (((x >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32,
            ((x & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) * 2.0**-32)


def draws(word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(r, ln c, b) of each word hash and slot."""
    seed = mix64(word[:, None] ^ SLOT_SEEDS)
    u, v = _halves(seed)
    r = -np.log(u * v)
    seed = mix64(seed + STRIDE)
    u, v = _halves(seed)
    log_c = np.log(-np.log(u * v))
    return r, log_c, _halves(mix64(seed + STRIDE))[0]


def samples(row: np.ndarray, word: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The sample of every row and slot as a hash (n x SLOTS); rows without words keep NO_SAMPLE.

    ``row`` is ascending; (row, word) pairs are distinct and have positive weights.
    """
    out = np.full((n, SLOTS), NO_SAMPLE)
    if not len(row):
        return out
    kinds, of = np.unique(word, return_inverse=True)
    single = np.empty((len(kinds), SLOTS))            # ln a for the weight 1, for which t is 0
    many = np.flatnonzero(np.bincount(of, weights=weight > 1, minlength=len(kinds)))
    place = np.full(len(kinds), -1)
    place[many] = np.arange(len(many))
    table = [np.empty((len(many), SLOTS)) for _ in range(3)]
    for a in range(0, len(kinds), WORDS):
        r, log_c, b = draws(kinds[a:a + WORDS])
        single[a:a + WORDS] = log_c - r * (1.0 - b)
        held = place[a:a + WORDS]
        for t, x in zip(table, (r, log_c, b), strict=True):
            t[held[held >= 0]] = x[held >= 0]
    log_weight = np.log(weight.astype(np.float64))
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    size = np.diff(np.append(first, len(row)))
    # Groups of rows with about PAIRS words; a longer row alone, in steps of PAIRS words.
    for x, y in chunks(size, PAIRS):
        for low in range(first[x], first[y - 1] + size[y - 1], PAIRS if y - x == 1 else len(row)):
            high = min(low + PAIRS, first[x] + size[x]) if y - x == 1 else first[y - 1] + size[y - 1]
            starts = np.maximum(first[x:y], low) - low
            log_a = single[of[low:high]]
            level = np.zeros(log_a.shape, np.int32)
            heavy = np.flatnonzero(weight[low:high] > 1)
            if len(heavy):
                r, log_c, b = (t[place[of[low + heavy]]] for t in table)
                t = np.floor(log_weight[low + heavy, None] / r + b)
                log_a[heavy] = log_c - r * (t - b + 1.0)
                level[heavy] = t
            least = np.minimum.reduceat(log_a, starts, axis=0)
            owner = np.repeat(np.arange(y - x), np.diff(np.append(starts, high - low)))
            at, slot = np.nonzero(log_a == least[owner])
            found = mix64(word[low:high][at] + (level[at, slot].astype(np.uint64) + np.uint64(1)) * STRIDE)
            if low == first[x]:
                best = np.full((y - x, SLOTS), np.inf)
            better = least[owner[at], slot] < best[owner[at], slot]
            out[row[first[x:y]][owner[at[better]]], slot[better]] = found[better]
            best = np.minimum(best, least)
    return out


def signatures(column: pa.Array) -> np.ndarray:
    """Sixteen bits of each sample (texts x SLOTS) of a binary array without nulls, and which texts have words."""
    row, word = word_hashes(column)
    row, word, count = bags(row, word)
    return (samples(row, word, count, len(column)) >> np.uint64(48)).astype(np.uint16), np.bincount(row, minlength=len(column)) > 0


def _written(bits: np.ndarray, some: np.ndarray) -> list[str]:
    """Fingerprints as text: four hex digits for each slot, nothing for texts without words."""
    return [row.tobytes().hex() if has else "" for row, has in zip(bits.astype(">u2"), some.tolist(), strict=True)]


def _alike(a: tuple, b: tuple) -> np.ndarray:
    """Share of equal slots of two (bits, some) of the same length."""
    share = (a[0] == b[0]).mean(axis=1)
    return np.where(a[1] & b[1], share, (~a[1] & ~b[1]).astype(np.float64))


def fingerprint(text: Column | str) -> Column:
    """Fingerprint of a text."""

    @F.arrow_udf("string")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            texts, out = text_bytes(column), []
            for a, b in chunks(np.asarray(pc.binary_length(texts)) + 1, CHUNK):
                out += _written(*signatures(texts.slice(a, b - a)))
            yield pa.array(out, pa.string())

    return made(text)


def with_fingerprint(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``; an input column of that name is replaced."""
    base = replace_columns(docs, "fingerprint")
    return docs.select(*[F.col(f"`{c}`") for c in base.columns], fingerprint(text_col).alias("fingerprint"))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Estimated similarity of two fingerprints (0 to 1)."""
    a, b = (F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit("")) for x in (a, b))
    same = F.aggregate(
        F.sequence(F.lit(0), F.lit(SLOTS - 1)), F.lit(0),
        lambda n, k: n + (F.substr(a, k * DIGITS + 1, F.lit(DIGITS)) == F.substr(b, k * DIGITS + 1, F.lit(DIGITS))).cast("int"))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(same / F.lit(float(SLOTS)))


def edited(text: str, after: str) -> str:
    """``text`` with its last third replaced by as much of the next text's beginning."""
    n = len(text) // 3
    return text[:len(text) - n] + after[:n]


RESULT = [("n_chars", "bigint"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"),
          ("near_edited", "double"), ("near_next", "double")]


def _binary(texts: list[str]) -> pa.Array:
    return pa.array([t.encode() for t in texts], pa.binary())


def _compared(texts: list[str], known: tuple | None = None) -> tuple[list[list], tuple]:
    """RESULT columns of all texts but the last, each with the one after it, and the last one's (bits, some).

    ``known``: the first text's (bits, some), if made before.
    """
    new = [edited(a, b) for a, b in zip(texts, texts[1:])]
    fresh = texts[1:] if known else texts
    bits, some = signatures(_binary(fresh + new))
    own, changed = (bits[:len(fresh)], some[:len(fresh)]), (bits[len(fresh):], some[len(fresh):])
    if known:
        own = np.concatenate((known[0], own[0])), np.concatenate((known[1], own[1]))
    here, after = (own[0][:-1], own[1][:-1]), (own[0][1:], own[1][1:])
    return [[len(t) for t in texts[:-1]], [hashlib.sha256(t.encode()).hexdigest() for t in new], _written(*here),
            _written(*changed), _alike(here, changed).tolist(), _alike(here, after).tolist()], (own[0][-1:], own[1][-1:])


def compare_with_next(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    Next is the row that follows in descending order of the key.  The rows'
    figures are written to the shared folder as one table, so that the rows at
    the ends of the tasks can be joined to it.
    """
    key_type = docs.schema[docs.select(F.col(key_col)).columns[0]].dataType if key_col in docs.columns else \
        docs.select(F.col(key_col)).schema[0].dataType
    # at: the row's place in its input split, which parts the rows of one key and text.
    rows = docs.select(F.col(key_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "mark", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    order = [F.col("key").desc_nulls_last(), F.col("mark"), F.col("at")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    schema = T.StructType([T.StructField("key", key_type), *T.StructType.fromDDL("kind int, part int, text string").fields,
                           *T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in RESULT)).fields])
    arrow = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("text", pa.string()), ("n_chars", pa.int64()),
                       ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                       ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def batch_of(key: pa.Array, kind: int, part: int, text: list[str | None], columns: list[list] | None) -> pa.RecordBatch:
        n = len(key)
        values = [[kind] * n, [part] * n, text, *(columns or [[None] * n] * len(RESULT))]
        return pa.RecordBatch.from_arrays(
            [key, *(pa.array(v, f.type) for v, f in zip(values, arrow, strict=True))], ["key", *arrow.names])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None   # key (array of one), text, (bits, some)
        for batch in batches:
            column = batch.column(1)
            for a, b in chunks(np.asarray(pc.binary_length(column)) + 1, CHUNK):
                keys, texts = batch.column(0).slice(a, b - a), column.slice(a, b - a).to_pylist()
                if last is None:
                    yield batch_of(keys.slice(0, 1), 2, part, texts[:1], None)
                else:
                    keys, texts = pa.concat_arrays([last[0], keys]), [last[1], *texts]
                found, end = _compared(texts, last and last[2])
                if len(texts) > 1:
                    yield batch_of(keys.slice(0, len(keys) - 1), 0, part, [None] * (len(texts) - 1), found)
                last = keys.slice(len(keys) - 1), texts[-1], end
        if last is not None:
            yield batch_of(last[0], 1, part, [last[1]], None)

    done = materialise(rows.mapInArrow(stream, schema), "fingerprints")
    # One number a task: the tasks in order, each with the next one that has rows; the last with the first.
    parts = done.where("kind = 2").select("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(whole)).alias("next"))
    ends = (done.where("kind = 1").select("key", "part", "text").join(follows, "part")
            .join(done.where("kind = 2").select(F.col("part").alias("next"), F.col("text").alias("after")), "next")
            .select("key", "text", "after"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (text, after) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                found, _ = _compared([text, after])
                yield batch_of(batch.column(0).slice(i, 1), 0, 0, [None], found)

    rest = ends.mapInArrow(pairs, schema)
    names = [F.col("key").alias(key_col), *[n for n, _ in RESULT]]
    return done.where("kind = 0").select(*names).unionByName(rest.select(*names))
