"""Alignment of two tokenisations of the same texts, with corpus-wide link counts.

A text is encoded by a byte-level BPE vocabulary (A, of blank + text) and by a
SentencePiece model (B, of the text; the model adds the blank).  Tokens stand for
bytes, so both give ascending arrays of end offsets over the same bytes.  Offsets
where both end cut the tokens into *groups*.

Groups are found by diagonal run skipping: with the next tokens i of A and j of
B right after a common end, the arrays are compared at the current shift j - i
over windows of 4, 8, 16, ... entries, so a stretch of one-to-one tokens is
jumped in a number of slice comparisons logarithmic in its length; the window
that differs is halved down to its first difference.  There the group is irregular
and resolved token by token: the side that lags behind moves on until both end at the same
offset.  The shift is then i and j's new difference, and probing starts again.

Two tokens are linked if their bytes overlap.  Inside a group of n and m tokens
no inner end is common, so exactly n + m - 1 pairs overlap.  Links of equal id
pairs are counted over the whole corpus.

A is the vocabulary file's byte-pair encoding.  Where its merges are its tokens in the order of their ids, which is
checked when the file is read, a text is encoded by ranks (tiktoken), which gives the same ids several times
faster; texts with characters whose class depends on the Unicode version, or with runs of a thousand characters
without or of nothing but white space, go through the file's own tokenizer.

Each text is tokenised once: its figures and its distinct id pairs with their
numbers are written to the shared folder.  Pair counts are summed per
Arrow batch before the shuffle.  Counts go back to the texts in two ways: at most ``HOT`` pairs,
by pigeonhole those with at least 1 / HOT of all links (all pairs, where there
are no more than HOT), are broadcast; the rest, of which no pair can be frequent, by a join.

A text that is null, empty, or whose joined bytes of A or of B differ from blank
+ text (a text that holds the piece mark U+2581, for one) has no tokens: its
figures are 0 and its digest is ''.  Texts of any length are encoded whole.
Repeated rows count as often as they occur; keys may be null or of any type.
Input columns named like an output column are replaced, whatever other columns the input has; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import chunks, flat_bytes, materialise, replace_columns

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
HOT = 1_000_000          # pairs whose counts are broadcast, at most (24 MB)
CHUNK = 1 << 18          # text bytes tokenised together: bounds a task's memory
SLICE = 1 << 17          # links in one piece of results
B_BITS = 24              # room for an id of B in a pair's number: a << B_BITS | b
MARK = "▁"
# Fixed value: how the byte-level pre-tokenizer of A cuts a text.
CUTS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: What only the file's own tokenizer takes: characters outside scripts that have long been settled, and long runs.
UNSETTLED = re.compile("[^\x00-\u052f\u2000-\u206f\u20a0-\u20bf\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3\U0001f300-\U0001f64f]"
                       r"|\s{1000}|\S{1000}")


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable Latin-1 stands for itself, the other
    bytes, in order, for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokens:
    """Both vocabularies, with the bytes of every id."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task uses one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in alphabet for c in token):
                self.a_bytes[i] = bytes(alphabet[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.ranks = self._ranks(a_file)
        # For digests: every id with the mark after it, "," or (last of its side in a group) "|" and ";".
        a, b = (list(map(str, range(size))) for size in (len(self.a_bytes), n))
        self.b_at = 2 * len(a)
        self.written = pa.array([x + mark for ids, marks in ((a, ",|"), (b, ",;")) for mark in marks for x in ids], pa.binary())

    def _ranks(self, a_file: str):
        """A as an encoding by ranks, if its merges are its tokens in the order of ids and its texts are cut by CUTS."""
        import tiktoken

        with open(a_file, encoding="utf-8") as fh:
            spec = json.load(fh)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and not spec.get("normalizer") and cut.get("type") == "ByteLevel" and cut.get("use_regex")
                 and not cut.get("add_prefix_space") and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix",
                                                                                       "end_of_word_suffix", "ignore_merges")))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        vocabulary = model.get("vocab", {})
        first = len(byte_alphabet())
        if not plain or any(vocabulary.get("".join(m)) != first + k for k, m in enumerate(merges)):
            return None
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {self.a_bytes[i]: i for token, i in vocabulary.items() if token not in special}
        return tiktoken.Encoding("ranks", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        if self.ranks is None:
            return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        return [self.a.encode(t, add_special_tokens=False).ids if UNSETTLED.search(t) else self.ranks.encode_ordinary(t) for t in texts]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of A and of B of each text; none of both where either does not give the text's bytes."""
        spaced = [" " + t for t in texts]
        second = self.b.encode(texts, num_threads=1) if texts else []
        for text, a, b in zip(spaced, self.encode_a(spaced), second, strict=True):
            raw = text.encode()
            same = len(raw) > 1 and b"".join([self.a_bytes[i] for i in a]) == raw and b"".join([self.b_bytes[i] for i in b]) == raw
            yield (a, b) if same else ([], [])


@lru_cache(maxsize=2)
def tokens(a_file: str, b_file: str) -> Tokens:
    return Tokens(a_file, b_file)


def groups(x: list[int], y: list[int]) -> list[tuple[int, int, int, int]]:
    """Of the groups of two ascending lists of ends with the same last one, those that are not one-to-one.

    Each as (i, i2, j, j2): the tokens i ... i2 of the first and j ... j2 of the second list.  Between them lie
    one-to-one groups alone.
    """
    uneven: list[tuple[int, int, int, int]] = []
    i = j = 0
    n = len(x)
    while i < n:
        width = 4
        while i < n and x[i:i + width] == y[j:j + width]:
            i += width
            j += width
            width += width
        if i >= n:
            break
        # The window at i differs: halve it down to the first difference.
        while width > 1:
            width >>= 1
            if x[i:i + width] == y[j:j + width]:
                i += width
                j += width
        if i >= n:
            break
        a, b = i, j
        p, q = x[i], y[j]
        while p != q:
            if p < q:
                i += 1
                p = x[i]
            else:
                j += 1
                q = y[j]
        i += 1
        j += 1
        uneven.append((a, i, b, j))
    return uneven


def _places(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges start ... end."""
    size = end - start
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def align(vocab: Tokens, a: list[int], b: list[int]) -> tuple[int, np.ndarray, np.ndarray]:
    """(number of groups, what their digest is made of, the pair numbers of all links) of one text's ids.

    The second is the row numbers in ``vocab.written`` whose texts, joined, are the groups' ids, each group ending in ``;``.
    """
    if not a:
        return 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
    x, y = np.cumsum(vocab.a_size[ids_a]), np.cumsum(vocab.b_size[ids_b])
    uneven = np.array(groups(x.tolist(), y.tolist()), np.int64).reshape(-1, 4)
    at_a, at_b = _places(uneven[:, 0], uneven[:, 1]), _places(uneven[:, 2], uneven[:, 3])
    even_a, even_b = np.ones(len(a), bool), np.ones(len(b), bool)
    even_a[at_a], even_b[at_b] = False, False
    # Inside an uneven group every stretch between two ends, of either side, is one link: of the tokens that cover it.
    cuts = np.union1d(x[at_a], y[at_b])
    first, second = at_a[np.searchsorted(x[at_a], cuts)], at_b[np.searchsorted(y[at_b], cuts)]
    pairs = np.concatenate((ids_a[even_a] << B_BITS | ids_b[even_b], ids_a[first] << B_BITS | ids_b[second]))
    # Behind a group's last token of A come its tokens of B, then those of the next group.
    even_a[uneven[:, 1] - 1], even_b[uneven[:, 3] - 1] = True, True
    end_a, end_b = np.flatnonzero(even_a) + 1, np.flatnonzero(even_b) + 1
    size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
    row = np.empty(len(a) + len(b), np.int64)
    row[np.arange(len(a)) + np.repeat(end_b - size_b, size_a)] = ids_a
    row[np.arange(len(b)) + np.repeat(end_a, size_b)] = ids_b + vocab.b_at
    row[end_a - 1 + end_b - size_b] += len(vocab.a_bytes)
    row[end_b - 1 + end_a] += len(vocab.b_bytes)
    return len(end_a), row, pairs


def digests(vocab: Tokens, rows: list[np.ndarray]) -> list[str]:
    """SHA-256 of each text's groups as text, without the last ``;``; '' for a text without tokens."""
    raw, offsets = flat_bytes(vocab.written.take(pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))))
    data = memoryview(np.ascontiguousarray(raw))
    ends = offsets[np.cumsum([len(r) for r in rows])] if rows else []
    out, start = [], 0
    for end in ends:
        out.append(hashlib.sha256(data[start:end - 1]).hexdigest() if end > start else "")
        start = end
    return out


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _aligned(rows: DataFrame, at: int, a_file: str, b_file: str) -> DataFrame:
    """``rows`` (whose text column is number ``at``) without the text, with each row's figures, distinct pairs and
    their numbers."""
    more = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<bigint>, times array<int>"
    kept = [f for k, f in enumerate(rows.schema.fields) if k != at]
    schema = T.StructType(kept + T.StructType.fromDDL(more).fields)

    def batch_of(part: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        size = np.concatenate(([0], np.cumsum([len(f[5]) for f in found]))).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(size), pa.array(np.concatenate([f[k] for f in found]), t))
                 for k, t in ((5, pa.int64()), (6, pa.int32()))]
        plain = [pa.array([f[k] for f in found], pa.int64()) for k in range(4)]
        plain.append(pa.array(digests(tokens(a_file, b_file), [f[4] for f in found]), pa.string()))
        return pa.RecordBatch.from_arrays([*(c for k, c in enumerate(part.columns) if k != at), *plain, *lists], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = tokens(a_file, b_file)
        for batch in batches:
            column = batch.column(at).fill_null("")
            for x, y in chunks(np.asarray(pc.binary_length(column)) + 1, CHUNK):
                found: list[tuple] = []
                start, total = x, 0
                for k, (a, b) in enumerate(vocab.encode(column.slice(x, y - x).to_pylist())):
                    n, row, pair = align(vocab, a, b)
                    kinds, times = np.unique(pair, return_counts=True)
                    found.append((len(a), len(b), n, len(pair), row, kinds, times))
                    total += len(kinds)
                    if total >= SLICE:
                        yield batch_of(batch.slice(start, x + k + 1 - start), found)
                        found, start, total = [], x + k + 1, 0
                if found:
                    yield batch_of(batch.slice(start, y - start), found)

    return rows.mapInArrow(run, schema)


def _pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n) of all links, summed in each batch first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, place = np.unique(batch.column(0).flatten().to_numpy(), return_inverse=True)
            n = np.bincount(place, weights=batch.column(1).flatten().to_numpy(), minlength=len(pair)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n)], ["pair", "n"])

    return rows.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def link_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): how many links hold the pair, and whether no other pair of its B id has more."""
    counts = materialise(_pair_counts(rows), "pair-counts")
    b = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return materialise(counts.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "link-counts")


def _summed(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with n_best and count_sum over their pairs in ``hot`` (a bounded table), and the pairs not in it."""
    spark = rows.sparkSession
    table = hot.toArrow()    # at most HOT rows
    order = np.argsort(np.asarray(table.column("pair")), kind="stable")
    shared = spark.sparkContext.broadcast(tuple(np.asarray(table.column(n))[order] for n in ("pair", "n", "best")))
    schema = T.StructType(rows.schema.fields + T.StructType.fromDDL(
        "n_best long, count_sum long, rare array<bigint>, rare_times array<int>").fields)
    at = [rows.columns.index(n) for n in ("pairs", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            kinds, times = (batch.column(k).flatten().to_numpy() for k in at)
            size = pc.list_value_length(batch.column(at[0])).to_numpy()
            row = np.repeat(np.arange(len(batch)), size)
            place = np.minimum(np.searchsorted(pair, kinds), max(len(pair) - 1, 0))
            known = pair[place] == kinds if len(pair) else np.zeros(len(kinds), bool)
            use, place = np.flatnonzero(known), place[known]
            sums = []
            for value in (np.where(best[place], times[use], 0), n[place] * times[use]):
                total = np.zeros(len(batch), np.int64)
                np.add.at(total, row[use], value)
                sums.append(pa.array(total))
            offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row[~known], minlength=len(batch))))).astype(np.int32))
            rare = [pa.ListArray.from_arrays(offsets, pa.array(v[~known], t)) for v, t in ((kinds, pa.int64()), (times, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums, *rare], schema.names)

    return rows.mapInArrow(run, schema)


def align_tokens(docs: DataFrame, text_col: str = "text", a_file: str = A_FILE, b_file: str = B_FILE, hot: int = HOT) -> DataFrame:
    """``docs`` without the text, with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    base = replace_columns(docs, *NAMES, text_col)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in base.columns], F.lit(0).alias("_")).alias("row"), F.col(text_col).alias("text"))
    rows = materialise(_aligned(packed, 1, a_file, b_file).withColumn("at", F.monotonically_increasing_id()), "aligned")
    counts = link_counts(rows)
    facts = counts.agg(F.count("*").alias("pairs"), F.coalesce(F.sum("n"), F.lit(0)).alias("links")).first()
    # Pairs with at least links / hot of all links are at most ``hot``.
    common = F.lit(True) if facts.pairs <= hot else F.col("n") * hot >= facts.links
    out = _summed(rows, counts.where(common))
    names = [F.col("n_best"), F.col("count_sum")]
    if facts.pairs > hot:
        out = materialise(out, "linked")
        rare = out.select("at", F.explode(F.arrays_zip("rare", "rare_times")).alias("r")).select("at", F.col("r.rare").alias("pair"), "r.rare_times")
        more = rare.join(counts.where(~common), "pair").groupBy("at").agg(
            F.sum(F.when(F.col("best"), F.col("rare_times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("n") * F.col("rare_times")).alias("more_sum"))
        out = out.join(more, "at", "left")
        names = [(F.col(n) + F.coalesce(m, F.lit(0))).alias(n) for n, m in (("n_best", "more_best"), ("count_sum", "more_sum"))]
    return out.select(*[F.col(f"row.`{c}`") for c in base.columns], "n_a", "n_b", "n_groups", "n_links", *names, "groups_sha256")
