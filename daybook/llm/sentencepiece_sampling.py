"""SentencePiece encoding by sampling, and lossless decoding.

A text is cut before every blank and around every line end; each unit spans a
lattice of vocabulary pieces, bytes standing in for characters that no piece
covers.  Forward filtering computes, for every lattice node, the summed
weight of the paths that reach it; backward sampling then walks from the end
and picks each piece with its exact posterior probability (Kudo 2018).  Piece
weights are ``exp(alpha * log p)``; the vocabularies given here are merge lists
without probabilities, so p follows Zipf's law of the piece's rank.

The random numbers are a hash of (seed, row key, place in the text, step), so a
row's segmentation depends on its key, its text and the parameters alone:
any run, partitioning or retry gives the same pieces.

Forward tables are built once for each distinct unit of a chunk of texts; the
walks of all its units advance together as array operations.

Decoding joins the pieces.  A blank is the piece mark U+2581; that character in
a text is always encoded as bytes, so decode(encode(text)) == text for every
text.  A null text gives null ids and a null decoded text, an empty one no ids
and an empty text.  Rows with equal keys and texts get equal ids; a null key
is one key like others.  Texts of any length are encoded whole.  Input columns named
like an output column are replaced.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import append_in_slices, chunks, flat_bytes, fresh, mix64, replace_columns, uniform

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SEED = 17
CHUNK = 1 << 19            # text bytes whose units share forward tables: bounds a task's memory
SLICE = 4 << 20            # text bytes in one piece of results
RANK_SHIFT = 10.0          # p(rank) is proportional to 1 / (rank + RANK_SHIFT)
MARK = "▁"
STEP, PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)  # odd strides of the random streams
HASH = 0x9E3779B97F4A7C15


class Vocabulary:
    """Pieces of a SentencePiece model as a byte trie; a blank stands for the piece mark."""

    def __init__(self, model_file: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        texts = [b""] * n
        self.byte_id = np.zeros(256, np.int32)
        trie: dict[int, int] = {}
        ends = {}
        nodes = 1
        self.longest = 1
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                texts[i] = bytes([int(piece[3:5], 16)])
                self.byte_id[texts[i][0]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                texts[i] = piece.replace(MARK, " ").encode()
                if MARK in piece[1:]:
                    continue  # spans a cut
                at = 0
                for b in texts[i]:
                    key = at << 8 | b
                    if key not in trie:
                        trie[key] = nodes
                        nodes += 1
                    at = trie[key]
                ends[at] = i
                self.longest = max(self.longest, len(texts[i]))
        self._file(trie)
        self.end = np.full(nodes, -1, np.int32)
        self.end[list(ends)] = list(ends.values())
        rank = np.minimum([max(0.0, -sp.get_score(i)) for i in range(n)], n)
        self.log_weight = -alpha * np.log(rank + RANK_SHIFT)
        self.log_weight[self.byte_id] = -alpha * np.log(n + RANK_SHIFT)  # a byte weighs like the rarest piece
        self.texts = pa.array(texts, pa.binary())

    def _file(self, trie: dict[int, int]) -> None:
        """The trie's steps as an open-addressing hash table, for array look-ups."""
        self.bits = max(20, (2 * len(trie)).bit_length())  # at most half full
        size = 1 << self.bits
        self.step_key, self.step_to = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        self.probes = 1
        for key, to in trie.items():
            slot = (key * HASH & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
            probe = 1
            while self.step_key[slot] >= 0:
                slot = (slot + 1) % size
                probe += 1
            self.step_key[slot], self.step_to[slot] = key, to
            self.probes = max(self.probes, probe)

    def _step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The trie nodes that the bytes lead to, -1 where none."""
        key = state.astype(np.int64) << 8 | byte
        slot = (key.view(np.uint64) * np.uint64(HASH) >> np.uint64(64 - self.bits)).astype(np.int64)
        to = np.where(self.step_key[slot] == key, self.step_to[slot], -1)
        open_ = np.flatnonzero((to < 0) & (self.step_key[slot] >= 0))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at = (slot[open_] + 1) & ((1 << self.bits) - 1)
            slot[open_] = at
            hit = self.step_key[at] == key[open_]
            to[open_[hit]] = self.step_to[at[hit]]
            open_ = open_[~hit & (self.step_key[at] >= 0)]
        return to

    def edges(self, raw: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lattice edges (from byte, to byte, piece) of concatenated units; limit: the end of each byte's unit."""
        starts = np.flatnonzero((raw & 0xC0) != 0x80).astype(np.int32)
        width = np.diff(np.append(starts, len(raw)))
        width_at = np.zeros(len(raw), np.int32)
        width_at[starts] = width
        covered = np.zeros(len(raw), bool)
        begin, finish, piece = [], [], []
        at, state = starts, np.zeros(len(starts), np.int32)
        for size in range(1, self.longest + 1):
            inside = at + size <= limit[at]
            at, state = at[inside], state[inside]
            state = self._step(state, raw[at + size - 1].astype(np.int32))
            alive = state >= 0
            at, state = at[alive], state[alive]
            if not len(at):
                break
            full = self.end[state] >= 0
            begin.append(at[full])
            finish.append(at[full] + size)
            piece.append(self.end[state[full]])
            covered[at[full][width_at[at[full]] == size]] = True
        bare = starts[~covered[starts]]
        count = width_at[bare]
        byte = np.repeat(bare, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        begin.append(byte)
        finish.append(byte + 1)
        piece.append(self.byte_id[raw[byte]])
        return (np.concatenate(begin).astype(np.int32), np.concatenate(finish).astype(np.int32),
                np.concatenate(piece).astype(np.int32))


@lru_cache(maxsize=2)
def vocabulary(model_file: str, alpha: float) -> Vocabulary:
    return Vocabulary(model_file, alpha)


class Lattices:
    """Forward-filtered lattices of many units: for every node, its incoming edges as a cumulative distribution.

    Node v of the lattices files its edges at ``high`` = v + cumulative share,
    so one search for v + u draws an edge of v with its posterior probability.
    """

    def __init__(self, vocab: Vocabulary, raw: np.ndarray, offsets: np.ndarray):
        offsets = offsets.astype(np.int32)
        size = np.diff(offsets)
        unit = np.repeat(np.arange(len(size), dtype=np.int32), size)  # of each byte; unit k has its size + 1 nodes from offsets[k] + k
        begin, finish, piece = vocab.edges(raw, offsets[1:][unit])
        source, target = begin + unit[begin], finish + unit[begin]
        level = finish - offsets[unit[begin]]
        order = _stable_order(target)
        source, target, piece, level = source[order], target[order], piece[order], level[order]
        self.piece, self.source = piece, source
        by_level = _stable_order(level)
        source, place, piece, level = source[by_level], target[by_level], piece[by_level], level[by_level]
        reach = np.full(len(raw) + len(size), -np.inf)
        reach[offsets[:-1] + np.arange(len(size))] = 0.0
        share = np.empty(len(piece))
        weight = vocab.log_weight[piece]
        for a, b in _runs(level):
            value = reach[source[a:b]] + weight[a:b]
            new = np.concatenate(([True], place[a + 1:b] != place[a:b - 1]))
            first = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            top = np.maximum.reduceat(value, first)
            e = np.exp(value - top[group])
            total = np.add.reduceat(e, first)
            reach[place[a:b][first]] = top + np.log(total)
            up = np.cumsum(e)
            share[a:b] = (up - (up[first] - e[first])[group]) / total[group]
            share[a + np.append(first[1:], b - a) - 1] = 1.0
        self.high = np.empty(len(share))
        self.high[by_level] = place + np.minimum(share, 1.0)
        self.start = offsets[:-1] + np.arange(len(size), dtype=np.int32)
        self.stop = offsets[1:] + np.arange(len(size), dtype=np.int32)

    def sample(self, unit: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of each occurrence of a unit, one after the other, and the n+1 offsets; key: its random stream."""
        order = _stable_order(unit)
        node, start, rng, who = self.stop[unit][order], self.start[unit][order], key[order], order
        taken, owners = [], []
        while len(node):
            u = uniform(mix64(rng))
            edge = np.searchsorted(self.high, node + u)
            taken.append(self.piece[edge])
            owners.append(who)
            node = self.source[edge]
            more = node > start
            node, start, rng, who = node[more], start[more], rng[more] + STEP, who[more]
        count = np.zeros(len(unit), np.int64)
        for who in owners:
            count[who] += 1
        offsets = np.concatenate(([0], np.cumsum(count)))
        out = np.empty(offsets[-1], np.int32)
        for k, (who, piece) in enumerate(zip(owners, taken, strict=True)):
            out[offsets[who + 1] - 1 - k] = piece
        return out, offsets


def _stable_order(values: np.ndarray) -> np.ndarray:
    """Stable sorting order of non-negative integers; two passes over 16 bits each, for which numpy counts."""
    if not len(values) or values.max() >= 1 << 32:
        return np.argsort(values, kind="stable")
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    high = (values >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal neighbouring values."""
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    edge = np.concatenate(([0], cut, [len(values)])) if len(values) else np.zeros(0, np.int64)
    return list(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True))


def encode_batch(texts: pa.Array, keys: np.ndarray, model_file: str, alpha: float, seed: int) -> pa.Array:
    """Sampled piece ids of each text (no nulls among the texts)."""
    vocab = vocabulary(model_file, alpha)
    stream = mix64(keys.astype(np.uint64) ^ mix64(np.array([seed], np.uint64)))
    parts, lengths = [], []
    texts = texts.cast(pa.binary())
    for a, b in chunks(np.asarray(pc.binary_length(texts)) + 1, CHUNK):
        # As SentencePiece does, a text starts with a blank of its own.
        part = texts.slice(a, b - a)
        part = pc.if_else(pc.equal(part, b""), part, pc.binary_join_element_wise(b" ", part, b""))
        raw, offsets = flat_bytes(part)
        line = raw == 10
        cut = (raw == 32) | line
        cut[1:] |= line[:-1]
        cut[offsets[:-1][offsets[:-1] < len(raw)]] = True
        start = np.flatnonzero(cut)
        if not len(start):
            lengths.append(np.zeros(b - a, np.int64))
            continue
        row = np.searchsorted(offsets, start, "right") - 1
        bounds = pa.array(np.append(start, len(raw)).astype(np.int32))
        units = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, bounds.buffers()[1], pa.py_buffer(raw)])
        coded = units.dictionary_encode()
        lattices = Lattices(vocab, *flat_bytes(coded.dictionary))
        place = np.arange(len(start)) - np.searchsorted(row, row)  # the unit's place in its text
        key = mix64(stream[a:b][row] + place.astype(np.uint64) * PLACE)
        ids, at = lattices.sample(coded.indices.to_numpy(), key)
        parts.append(ids)
        lengths.append(np.bincount(row, weights=np.diff(at), minlength=b - a).astype(np.int64))
    total = np.concatenate([[0], np.cumsum(np.concatenate(lengths) if lengths else [])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(total), pa.array(np.concatenate(parts) if parts else [], pa.int32()))


def decode_batch(ids: pa.Array, model_file: str) -> pa.Array:
    """Texts of lists of piece ids; nulls stay null."""
    vocab = vocabulary(model_file, ALPHA)
    flat = ids.flatten()
    joined = pc.binary_join(pa.ListArray.from_arrays(_offsets(ids), vocab.texts.take(flat)), b"")
    # The blank that every text starts with.
    plain = pc.binary_replace_slice(joined, 0, 1, b"")
    return pc.if_else(ids.is_valid(), plain.cast(pa.string()), pa.scalar(None, pa.string()))


def _offsets(lists: pa.Array) -> pa.Array:
    length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32))


def _keyed(df: DataFrame, key_col: str, text_col: str) -> tuple[DataFrame, int]:
    """``df`` with the hash of its key as the last column, and the place of its text column."""
    return df.select("*", F.xxhash64(key_col).alias(fresh(df, "_stream"))), [c.lower() for c in df.columns].index(text_col.lower())


def _encoded(df: DataFrame, key_col: str, text_col: str, model_file: str, alpha: float, seed: int, both: bool) -> DataFrame:
    base = replace_columns(df, "piece_ids", *["decoded"] * both)
    rows, at = _keyed(base, key_col, text_col)

    def make(part: pa.RecordBatch) -> list[pa.Array]:
        texts = part.column(at)
        ids = encode_batch(texts.fill_null(""), part.column(part.num_columns - 1).to_numpy(), model_file, alpha, seed)
        ids = pc.if_else(texts.is_valid(), ids, pa.scalar(None, ids.type))
        return [ids, decode_batch(ids, model_file)] if both else [ids]

    def size_of(batch: pa.RecordBatch) -> np.ndarray:
        return np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0)) + 1

    fields = "piece_ids array<int>" + ", decoded string" * both
    return append_in_slices(rows, size_of, make, fields, SLICE).drop(rows.columns[-1])


def encode(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL,
           alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """``df`` with ``piece_ids``: a sampled segmentation of the text, the same at every run."""
    return _encoded(df, key_col, text_col, model_file, alpha, seed, False)


def decode(df: DataFrame, ids_col: str = "piece_ids", model_file: str = MODEL) -> DataFrame:
    """``df`` with ``decoded``: the text of its piece ids."""
    base = replace_columns(df, "decoded")
    at = [c.lower() for c in base.columns].index(ids_col.lower())

    def size_of(batch: pa.RecordBatch) -> np.ndarray:
        return np.asarray(pc.fill_null(pc.list_value_length(batch.column(at)), 0)) * 4 + 1

    return append_in_slices(base, size_of, lambda part: [decode_batch(part.column(at), model_file)], "decoded string", SLICE)


def encode_decode(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL,
                  alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """``df`` with ``piece_ids`` and ``decoded`` in one pass through the Python workers."""
    return _encoded(df, key_col, text_col, model_file, alpha, seed, True)
