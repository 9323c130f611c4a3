"""Benchmark decontamination with a generalised suffix automaton.

The test items, as word sequences, go into one generalised suffix automaton.
Every training text is streamed through it word by word; the automaton state
gives the length of the longest suffix of the text read so far that occurs in
any item.  A word is *hit* when it lies inside an occurrence of a window: ten
consecutive item words, or the whole item if it has fewer (but some).

The automaton is broadcast.  Its size is bounded: repeated item rows are one,
long items are cut into pieces that overlap by all but one word of a window (so
each window lies in a piece), and the pieces are dealt by hash into shards of
about ``shard_words`` words, twice that at most, one automaton each.  The texts
pass the shards one after the other (written to the shared folder in between),
so a test set of any size is matched whole with bounded memory per task.

Null texts have no words.  Items without words match nothing; an item with a
null id still hits words but is not listed.  Rows with equal ids are treated
one by one, empty tables give empty results, and input columns named like an
output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import fresh, materialise, replace_columns, text_bytes, words_of

WINDOW = 10
SHARD_WORDS = 100_000
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

HITS = "struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<first:int,last:int>>,cleaned:string>"
SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32())])


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, with what is needed to find windows.

    ``reach[v]`` is the state holding the window-long suffix of the longest
    strings of ``v`` (or 0), ``owners`` lists the items that contain that
    window, and ``short[v]`` the lengths of whole short items that are suffixes
    of ``v``'s strings, longest first.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        sequences = [(name, words) for name, words in items if words]
        for _, words in sequences:
            state = 0
            for w in words:
                state = self._extend(state, w)
        self._mark(sequences)

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        known = nxt[last].get(w)
        if known is not None and length[known] == length[last] + 1:
            return known
        if known is not None:
            return self._split(last, w, known)
        made = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = made
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[made] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return made

    def _split(self, p: int, w: bytes, q: int) -> int:
        """A state for the strings of ``q`` that are no longer than those of ``p`` plus one word."""
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _mark(self, sequences: list[tuple[str | None, list[bytes]]]) -> None:
        n, k = len(self.next), self.window
        by_length = sorted(range(1, n), key=self.length.__getitem__)
        self.reach = [0] * n
        for v in by_length:
            up = self.link[v]
            self.reach[v] = self.reach[up] if self.length[up] >= k else v if self.length[v] >= k else 0
        owners: dict[int, set[str | None]] = {}
        whole: dict[int, dict[int, set[str | None]]] = {}
        for name, words in sequences:
            v = 0
            for w in words:
                v = self.next[v][w]
                if self.reach[v]:
                    owners.setdefault(self.reach[v], set()).add(name)
            if len(words) < k:
                whole.setdefault(v, {}).setdefault(len(words), set()).add(name)
        self.owners = {v: frozenset(names) for v, names in owners.items()}
        self.short: list[tuple[tuple[int, frozenset[str | None]], ...]] = [()] * n
        for v in by_length:
            own = tuple(sorted(((m, frozenset(x)) for m, x in whole.get(v, {}).items()), reverse=True))
            self.short[v] = own + self.short[self.link[v]] if own else self.short[self.link[v]]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs of hit words as (first, last + 1), and the ids of items with an occurring window."""
        nxt, link, length, reach, short, k = self.next, self.link, self.length, self.reach, self.short, self.window
        spans: list[tuple[int, int]] = []
        found: set[str | None] = set()
        state = matched = 0

        def hit(first: int, last: int) -> None:
            while spans and spans[-1][1] >= first:
                before = spans.pop()
                first, last = min(first, before[0]), max(last, before[1])
            spans.append((first, last))

        for i, w in enumerate(words):
            to = nxt[state].get(w)
            if to is None:
                while to is None and state:
                    state = link[state]
                    matched = length[state]
                    to = nxt[state].get(w)
                if to is None:
                    continue
            state = to
            matched += 1
            if matched >= k:
                hit(i + 1 - matched, i + 1)
                found |= self.owners.get(reach[state], frozenset())
            if short[state]:
                for m, names in short[state]:
                    if m <= matched:
                        hit(i + 1 - m, i + 1)
                        found |= names
        found.discard(None)
        return spans, found


def _without(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    at = [m.span() for m in WORD.finditer(text)]
    kept, done = [], 0
    for first, last in spans:
        kept.append(text[done:at[first][0]])
        done = at[last - 1][1]
    return b"".join([*kept, text[done:]]).decode("utf-8")


def _tracker(automaton: Broadcast, min_words: int, max_share: float):
    """Arrow UDF: (text, spans and items so far) to the hits, spans merged and the text without long spans."""

    @F.arrow_udf(HITS)
    def track(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sam = automaton.value
        for texts, spans_before, items_before in batches:
            out = []
            for text, spans0, items0 in zip(text_bytes(texts).to_pylist(), spans_before.to_pylist(),
                                            items_before.to_pylist(), strict=True):
                words = words_of(text)
                spans, items = sam.hits(words)
                items |= set(items0 or ())
                if spans0:
                    spans = _union([*spans, *((s["first"], s["last"]) for s in spans0)])
                n_hit = sum(b - a for a, b in spans)
                cut = [s for s in spans if s[1] - s[0] >= min_words]
                cleaned = None
                if n_hit > max_share * len(words):
                    cleaned = ""
                elif cut:
                    cleaned = _without(text, cut)
                out.append({"n_words": len(words), "n_hit": n_hit, "items": sorted(items),
                            "spans": [{"first": a, "last": b} for a, b in spans], "cleaned": cleaned})
            yield pa.array(out, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                                           ("items", pa.list_(pa.string())), ("spans", pa.list_(SPAN)),
                                           ("cleaned", pa.string())]))

    return track


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pieces(items: DataFrame, window: int, size: int) -> DataFrame:
    """(item_id, text, n): distinct items of n words; those of more than ``size`` words in pieces that hold every window."""
    word = "'[0-9A-Za-z\\\\x{80}-\\\\x{10FFFF}]+'"
    step = size - window + 1
    cut = F.expr(f"""
        CASE WHEN regexp_count(text, {word}) <= {size} THEN array(text)
        ELSE flatten(transform(array(regexp_extract_all(text, {word}, 0)),
            w -> transform(sequence(0, CAST((size(w) - {window}) DIV {step} AS INT)),
                i -> array_join(slice(w, i * {step} + 1, {size}), ' ')))) END""")
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text")).where("text IS NOT NULL")
    return rows.select("item_id", F.explode(cut).alias("text")).distinct().withColumn("n", F.expr(f"regexp_count(text, {word})"))


def track_overlap(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW,
                  min_words: int = 1, max_share: float = 1.0, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids, sorted), spans (runs of hit words) and cleaned.

    ``cleaned`` is the text without its spans of at least ``min_words`` words,
    empty if more than ``max_share`` of the words are hit, and null where
    nothing is to be removed.
    """
    spark = docs.sparkSession
    size = max(shard_words // 8, 2 * window)
    items = materialise(_pieces(items, window, size), "items")

    def dealt(shards: int) -> Column:
        return F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))

    total = items.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    # Pieces are small against a shard, so this hardly ever takes more than one look.
    while shards > 1 and items.groupBy(dealt(shards)).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] > 2 * max(shard_words, size):
        shards += -(-shards // 4)
    shard = dealt(shards)
    out = replace_columns(docs, "n_words", "n_hit", "items", "spans", "cleaned")
    keep = [F.col(f"`{c}`") for c in out.columns]
    hits = fresh(out, "_hits")
    spans, listed = F.lit(None).cast("array<struct<first:int,last:int>>"), F.lit(None).cast("array<string>")
    for s in range(shards):
        # Bounded: one shard holds about shard_words words, and not more than twice that.
        rows = items.where(shard == s).collect()
        sam = SuffixAutomaton([(r.item_id, words_of(r.text.encode())) for r in rows], window)
        track = _tracker(spark.sparkContext.broadcast(sam), min_words, max_share)
        out = out.select(*keep, track(F.col(text_col), spans, listed).alias(hits)).select(*keep, f"{hits}.*")
        spans, listed = F.col("spans"), F.col("items")
        if s < shards - 1:
            out = materialise(out, "decontaminate")
    return out


def remove_contamination(docs: DataFrame, items: DataFrame, max_share: float = 0.5, window: int = WINDOW,
                         shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` without benchmark passages, in the same columns.

    Length limit: every run of hit words goes from the text (a run has at least
    ``window`` words, or is a whole shorter item).  Coverage limit: a document
    of which more than ``max_share`` of the words are hit goes whole.  Others
    stay as they are.  ``n_chars``, where there is one, follows the text.
    """
    # The operator's own columns get names of their own here, so a clash loses nothing.
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))
    hits = track_overlap(kept, items, "_text", window, 1, 1.0, shard_words)
    hits = hits.where((F.col("n_words") == 0) | (F.col("n_hit") <= max_share * F.col("n_words")))
    text = F.coalesce("cleaned", "_text")
    new = {"text": text, "n_chars": F.when(F.col("cleaned").isNull(), F.col("_row.n_chars"))
           .otherwise(F.char_length("cleaned")) if "n_chars" in docs.columns else None}
    return hits.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if new.get(c) is not None
                         else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
