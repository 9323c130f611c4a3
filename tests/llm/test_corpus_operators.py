"""Operators that look at the whole table: neighbours, near-duplicates, contamination, repeats, classifiers, the pipeline."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOC_SCHEMA, docs, empty_docs, hard_docs, prose
from pyspark.sql import functions as F

from daybook.llm import ann, bagminhash, common, decontaminate, graph, quality, suffix_dedup, toxicity
from daybook.llm.common import words_of

# --- nearest neighbours ------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def nearest(x, ids, i, k):
    s = x @ x[i]
    order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]]
    return [(int(ids[j]), float(s[j])) for j in order[:k]]


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 24)).astype(np.float32) * rng.uniform(0.5, 2, (3000, 1)).astype(np.float32)
    ids = np.arange(3000) * 3
    df = vectors(spark, [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)])
    out = ann.search(df, F.col("vec_id") % 50 == 0, k=10).collect()
    exact = x.astype(float)
    got: dict[int, list] = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        want = nearest(exact, ids, i, 10)
        mine = got[int(ids[i])]
        assert [r.rank for r in mine] == list(range(1, 11))
        assert all(a.score > b.score or a.score == b.score and a.vec_id < b.vec_id for a, b in zip(mine, mine[1:]))
        for r in mine:
            assert r.score == pytest.approx(float(exact[r.vec_id // 3] @ exact[i]), rel=1e-12)
        hits += len({v for v, _ in want} & {r.vec_id for r in mine})
        total += len(want)
    assert hits / total >= 0.9


def test_scan_keeps_the_nearest():
    rng = np.random.default_rng(2)
    x, q = rng.standard_normal((5000, 33)), rng.standard_normal((20, 33))
    kept = ann.scan_block(q, x, np.full(20, np.inf), 10)
    lost = sum(len(set(np.argsort(((x - a) ** 2).sum(1))[:10]) - set(k.tolist())) for a, k in zip(q, kept, strict=True))
    assert lost <= 10 and max(map(len, kept)) < 1000


def test_equal_vectors_ties_and_unusable_rows(spark):
    same = [1.0, 0.0]
    rows = ([(i, same, 0) for i in range(40)] + [(100, [0.5, 0.0], 0), (101, [0.5, 0.0], 0), (102, None, 0), (103, [0.0, 0.0], 0),
            (104, [float("nan"), 1.0], 0), (105, [1.0, None], 0), (106, [float("inf"), 1.0], 0), (107, [1.0], 0), (None, same, 0),
            (0, same, 0)])
    out = ann.search(vectors(spark, rows), F.col("vec_id") % 50 == 0, k=5, probed=1.0).collect()
    by = {q: [(r.rank, r.vec_id, r.score) for r in sorted(out, key=lambda r: r.rank) if r.query_id == q] for q in (0, 100)}
    assert by[0] == [(k, k, 1.0) for k in range(1, 6)]
    assert by[100] == [(k + 1, k, 0.5) for k in range(5)]
    assert {r.query_id for r in out} == {0, 100}
    few = ann.search(vectors(spark, [(0, same, 0), (1, [0.5, 0.5], 1)]), F.col("vec_id") == 0).collect()
    assert [(r.rank, r.vec_id, r.score) for r in few] == [(1, 1, 0.5)]
    assert ann.search(vectors(spark, []), F.col("vec_id") == 0).collect() == []
    assert ann.search(vectors(spark, [(0, None, 0)]), F.col("vec_id") == 0).collect() == []


def test_repeated_rows_and_ids_count_once(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 12)).astype(np.float32)
    ids = np.arange(400)
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)]
    want = {int(i): nearest(x.astype(float), ids, i, 20) for i in range(0, 400, 50)}

    def found(rows):
        got: dict[int, list] = {}
        for r in sorted(ann.search(vectors(spark, rows), F.col("vec_id") % 50 == 0, probed=1.0).collect(), key=lambda r: r.rank):
            got.setdefault(r.query_id, []).append(r.vec_id)
        return got

    assert found(rows * 2) == {q: [v for v, _ in near] for q, near in want.items()}
    assert found(rows + rows[7:8] * 5000) == {q: [v for v, _ in near] for q, near in want.items()}
    # An id with sixty vectors next to a query's best direction is one neighbour, not sixty.
    many = [(7, (x[0] * (3 + k / 100)).tolist(), 0) for k in range(60)]
    got = found(rows + many)
    assert got[0] == [7, *[v for v, _ in want[0] if v != 7]][:20]


# --- near duplicates ---------------------------------------------------------------------------

def bag(text):
    w = text.lower().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    x, y = bag(a), bag(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(3)
    base = prose(300, 5).split()
    texts = []
    for edits in (0, 3, 8, 15, 30):
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(len(words))] = "edited" + str(rng.random())
        texts.append(" ".join(words * 2))          # multisets: most shingles twice
    column = pa.array([t.encode() for t in texts], pa.binary())
    row, shingle = bagminhash.shingles(column)
    assert Counter(row.tolist()) == {i: sum(bag(t).values()) for i, t in enumerate(texts)}
    sig = bagminhash.signatures(*bagminhash.bags(row, shingle), len(texts))
    for i, t in enumerate(texts):
        s = similarity(texts[0], t)
        assert abs((sig[0] == sig[i]).mean() - s) < 4.5 * np.sqrt(0.25 / bagminhash.SLOTS)
    heavy = bagminhash.signatures(np.array([0, 1]), np.array([7, 7], np.uint64), np.array([100_000, 50_000]), 2)
    assert abs((heavy[0] == heavy[1]).mean() - 0.5) < 0.2


def test_classes_against_brute_force(spark):
    rng = random.Random(4)
    texts = []
    for g in range(12):
        base = prose(rng.choice([6, 40, 120]), 100 + g).split()
        for _ in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = f"w{rng.random()}"
            texts.append(" ".join(words))
    texts += ["", "  ", "one two", "one two", "One  two", None, None]
    rng.shuffle(texts)
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            if a is not None and b is not None and (a == b or similarity(a, b) >= 0.8 and bag(a)):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    sizes = Counter(root(i) for i in range(len(texts)))
    out = bagminhash.near_duplicates(docs(spark, texts)).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in out} == {i: (root(i), sizes[root(i)]) for i in range(len(texts))}
    kept = bagminhash.deduplicate(docs(spark, texts))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(sizes)


def test_a_large_group_makes_few_pairs(spark, monkeypatch):
    """A thousand near copies and copies: comparisons grow with the group, not with its square."""
    base = prose(100, 9).split()
    texts = [" ".join([*base, f"tail{i}"]) for i in range(600)] + [" ".join(base)] * 600
    pairs = []
    real = bagminhash._verified
    monkeypatch.setattr(bagminhash, "_verified", lambda p, t, s: (pairs.append(p.count()), real(p, t, s))[-1])
    out = bagminhash.near_duplicates(docs(spark, texts))
    assert {r.class_size for r in out.select("class_size").distinct().collect()} == {1200}
    assert sum(pairs) < 601 * bagminhash.BANDS


def test_a_group_around_the_limit_meets_in_blocks(spark, monkeypatch):
    """Near copies similar by a little more or less than 0.8: no link is lost, and texts move by blocks, not by pairs."""
    rng = random.Random(11)
    base = prose(110, 31).split()
    texts = []
    for _ in range(160):
        words = list(base)
        for _ in range(rng.choice([1, 2, 2])):
            at = rng.randrange(0, 100, 5)
            words[at:at + 3] = [f"edit{rng.randrange(3)}"] * rng.randint(1, 5)
        texts.append(" ".join(words))
    texts = sorted(set(texts)) + [prose(60, 500 + k) for k in range(20)]
    close = [(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts[:i]) if similarity(a, b) >= 0.8]
    comp = list(range(len(texts)))
    for i, j in close:
        comp = [min(comp[i], comp[j]) if c in (comp[i], comp[j]) else c for c in comp]
    assert 25 < len(set(comp)) < len(texts) - 20  # some are linked, some are not
    pairs, moved = [], []
    real, block_pairs = bagminhash._verified, bagminhash._block_pairs
    monkeypatch.setattr(bagminhash, "_verified", lambda p, t, s: (pairs.append(p.count()), real(p, t, s))[-1])
    monkeypatch.setattr(bagminhash, "_block_pairs", lambda placed: (
        moved.append((block_pairs(placed).count(), placed.select("block").distinct().count())), block_pairs(placed))[-1])
    monkeypatch.setattr(bagminhash, "BLOCK", 16_000)
    out = bagminhash.near_duplicates(docs(spark, texts)).collect()
    assert {r.doc_id: r.class_id for r in out} == dict(enumerate(comp))
    assert sum(pairs) <= 3 * len(texts)
    [(rows, blocks)] = moved
    assert blocks > 3 and rows <= len(texts) * blocks


def test_the_overlap_bound_keeps_exact_ties(spark):
    """28 shingles inside 35: similarity 0.8, and the overlap equals the bound, 4/9 of 63."""
    words = prose(39, 21).split()
    texts = [(1, " ".join(words[:32])), (2, " ".join(words)), (3, prose(50, 22))]
    assert similarity(texts[0][1], texts[1][1]) == 0.8
    frame = spark.createDataFrame(texts, "node long, text string")
    members = spark.createDataFrame([(9, n, n) for n, _ in texts], "band long, node long, comp long")
    pairs = bagminhash._possible(members, frame, 0.8).select("a", "b")
    assert [tuple(r) for r in pairs.collect()] == [(1, 2)]
    assert [tuple(r) for r in bagminhash._verified(pairs, frame, 0.8).collect()] == [(1, 2)]


def test_near_duplicate_cases(spark):
    hard = hard_docs(spark).withColumn("class_id", F.lit("old")).withColumn("node", F.lit(1))
    out = bagminhash.near_duplicates(hard).collect()
    assert len(out) == 9 and sorted(r.class_size for r in out) == [1] * 7 + [2, 2]
    kept = bagminhash.deduplicate(hard)
    assert kept.columns == hard.columns and kept.count() == 8
    assert bagminhash.near_duplicates(empty_docs(spark)).count() == 0 == bagminhash.deduplicate(empty_docs(spark)).count()
    repeated = docs(spark, ["same text in both of the rows"] * 2).withColumn("doc_id", F.lit(None).cast("long"))
    assert bagminhash.deduplicate(repeated).count() == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 150), (7, 7)]
    got = {r.node: r.comp for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 150: 100, 200: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- contamination -----------------------------------------------------------------------------

def brute_hits(text, items, k=10):
    w = words_of((text or "").encode())
    hit, found = set(), set()
    for name, item in items:
        v = words_of((item or "").encode())
        n = min(k, len(v))
        windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1 if v else 0):
            if tuple(w[i:i + n]) in windows:
                hit.update(range(i, i + n))
                if name is not None:
                    found.add(str(name))
    return len(w), len(hit), found


def overlap_case():
    rng = random.Random(6)
    small = [f"w{i}" for i in range(6)]           # few words: many partial and repeated matches
    items = [(i, " ".join(rng.choices(small, k=rng.choice([3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(50, prose(30, 7)), (51, "Ärger, über!"), (52, ""), (53, None), (None, prose(12, 8)), (50, prose(15, 10)), (54, prose(30, 7))]
    texts = [" ".join(rng.choices(small, k=200)) for _ in range(20)]
    texts += [prose(40, 11) + ". " + prose(30, 7).upper() + "! " + prose(5, 12), prose(30, 7)[5:], "ärger über", "ÄRGER über", "Ärger   über?",
              prose(12, 8), "", None, prose(9, 7)]
    return texts, items


@pytest.mark.parametrize("shard_words", [100_000, 40])
def test_hits_against_brute_force(spark, shard_words):
    texts, items = overlap_case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.track_overlap(docs(spark, texts), bench, shard_words=shard_words).collect()
    assert len(out) == len(texts)
    for r in out:
        assert (r.n_words, r.n_hit, set(r["items"])) == brute_hits(r.text, items), r.text
        assert r.n_hit == sum(s["last"] - s["first"] for s in r.spans)


def test_shards_stay_bounded(spark, monkeypatch):
    """A row repeated many times counts once, and a long item is dealt in pieces that hold all its windows."""
    items = [(1, prose(12, 61))] * 200 + [(2, prose(500, 62)), (3, prose(9, 63))]
    texts = [prose(500, 62), prose(12, 61), "so " + prose(9, 63) + " on", *(" ".join(prose(500, 62).split()[i:i + 10]) for i in range(0, 491, 35)),
             " ".join(prose(500, 62).split()[100:109])]
    sizes = []
    real = decontaminate.SuffixAutomaton.__init__

    def counted(self, rows, window):
        sizes.append(sum(len(w) for _, w in rows))
        real(self, rows, window)

    monkeypatch.setattr(decontaminate.SuffixAutomaton, "__init__", counted)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for r in decontaminate.track_overlap(docs(spark, texts), bench, shard_words=240).collect():
        assert (r.n_words, r.n_hit, set(r["items"])) == brute_hits(r.text, items), r.text
    assert len(sizes) < 8 and max(sizes) <= 480


def test_passages_are_removed(spark):
    _, items = overlap_case()
    bench = spark.createDataFrame(items[12:], "item_id long, text string")
    clean, dirty = prose(60, 20), prose(40, 21) + "; " + prose(30, 7) + " – " + prose(40, 22)
    table = docs(spark, [clean, dirty, prose(30, 7), None, ""]).withColumn("spans", F.lit("old")).withColumn("n_hit", F.lit(9))
    out = decontaminate.remove_contamination(table, bench)
    assert out.columns == table.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert set(rows) == {0, 1, 3, 4} and rows[0].text == clean and rows[3].text is None
    assert rows[1].text.split() == (prose(40, 21) + ";  – " + prose(40, 22)).split()
    assert rows[1].n_chars == len(rows[1].text) and rows[1].spans == "old"
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.track_overlap(hard_docs(spark), nothing).where("n_hit > 0").count() == 0
    assert decontaminate.track_overlap(empty_docs(spark), bench).count() == 0


# --- repeats -----------------------------------------------------------------------------------

def brute_repeats(texts, n=400):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - n + 1):
            if seen[d[i:i + n]] > 1:
                gone[i:i + n] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def repeat_texts():
    passage, other = prose(90, 30), prose(120, 31)
    rng = random.Random(5)
    texts = [prose(rng.randint(5, 80), 40 + i) + " " + passage + " " + prose(rng.randint(5, 80), 70 + i) for i in range(25)]
    texts += [other, other + " end", "a" * 1500, "ab" * 400, passage[:399], passage[:400], passage[:401], "", None, "короткий",
              prose(60, 99) + other[100:520] + prose(60, 98) + other[100:520], prose(70, 97), prose(70, 97), prose(20, 96), prose(20, 96)]
    return texts


@pytest.mark.parametrize("group", [1024, 3])
def test_repeats_against_brute_force(spark, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    texts = repeat_texts()
    out = suffix_dedup.remove_repeats(docs(spark, texts).withColumn("n_spans", F.lit("old"))).orderBy("doc_id").collect()
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in out]
    assert got == brute_repeats(texts)


@pytest.mark.parametrize("group", [1024, 3])
def test_first_copies_stay_on_request(spark, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    texts, n = repeat_texts(), 400
    order = sorted({(t or "").encode() for t in texts}, key=lambda d: hashlib.md5(d).digest())
    seen: set[bytes] = set()
    kept = {}
    for d in order:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - n + 1):
            if d[i:i + n] in seen:
                gone[i:i + n] = True
            seen.add(d[i:i + n])
        kept[d] = bytes(np.frombuffer(d, np.uint8)[~gone])
    out = suffix_dedup.remove_repeats(docs(spark, texts), keep_first=True).collect()
    first: dict[bytes, int] = {}
    for i, t in enumerate(texts):
        first.setdefault((t or "").encode(), i)
    for r in out:
        d = (r.text or "").encode()
        assert bytes(r.kept) == (kept[d] if first[d] == r.doc_id or len(d) < n else b"")


def test_suffix_order_finds_earlier_and_later_copies():
    data = np.frombuffer((prose(100, 1) + prose(80, 2) + prose(100, 1)).encode(), np.uint8)
    starts = np.arange(len(data) - 399)
    earlier, later = suffix_dedup.suffix_runs(data, starts)
    text = data.tobytes()
    first = {text[s:s + 400]: s for s in starts[::-1]}
    last = {text[s:s + 400]: s for s in starts}
    assert earlier.tolist() == [first[text[s:s + 400]] < s for s in starts]
    assert later.tolist() == [last[text[s:s + 400]] > s for s in starts]


def plain_factors(raw: bytes, starts: list[int], n: int) -> list[int]:
    """The longest factor of at most n bytes that each start shares with an earlier one."""
    def common(a, b):
        k = 0
        while k < n and raw[a + k] == raw[b + k]:
            k += 1
        return k

    return [max((common(p, q) for q in starts[:i]), default=0) for i, p in enumerate(starts)]


def test_longest_previous_factors_against_brute_force():
    rng, n = np.random.default_rng(1), suffix_dedup.LENGTH
    for turn in range(10):
        base = rng.integers(97, 100, rng.integers(n + 50, n + 250)).astype(np.uint8)
        parts = [base[:int(rng.integers(n, len(base)))] if rng.random() < 0.6 else rng.integers(97, 99, int(rng.integers(n, n + 150))).astype(np.uint8)
                 for _ in range(3)] if turn else [np.full(n + 60, 97, np.uint8)] * 2
        raw, starts, at = np.concatenate(parts), [], 0
        for part in parts:
            starts += range(at, at + len(part) - n + 1)
            at += len(part)
        order, common = suffix_dedup.suffix_order(raw, np.array(starts))
        assert suffix_dedup.longest_factors(order, common).tolist() == plain_factors(raw.tobytes(), starts, n)


def test_hot_keys_are_joined_where_their_rows_are(spark, monkeypatch):
    rng = random.Random(3)
    keys = ["hot"] * 500 + [f"k{rng.randrange(60)}" for _ in range(300)]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    facts = rows.groupBy("k").agg(F.count("*").alias("n_rows"), F.min("i").alias("first")).where("n_rows > 1")
    want = sorted(map(tuple, rows.join(facts, "k").collect()))
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    monkeypatch.setattr(common, "HOT_KEYS", 10)
    for limit in (20, 10_000):
        monkeypatch.setattr(common, "HOT_ROWS", limit)
        assert sorted(map(tuple, common.join_counted(rows, facts, "k").collect())) == want


def test_repeat_cases(spark):
    out = suffix_dedup.remove_repeats(hard_docs(spark)).collect()
    assert len(out) == 9 and sum(r.n_removed > 0 for r in out) == (2 if len(prose(50, 3)) >= 400 else 0)
    assert suffix_dedup.remove_repeats(empty_docs(spark)).count() == 0


# --- classifiers -------------------------------------------------------------------------------

def labelled(spark, n=240):
    """Every fourth text is a table of bars, every fifth holds words that no other text has."""
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(n):
        words = prose(rng.randint(20, 90), 1000 + i).split()
        bad, toxic = i % 4 == 0, i % 5 == 1
        if bad:
            words = [w for x in words for w in (x, "|")]
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = rng.sample(["vile", "rotten", "foul", "nasty"], 3)
        texts.append(" ".join(words))
        labels.append((i, 0 if bad else 1, 1 if toxic else 0))
    return docs(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module,column", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy(spark, module, column):
    table, labels = labelled(spark)
    model = module.fit(table, labels, lambda c: c % 3 != 1)
    out = module.score(table.withColumn("score", F.lit("old")), model).join(labels, "doc_id").where("doc_id % 3 = 1").collect()
    assert np.mean([(r.score >= 0.5) == (r[column] == 1) for r in out]) >= 0.95
    assert all(0 <= r.score <= 1 for r in out)


@pytest.mark.parametrize("module,column", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_cases(spark, module, column):
    table, labels = labelled(spark, 60)
    strange = labels.unionByName(labels.limit(5)).unionByName(
        spark.createDataFrame([(None, 1, 0), (3, None, None), (9999, 1, 1)], "doc_id long, quality int, toxic int"))
    scores = module.score(hard_docs(spark), module.fit(table, strange)).collect()
    assert len(scores) == 9 and all(0 <= r.score <= 1 for r in scores)
    assert module.score(empty_docs(spark), module.fit(table, labels)).count() == 0
    for few in (labels.where("false"), labels.where(f"{column} = 1")):
        model = module.fit(table, few)
        assert len({r.score for r in module.score(table, model).where("length(text) > 0").collect()}) == 1
    assert module.score(table, module.fit(empty_docs(spark), labels)).count() == 60


def test_text_ids_and_clashing_names(spark):
    table, labels = labelled(spark, 60)
    named = [df.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id"))) for df in (table, labels)]
    for module in (quality, toxicity):
        model = module.fit(*named)
        rows = module.score(named[0].withColumn("_s", F.lit("mine")).withColumn("_row", F.lit(2)), model).collect()
        assert len(rows) == 60 and all(r["_s"] == "mine" and r["_row"] == 2 for r in rows)
        numbers = {f"d{r.doc_id}": r.score for r in module.score(table, module.fit(table, labels)).collect()}
        assert np.allclose([r.score for r in rows], [numbers[r.doc_id] for r in rows], atol=0.2)
    items = spark.createDataFrame([(1, prose(12, 4))], "item_id long, text string")
    row = decontaminate.track_overlap(docs(spark, [prose(12, 4)]).withColumn("_hits", F.lit("mine")), items).first()
    assert row["_hits"] == "mine" and row.n_hit == 12


def test_votes_are_exact_cosines():
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    known, asked = unit(rng.standard_normal((50, 8))), unit(rng.standard_normal((7, 8)))
    y = rng.integers(0, 2, 50)
    model = quality.QualityModel(np.zeros(1), np.zeros((1, 8)), known, y, 5)
    for v, got in zip(asked, quality.vote(asked, model), strict=True):
        s = known @ v
        near = np.argsort(-s)[:5]
        votes = [sum(max(s[j], 0) ** quality.SHARPNESS + 1e-12 for j in near if y[j] == c) / (y == c).mean() for c in (0, 1)]
        assert got == pytest.approx(votes[1] / sum(votes))


def test_maximal_segments_against_brute_force():
    """Every segment found is maximal: recursively, the best interval, then those on both sides of it."""
    rng = np.random.default_rng(6)

    def best(w, lo, hi):
        top = max(((w[a:b].sum(), -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=None)
        if top is None or top[0] <= 0:
            return []
        a, b = top[3], top[4]
        return [*best(w, lo, a), (a, b, float(top[0])), *best(w, b, hi)]

    for _ in range(100):
        w = rng.integers(-3, 4, rng.integers(1, 14)).astype(float) + rng.uniform(0, 0.01)
        got = toxicity.maximal_segments(w)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in best(w, 0, len(w))]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in best(w, 0, len(w))])


# --- pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages(spark, workdir):
    import corpus_pipeline

    table, labels = labelled(spark)
    item = prose(30, 7)
    extra = docs(spark, [prose(60, 50) + " " + item, prose(60, 51) + " write to jo@mail.example.com now", prose(80, 52), prose(80, 52), None],
                 first=1000)
    for name, df in (("documents", table.unionByName(extra)), ("labels", labels),
                     ("benchmark", spark.createDataFrame([(1, item)], "item_id long, text string"))):
        df.write.parquet(f"{workdir}/{name}.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    frames = [spark.read.parquet(f"{workdir}/documents.parquet")]
    for k, stage in enumerate(stages):
        out = stage(spark, frames[-1], workdir)
        if k < len(stages) - 1:
            assert out.columns == frames[0].columns
        out.write.parquet(f"{workdir}/stage-{k}")
        frames.append(spark.read.parquet(f"{workdir}/stage-{k}"))
    counts = [f.count() for f in frames]
    bad = labels.where("quality = 0").count()
    assert counts[0] == 245 and counts[1] <= 245 - 0.9 * bad and counts[2] == counts[1] - 1
    texts = {r.doc_id: r for r in frames[-1].collect()}
    assert item not in texts[1000].text and "jo@mail" not in texts[1001].text and (1002 in texts) and (1003 not in texts)
    assert all(r.lossless for r in texts.values())
    assert {r.doc_id: r.text for r in corpus_pipeline.run(spark, workdir).collect()} == {d: r.text for d, r in texts.items()}
    assert len(corpus_pipeline.STAGES) == 5 and DOC_SCHEMA


def test_pipeline_stages_on_hard_rows(spark, workdir):
    """Nulls, repeats, a very long text, other scripts, clashing names and text ids; then empty tables."""
    import corpus_pipeline

    table, labels = labelled(spark, 60)
    clashes = ("_row", "_text", "node", "key", "comp", "class_id", "score", "_s", "_hits", "n_words", "_parts", "_new", "_stream", "n_pseudonyms")
    rows = table.unionByName(hard_docs(spark).withColumn("doc_id", F.col("doc_id") + 5000))
    for name in clashes:
        rows = rows.withColumn(name, F.lit("mine"))
    rows = rows.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    labels.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id"))).write.parquet(f"{workdir}/labels.parquet")
    spark.createDataFrame([(1, None), (2, ""), (3, prose(20, 70))], "item_id long, text string").write.parquet(f"{workdir}/benchmark.parquet")
    for name, start in (("hard", rows), ("empty", rows.where("false"))):
        frame = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, frame, workdir)
            assert out.columns[:len(rows.columns)] == rows.columns or k == 4
            out.write.parquet(f"{workdir}/{name}-{k}")
            frame = spark.read.parquet(f"{workdir}/{name}-{k}")
        kept = frame.collect()
        assert all(r[c] == "mine" for r in kept for c in clashes) and all(r.lossless for r in kept)
        assert (len(kept) > 30) == (name == "hard")
        if kept:
            ids = Counter(r.doc_id for r in kept)
            assert ids["d5005"] == 1 and ids["d5004"] == 1 and not ids["d5001"] and not ids["d5002"]      # the last two have no text
    # Without a label nothing is learnt, so nothing goes.
    spark.createDataFrame([], "doc_id string, quality int, toxic int").write.parquet(f"{workdir}/none/labels.parquet")
    assert corpus_pipeline.keep_quality(spark, rows, f"{workdir}/none").count() == rows.count()
    # The stages after it keep texts that are null or empty; of equal empty ones one stays.
    frame = rows.where("text IS NULL OR text = ''")
    for _, stage in corpus_pipeline.STAGES[1:]:
        frame = stage(spark, frame, workdir)
    assert sorted(str(r.text) for r in frame.collect()) == ["", "None"]
