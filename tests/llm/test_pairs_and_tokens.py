"""Fingerprints, hard negatives and the alignment of two tokenisers, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs, empty_docs, hard_docs, prose
from pyspark.sql import functions as F

from daybook.llm import alignment, hard_negatives
from daybook.llm import weighted_sampling as ws
from daybook.llm.common import bags, word_hashes

# --- fingerprints --------------------------------------------------------------------------------


def plain_samples(weights: dict[int, int]) -> list[tuple[int, int]]:
    """The sampling rule word by word and slot by slot, with the module's draws."""
    out = []
    for k in range(ws.SLOTS):
        best = None
        for word, weight in weights.items():
            r, log_c, b = (float(x[0, k]) for x in ws.draws(np.array([word], np.uint64)))
            t = math.floor(math.log(weight) / r + b)
            y = math.exp(r * (t - b))
            a = math.exp(log_c) / (y * math.exp(r))
            best = min(best, (a, word, t)) if best else (a, word, t)
        out.append(best[1:])
    return out


def test_samples_follow_the_rule(monkeypatch):
    rng = random.Random(4)
    rows = [{rng.getrandbits(64): rng.choice([1, 1, 1, 2, 5, 90]) for _ in range(n)} for n in (1, 3, 40, 25)]
    rows[3].update(list(rows[2].items())[:12])
    row = np.repeat(np.arange(4), [len(r) for r in rows])
    word = np.concatenate([np.array(sorted(r), np.uint64) for r in rows])
    weight = np.concatenate([[r[w] for w in sorted(r)] for r in rows])
    whole = ws.samples(row, word, weight, 5)
    want = [plain_samples(r) for r in rows]
    for i in range(4):
        for k in range(ws.SLOTS):
            w, t = want[i][k]
            assert int(whole[i, k]) == int(ws.mix64(np.array([w], np.uint64) + np.array([t + 1], np.uint64) * ws.STRIDE)[0])
    assert (whole[4] == ws.NO_SAMPLE).all()
    monkeypatch.setattr(ws, "PAIRS", 7)
    monkeypatch.setattr(ws, "WORDS", 5)
    assert (ws.samples(row, word, weight, 5) == whole).all()


def jaccard(a: str, b: str) -> float:
    x, y = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_collision_rate_is_the_weighted_similarity():
    rng = random.Random(5)
    # Words of their own for each pair, so that the pairs' errors are independent.
    words = [[f"w{i}.{k}" for k in range(60)] for i in range(150)]
    pairs = [(" ".join(rng.choices(w[:30 + 3 * (i % 10)], k=80)), " ".join(rng.choices(w[20:], k=60 + i))) for i, w in enumerate(words)]
    flat = [t for p in pairs for t in p]
    bits, _ = ws.signatures(pa.array([t.encode() for t in flat], pa.binary()))
    got = (bits[::2] == bits[1::2]).mean(axis=1)
    want = np.array([jaccard(a, b) for a, b in pairs])
    assert abs((got - want).mean()) < 0.01
    assert np.abs(got - want).max() < 4.5 * 0.5 / math.sqrt(ws.SLOTS)


def plain_next(rows):
    """(key, text, edited, text after) in descending order of the key, nulls last."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (key, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        n = len(text) // 3
        yield key, text, text[:len(text) - n] + after[:n], after


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_compared_with_the_next(spark, parts):
    rows = [(i * 7 % 101, prose(3 + i * 5, i % 40) + " Ünï 😀" * (i % 3)) for i in range(60)] + [(500, ""), (501, ""), (502, "  "), (503, "x")]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, at int, part string").repartition(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        out = {r.doc_id: r for r in ws.compare_with_next(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(out) == len(rows)

    def written(t):
        return ws._written(*ws.signatures(pa.array([t.encode()], pa.binary())))[0]

    def alike(a, b):
        if not a or not b:
            return float(a == b)
        return sum(a[i:i + 4] == b[i:i + 4] for i in range(0, len(a), 4)) / ws.SLOTS

    for key, text, new, after in plain_next(rows):
        r = out[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.fingerprint == written(text) and r.edited_fingerprint == written(new)
        assert r.near_edited == alike(written(text), written(new))
        assert r.near_next == alike(written(text), written(after))


def test_fingerprints_of_hard_rows(spark):
    out = ws.compare_with_next(hard_docs(spark)).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in hard_docs(spark).collect())
    by = {r.doc_id: r for r in out}
    assert by[2].n_chars == 0 and by[2].fingerprint == "" and by[1].fingerprint == "" == by[3].fingerprint
    assert by[2].near_next == 1.0 and by[3].near_next == 1.0 and by[2].near_edited == 1.0   # 3 and 2 are followed by texts without words
    twins = sorted(r.near_next for r in out if r.doc_id == 5)
    assert twins[1] == 1.0 and len({r.fingerprint for r in out if r.doc_id == 5}) == 1
    assert ws.compare_with_next(empty_docs(spark)).collect() == []
    one = ws.compare_with_next(docs(spark, ["a b c d e f"])).collect()
    assert one[0].near_next == 1.0


def test_fingerprint_columns(spark):
    df = docs(spark, ["one two three", "One  two three", None, "other words"]).withColumn("Fingerprint", F.lit(1))
    rows = ws.with_fingerprint(df).collect()
    assert [c for c in rows[0].asDict() if c.lower() == "fingerprint"] == ["fingerprint"]
    assert rows[0].fingerprint == rows[1].fingerprint != rows[3].fingerprint and rows[2].fingerprint == ""
    pairs = spark.createDataFrame([(rows[i].fingerprint, rows[j].fingerprint) for i in range(4) for j in range(4)], "a string, b string")
    got = [r.n for r in pairs.select(ws.likeness("a", "b").alias("n")).collect()]
    assert got[0] == got[1] == got[5] == got[10] == 1.0 and got[2] == 0.0 and got[3] < 0.1


# --- hard negatives ------------------------------------------------------------------------------


def vectors(spark, rows, schema="vec_id long, embedding array<double>, label int"):
    return spark.createDataFrame(rows, schema)


def plain_negatives(rows, is_anchor, k=5):
    """The definition, pair by pair, in Python's whole numbers."""
    clean = {(i, lab, tuple(x)): [math.floor(256 * v) for v in x] for i, x, lab in rows if i is not None and lab is not None
             and x is not None and all(v is not None and math.isfinite(v) for v in x)}
    flat = [(i, lab, q) for (i, lab, _), q in clean.items()]
    out = []
    for a, lab, q in flat:
        if not is_anchor(a):
            continue
        scored = [(sum(x * y for x, y in zip(q, p)), i, other) for i, other, p in flat if len(p) == len(q)]
        first = sorted(((-s, i) for s, i, other in scored if other == lab and i != a))[:k]
        for s, i in first:
            fits = sorted((-n, j) for n, j, other in scored if other != lab and 80 * -s <= 100 * n <= 100 * -s)[:k]
            out += [(a, i, r + 1, j, -s, -n) for r, (n, j) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("dims", [1, 7, 64, 130])
def test_hard_negatives_equal_brute_force(spark, dims):
    rng = np.random.default_rng(dims)
    centre = rng.standard_normal((6, dims))
    x = (centre[rng.integers(0, 6, 700)] + rng.standard_normal((700, dims)) * 0.7) / np.sqrt(dims)
    label = np.where(rng.random(700) < 0.35, 3, rng.integers(0, 4, 700))
    rows = [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label, strict=True))]
    rows += rows[:90] + [(900 + i, x[0].tolist(), i % 3) for i in range(60)]
    got = hard_negatives.mine(vectors(spark, rows), F.col("id") % 20 == 0).collect()
    assert sorted(tuple(r) for r in got) == plain_negatives(rows, lambda i: i % 20 == 0)


def test_intervals_hold_every_score():
    rng = np.random.default_rng(3)
    for dims in (1, 5, 64, 100):
        x = np.floor(rng.standard_normal((300, dims)) * rng.uniform(0, 400, (300, 1)))
        q = np.floor(rng.standard_normal((20, dims)) * 90)
        x[:5], q[0], q[1] = 0, 0, 17
        low, high = hard_negatives.intervals(q, *hard_negatives.coded(x))
        exact = q @ x.T
        assert (low <= exact).all() and (exact <= high).all()
        width = (high - low).mean() / (np.linalg.norm(x, axis=1).mean() * np.linalg.norm(q, axis=1).mean())
        assert width < 1.7


def test_hard_negatives_of_hard_rows(spark):
    big = 1e200
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.9, 0.5], 2), (2, [0.9, 0.5], 2), (3, None, 1), (4, [None, 1.0], 1),
            (5, [float("nan"), 1.0], 2), (6, [float("inf"), 1.0], 2), (7, [1.0, 0.5], None), (None, [1.0, 0.5], 1), (8, [], 1), (9, [], 2),
            (10, [0.0, 0.0], 1), (11, [0.0, -0.0], 2), (12, [1.0], 1), (13, [0.99], 2), (14, [0.98], 1), (2, [0.9, 0.5], 3),
            (20, [2.0**20, 1.0, 0.0], 1), (21, [2.0**20, 3.0, 0.0], 1), (22, [2.0**20, 2.0, 0.0], 2), (23, [2.0**20, -2.0, 0.0], 2),
            (30, [big, 0.0, 0.0, 0.0], 1), (31, [big, 1.0, 0.0, 0.0], 1), (32, [big, 0.0, 1.0, 0.0], 2), (33, [1.5e308, 0.0], 1)]
    df = vectors(spark, rows).withColumn("a", F.lit(1)).withColumn("dims", F.lit("x"))
    got = sorted(tuple(r) for r in hard_negatives.mine(df, F.col("id") >= 0).collect() if r.anchor_id < 30)
    want = [r for r in plain_negatives([r for r in rows if r[0] is None or r[0] < 30], lambda i: True)]
    end = (1 << 63) - 1
    assert got == sorted((a, i, r, j, min(s, end), min(n, end)) for a, i, r, j, s, n in want)
    assert hard_negatives.mine(vectors(spark, []), F.col("id") >= 0).collect() == []


# --- alignment -----------------------------------------------------------------------------------


def plain_alignment(texts):
    """Ends as sets of offsets, links by comparing all tokens of a text."""
    vocab = alignment.tokens(alignment.A_FILE, alignment.B_FILE)
    rows, counts = [], Counter()
    for text in texts:
        raw = (" " + text).encode() if text else b""
        a, b = [], []
        if text:
            a = vocab.a.encode(" " + text, add_special_tokens=False).ids
            b = vocab.b.encode(text)
            if b"".join(vocab.a_bytes[i] for i in a) != raw or b"".join(vocab.b_bytes[i] for i in b) != raw:
                a, b = [], []
        spans = []
        for ids, table in ((a, vocab.a_bytes), (b, vocab.b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(out)
        linked = [(p[2], q[2]) for p in spans[0] for q in spans[1] if p[0] < q[1] and q[0] < p[1]]
        cuts = sorted({p[1] for p in spans[0]} & {q[1] for q in spans[1]})
        parts, last = [], 0
        for c in cuts:
            parts.append("|".join(",".join(str(s[2]) for s in side if last <= s[0] < c) for side in spans))
            last = c
        counts.update(linked)
        rows.append((len(a), len(b), len(cuts), linked, hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(n, m, g, len(p), sum(counts[x] == most[x[1]] for x in p), sum(counts[x] for x in p), d) for n, m, g, p, d in rows]


HARD_TEXTS = ["Hello world, this is a test of alignment.", "", None, "naïve café — 日本語のテキスト 😀😀", "a▁b", "x", "   leading and   inner  ",
              "<|endoftext|> and <s> </s> <unk> <0x41>", "tabs\tand\nlines\r\n", "\x00\x01 control", "1234567890 " * 40, "é" * 300,
              "Hello world, this is a test of alignment.", "supercalifragilistic" * 9, "￼ﬁ ½ Å", " "]


def test_alignment_equals_brute_force(spark):
    texts = HARD_TEXTS + [prose(60, i) for i in range(12)]
    df = docs(spark, texts).withColumn("at", F.lit("mine")).withColumn("pairs", F.lit(1)).withColumn("N_A", F.lit(-1))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = plain_alignment(texts)
    assert any(w[0] for w in want) and want[1] == want[2] == want[4] == (0, 0, 0, 0, 0, 0, "")
    for hot in (alignment.HOT, 20, 1):
        out = {r.doc_id: r for r in alignment.align_tokens(df, hot=hot).collect()}
        assert len(out) == len(texts)
        for i, w in enumerate(want):
            assert tuple(out[i][n] for n in names) == w, texts[i]
        assert out[0].at == "mine" and out[0].pairs == 1 and "text" not in out[0].asDict() and "N_A" not in out[0].asDict()


def test_groups_by_skipping():
    rng = random.Random(6)
    for _ in range(400):
        n = rng.randint(1, 120)
        common = rng.random()
        cuts = [[c for c in range(1, n) if rng.random() < p] + [n] for p in (rng.random(), rng.random())]
        if common < 0.5:
            cuts[1] = [c for c in cuts[0] if rng.random() < 0.95 or c == n]
        x, y = cuts
        both = sorted(set(x) & set(y))
        want, last = [], 0
        for c in both:
            want.append(tuple(tuple(k for k, e in enumerate(side) if last < e <= c) for side in (x, y)))
            last = c
        uneven = [(p[0], p[-1] + 1, q[0], q[-1] + 1) for p, q in want if len(p) + len(q) > 2]
        assert alignment.groups(x, y) == uneven


def test_encoding_by_ranks_is_that_of_the_file():
    vocab = alignment.tokens(alignment.A_FILE, alignment.B_FILE)
    rng = random.Random(8)
    signs = "ab Éß'тя語가 \n\t\u00a0123½²٣.,;!?’“”—€😀🙂ﬁ\u2028\u0378\U0001fa80ꟊ\x00\x85'll's"
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(2000)]
    texts += [t for t in HARD_TEXTS if t] + [" " * 3000 + "x", "x" * 5000, "\n" * 2000, prose(400, 3)]
    assert vocab.ranks is not None
    want = [vocab.a.encode(t, add_special_tokens=False).ids for t in texts]
    assert vocab.encode_a(texts) == want
    settled = [k for k, t in enumerate(texts) if not alignment.UNSETTLED.search(t)]
    assert len(settled) > 20 and [vocab.ranks.encode_ordinary(texts[k]) for k in settled] == [want[k] for k in settled]


def test_alignment_of_hard_rows(spark):
    out = alignment.align_tokens(hard_docs(spark)).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in hard_docs(spark).collect())
    assert next(r for r in out if r.doc_id == 4).n_a > 30_000
    assert alignment.align_tokens(empty_docs(spark)).collect() == []


def test_words_of_a_column():
    row, word = word_hashes(pa.array([b"A b  a", b"", b"\n", b"x"], pa.binary()))
    assert row.tolist() == [0, 0, 0, 3] and word[0] == word[2] != word[1]
    assert bags(row, word)[2].sum() == 4
