"""Tables for the tests: small ones made here, with what each operator must cope with."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(words: int, seed: int) -> str:
    """Invented words; texts of different seeds share none in sequence."""
    rng = random.Random(seed)
    syllables = "ka lo mi ne ru ta vo si den for gal hen im jor kel".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(2, 4))) for _ in range(words))


def docs(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def hard_docs(spark):
    """Nulls in any column, empty and blank texts, a very long one, repeated rows, and other scripts."""
    long = prose(30_000, 1)
    rows = [(1, "", "en", "s", 0), (2, None, None, None, None), (None, prose(40, 2), "en", "s", 1), (3, "   \n ", "en", "s", 5),
            (4, long, "en", "s", len(long)), (5, prose(50, 3), "en", "s", 1), (5, prose(50, 3), "en", "s", 1),
            (6, "пример текста 梦 ▁ 😀 \x01 a\tb", "ru", "s", 3), (7, "x", "en", "s", 1)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
