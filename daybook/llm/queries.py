"""The registered queries of the training-text operators; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    alignment,
    ann,
    bagminhash,
    decontaminate,
    hard_negatives,
    html_text,
    licenses,
    pii,
    quality,
    sentencepiece_sampling,
    suffix_dedup,
    toxicity,
    weighted_sampling,
)
from daybook.llm.common import crc_fold, read_table


#: Key of the pseudonyms over the synthetic test tables; real data needs a key of its own.
TEST_KEY = "key-of-the-synthetic-tables"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, and whether decoding gives the text back."""
    out = sentencepiece_sampling.encode_decode(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"),
                      F.sha2("decoded", 256).alias("decoded_sha256"),
                      F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return bagminhash.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for personal data."""
    return pii.pseudonymise(read_table(spark, sf_dir, "documents"), TEST_KEY).select("doc_id", "text", "n_pseudonyms")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence sentences and licences of every document."""
    return licenses.scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "sentence_ids", F.array_join("licenses", ",").alias("licenses"), "n_licensed_sentences")


def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark overlap of every document."""
    hits = decontaminate.track_overlap(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    items = F.array_sort("items")
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated 400-byte strings, as figures and a digest."""
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), with_kept=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the folds that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"), lambda c: crc_fold(c, 3) != 1)
    out = quality.score(docs, model)
    return out.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the folds that are not held out, with its toxic passages."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), lambda c: crc_fold(c, 5) != 0)
    out = toxicity.score(docs, model)
    return out.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "segments")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    return weighted_sampling.compare_with_next(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the positives of every vector whose id is divisible by 100; some labels are made wrong first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, moved)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenisations of every document, with corpus-wide link counts."""
    return alignment.align_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sentencepiece, op2_neighbours, op3_main_text, op4_near_duplicates, op5_pseudonyms,
                            op6_licenses, op7_contamination, op8_repeats, op9_quality, op10_toxicity, op11_fingerprints,
                            op12_hard_negatives, op13_alignment)
}

WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
        "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op6_licenses": licenses.oracle(),
    "op7_contamination": f"""
WITH doc AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
item AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
part AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
         FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM win))),
hit AS (SELECT doc_id, item_id, k, i FROM part JOIN win USING (k, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op8_repeats": """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
string AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS s
           FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399)) AS i FROM doc WHERE len(h) >= 800)),
twice AS (SELECT doc_id, i FROM string WHERE s IN (SELECT s FROM string GROUP BY s HAVING count(*) > 1)),
step AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM twice),
span AS (SELECT doc_id, n, min(i) AS a, max(i) + 400 AS b
         FROM (SELECT doc_id, i, sum(CASE WHEN gap <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM step)
         GROUP BY 1, 2),
edge AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b, count(*) AS n_spans, sum(b - a) AS n_removed
         FROM span GROUP BY 1)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN n_spans IS NULL THEN unhex(h) ELSE unhex(concat(substr(h, 1, 2 * a[1]), array_to_string(
    list_transform(range(1, n_spans + 1), lambda k: substr(h, 2 * b[k] + 1, 2 * (coalesce(a[k + 1], len(h) // 2) - b[k]))), ''))) END)
    AS kept_sha256
FROM doc LEFT JOIN edge USING (doc_id)""",
    "op12_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
pair AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
         FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positive AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pair WHERE same
             QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN pair USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 5""",
}
