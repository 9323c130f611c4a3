"""Corpus preparation: quality, near-duplicates, benchmark decontamination, pseudonyms, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  All but the last
return the columns of documents, whatever further columns these have and however they are called.

Edge cases, in every stage: a row whose text is null or empty stays unless said otherwise below; a text of any
length is worked on whole; ids may be null, repeated or of any type; an empty table gives an empty one.

- quality: without any label nothing is learnt and all documents stay; a null, empty or blank text has nothing to be
  judged by and goes, as one of low quality;
- near-duplicates: exact copies are one class, repeated rows as well, of which one stays; rows with a null text are
  classes of their own and all stay;
- decontamination: without benchmark items nothing changes;
- pseudonyms: the key is the session's ``spark.daybook.pseudonymKey``, or, unset as over the synthetic tables, a test key;
- tokens: a null text has null pieces, and counts as lossless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import bagminhash, decontaminate, pii, quality, sentencepiece_sampling
from daybook.llm.common import materialise, prepare, read_table
from daybook.llm.queries import TEST_KEY


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled neighbours vote for quality; learnt from all labels of these documents."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    if not len(model.labels):
        return docs
    scored = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))
    return quality.score(scored, model, "_text").where("score >= 0.5").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    prepare(spark)
    return bagminhash.deduplicate(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that consist of them for more than half go whole."""
    return decontaminate.remove_contamination(docs, read_table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; ``n_chars`` follows the text."""
    prepare(spark)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))
    new = pii.pseudonymise(rows, spark.conf.get("spark.daybook.pseudonymKey", TEST_KEY), "_text")
    columns = {c: F.col(f"_row.`{c}`") for c in docs.columns} | {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        length = F.char_length("_text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("n_pseudonyms") > 0, length).otherwise(F.col("_row.n_chars"))
    return new.select(*[columns[c].alias(c) for c in docs.columns])


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their sampled pieces and, for a check, whether these decode to the text."""
    prepare(spark)
    out = sentencepiece_sampling.encode_decode(docs)
    return out.withColumn("lossless", F.col("decoded").eqNullSafe(F.col("text"))).drop("decoded")


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("PII", replace_personal_data),
    ("SentencePiece encoding and decoding", tokenise),
]

#: A learnt classifier, keyed permutations and sampling: SQL cannot express the stages; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{k}")
    return docs
