"""A corpus pipeline over ``documents``: each stage applies one operator to all that the stage before kept.

Language ID (documents without letters or with an unsure prediction go), near-duplicates (one document of each group stays),
repeated 400-byte strings and passages of over 50 words (removed; documents left without a word go), mixing (copies in training order), packing (tokens of
at most 2048 to a sequence). All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.llm import langid, minhash, mixing, packing, repeats
from clinloom.llm.shared import WORDS, store, table

#: Predictions below this probability are rejected. A text of no known word or n-gram scores what its label shares give, so
#: something must be known of this share of its words.
LEAST_SCORE = 0.5
LEAST_EVIDENCE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a missing label is filled in with the prediction."""
    model = langid.fit(docs.select("text", "lang"))
    predicted = langid.predict(docs, model)
    kept = predicted.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE) & (F.col("evidence") >= LEAST_EVIDENCE))
    filled = F.coalesce(F.col("row.lang"), F.col("lang_pred")).alias("lang")
    return kept.select(*[filled if c == "lang" else F.col(f"row.{c}").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, by 5-word shingles at a similarity of 0.8."""
    return minhash.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without 400-byte strings and 51-word passages that occur more than once; ``n_chars`` follows the text.

    A removed span may end inside a character; the bytes of such a character that are left are dropped.
    """
    cleaned = repeats.without_repeated_passages(docs, length=400, words=51)
    emptied = (F.size("spans") > 0) & ~F.col("clean").rlike(WORDS)
    read = cleaned.where(~F.coalesce(emptied, F.lit(False)))
    replaced = {"text": F.col("clean").alias("text"), "n_chars": F.length("clean").cast("long").alias("n_chars")}
    return read.select(*[replaced.get(c, F.col(f"row.{c}").alias(c)) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: copies of documents in training order."""
    return mixing.training_order(mixing.plan_mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all documents, packed into sequences."""
    packed = packing.pack(docs)
    return packed.select("row.doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language),
    ("minhash_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("source_mixing", mix),
    ("best_fit_packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
