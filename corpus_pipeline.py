"""A corpus from raw documents to packed batches: five operators, each on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import language, mixing, near_dup, packing, secrets
from tablewright.llm.base import Work, table

# Least calibrated probability of the predicted language, and how many times chance is enough
# where there are so many languages that this is less.
LEAST_CONFIDENCE = 0.5
TIMES_CHANCE = 2


def in_some_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is predicted with confidence; `und` ones go.

    Where no document teaches a language, those with a letter stay.
    """
    model = language.learned(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike("\\p{L}"))
    least = min(LEAST_CONFIDENCE, TIMES_CHANCE / len(model.languages))
    judged = language.with_language(docs, model)
    return judged.where((F.col("lang_pred") != language.UNKNOWN)
                        & (F.col("score") >= least)).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each near-duplicate group (five-word shingles, 0.8).

    Rows that repeat a kept id stay; so do rows without an id.
    """
    gone = near_dup.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    gone = Work(spark, "gone").stored(gone, "gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and `n_chars` counted anew."""
    return secrets.masked(docs)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last of a source's budget is cut."""
    mix = mixing.repeated(mixing.mixed(docs), docs.columns)
    return mix.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, each with its length bucket, batch and slot."""
    return packing.packed(docs)


STAGES = [
    ("language", in_some_language),
    ("near_dup", one_of_each_group),
    ("secrets", without_secrets),
    ("mixing", to_target_weights),
    ("packing", batches),
]

# Learned decisions, hashes and random orders are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in turn; each one's rows are stored before the next reads them."""
    work = Work(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.stored(stage(spark, docs, sf_dir), name)
    return docs
