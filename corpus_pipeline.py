"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``docs``. Stages decide
row by row, so rows without id and repeated rows are treated like all others, except that
near-duplicate removal keeps one row of an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairstats.llm.common import fold_of, table, wrapped
from pairstats.llm.minhash import near_duplicates
from pairstats.llm.packing import pack_documents
from pairstats.llm.pii import mask_personal_data
from pairstats.llm.quality_rules import keep_good
from pairstats.llm.toxicity import score_toxicity
from pairstats.sinks.stage import materialize

#: Documents with a score from here on are toxic.
TOXIC = 0.7
#: Words of a shingle; documents whose shingle sets agree to 0.8 or more are near-duplicates.
WIDTH = 5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    labels = table(spark, sf_dir, "labels")
    scored = score_toxicity(wrapped(docs), labels, fold_of("doc_id", 3) != 1)
    return scored.where(F.col("score") < TOXIC).select("_doc.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id.

    Of rows with one id the first by text stays. Rows without id stay.
    """
    found = near_duplicates(docs, WIDTH).where("kept AND doc_id IS NOT NULL")
    ids = found.select("doc_id").distinct()
    named = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").cast("bigint").alias("doc_id"))
    kept = named.join(ids, "doc_id", "left_semi")
    first = Window.partitionBy("doc_id").orderBy("_doc.text")
    kept = kept.withColumn("_place", F.row_number().over(first)).where("_place = 1")
    return kept.select("_doc.*").union(docs.where("doc_id IS NULL"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    masked = mask_personal_data(docs).select(docs.columns)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", length)
    return masked


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality),
    ("near_duplicates", near_duplicate),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Classifiers, tokenizers and packing cannot be written in SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
