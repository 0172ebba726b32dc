"""The registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairstats.llm.caps import near_vectors
from pairstats.llm.common import fold_of, table, texts_of
from pairstats.llm.compression import score_quality
from pairstats.llm.conversations import prefix_trie
from pairstats.llm.minhash import near_duplicates
from pairstats.llm.mixing import score_texts
from pairstats.llm.packing import pack_documents
from pairstats.llm.pii import digest_personal_data
from pairstats.llm.phrases import collocations
from pairstats.llm.pieces import encoded_digests
from pairstats.llm.quality_rules import apply_quality_rules
from pairstats.llm.secrets import find_secrets
from pairstats.llm.toxicity import score_toxicity
from pairstats.llm.trie_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return apply_quality_rules(documents, labels).drop("failed")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    scored = score_toxicity(texts_of(documents), labels, fold_of("doc_id", 3) != 1)
    return scored.select(
        "doc_id",
        (fold_of("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op3_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_personal_data(table(spark, sf_dir, "documents"))


@query
def op2_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


@query
def op10_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


@query
def op4_cap_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    scored = score_quality(texts_of(documents), labels, fold_of("doc_id", 3) != 1)
    return scored.select(
        "doc_id",
        (fold_of("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = score_texts(documents, fold_of("doc_id", 7) != 2)
    held_out = (fold_of("doc_id", 7) == 2).alias("held_out")
    return scored.select("doc_id", held_out, *[c for c in scored.columns if c != "doc_id"])


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("n_ends")


@query
def op13_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
