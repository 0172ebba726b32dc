"""Readers of 2-gram facts: raw lines, sequence files and typed tables."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JError
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pairstats.functions.words import check_language
from pairstats.operators.clean import parse_ngram_lines, sample_rows

NGRAM_SCHEMA = "ngram string, year int, match_count bigint, page_count bigint, volume_count bigint"


def _sampled(df: DataFrame, fraction: float | None, seed: int | None) -> DataFrame:
    """The rows to use; taken before parsing, which would otherwise be done for all of them."""
    return df if fraction is None else sample_rows(df, fraction, seed)


def read_ngrams_text(
    spark: SparkSession, path: str, fraction: float | None = None, seed: int | None = None
) -> DataFrame:
    """Lines ``w1 w2 TAB year TAB count TAB ...``, parsed; see ``parse_ngram_lines``.

    ``fraction`` takes a random share of the lines, here as in the other readers.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    return parse_ngram_lines(_sampled(lines, fraction, seed))


def _rows_of(spark: SparkSession, records: RDD) -> DataFrame:
    """(key, line) of records that the JVM holds.

    By way of the session's own calls for rows of an RDD, which leave out the Python workers. Where
    a Spark version has other ones, the records pass through Python.
    """
    schema = StructType([StructField("key", LongType()), StructField("line", StringType())])
    try:
        util = spark.sparkContext._jvm.org.apache.spark.api.python.SerDeUtil
        arrays = util.toJavaArray(records._to_java_object_rdd())
        rows = spark._jsparkSession.applySchemaToPythonRDD(arrays.rdd(), schema.json())
        return DataFrame(rows, spark)
    except (AttributeError, TypeError, Py4JError):
        return spark.createDataFrame(records, schema, verifySchema=False)


def read_ngrams_sequence(
    spark: SparkSession, path: str, fraction: float | None = None, seed: int | None = None
) -> DataFrame:
    """The same lines as the values of sequence files ``<LongWritable, Text>``.

    Spark SQL has no sequence file format, but the JVM reads the records and makes rows of them;
    no Python worker takes part. For repeated runs write the result to Parquet and use
    ``read_ngrams_table``. A compressed corpus needs its codec on the class path.
    """
    records = spark.sparkContext.sequenceFile(
        path,
        keyClass="org.apache.hadoop.io.LongWritable",
        valueClass="org.apache.hadoop.io.Text",
    )
    lines = _rows_of(spark, records).select("line")
    return parse_ngram_lines(_sampled(lines, fraction, seed))


def read_ngrams_table(
    spark: SparkSession, path: str, fraction: float | None = None, seed: int | None = None
) -> DataFrame:
    """Typed facts in Parquet. The columns that no count uses are never read.

    Such a table is made from parsed lines that are ``numeric``.
    """
    return _sampled(spark.read.schema(NGRAM_SCHEMA).parquet(path), fraction, seed)


READERS = {
    "text": read_ngrams_text,
    "sequence": read_ngrams_sequence,
    "parquet": read_ngrams_table,
}


def read_corpus(
    spark: SparkSession,
    language: str,
    paths: Mapping[str, str],
    source: str = "text",
    fraction: float | None = None,
    seed: int | None = None,
) -> DataFrame:
    """The facts of one language out of a map from language to path."""
    return READERS[source](spark, paths[check_language(language)], fraction, seed)
