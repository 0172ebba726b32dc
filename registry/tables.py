"""2-gram facts made from ordinary tables: text documents, and two-word product names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairstats.functions.words import check_language


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a small table, whose one row group a single task would read.

    A table with fewer scan partitions than cores holds less than one partition's bytes per core,
    so the shuffle is small; a larger table is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, words): each document's whole text, cut at blanks, tabs and line ends."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    documents = _spread(documents, "doc_id")
    words = F.array_remove(F.split("text", "[ \t\r\n]+"), "")
    return documents.select("doc_id", "lang", words.alias("words"))


def corpus_of(documents: DataFrame, language: str) -> DataFrame:
    """The rows of one language of a table that holds several (column ``lang``, ISO 639-1)."""
    code = {"english": "en", "hebrew": "he"}[check_language(language)]
    return documents.where(F.col("lang") == code)


def adjacent_pairs(words: DataFrame) -> DataFrame:
    """(doc_id, w1, w2): each word with the next one of its document."""
    n = F.greatest(F.size("words") - 1, F.lit(0))
    first, second = F.slice("words", F.lit(1), n), F.slice("words", F.lit(2), n)
    pairs = F.inline(F.arrays_zip(first.alias("w1"), second.alias("w2"))).alias("w1", "w2")
    return words.select("doc_id", pairs)


def facts(pairs: DataFrame) -> DataFrame:
    """One occurrence of each pair, dated by document id."""
    one = F.lit(1).cast("bigint")
    # Joined once, in an explode: filters are not moved below it, to join the words again for each of their tests.
    return pairs.select(
        F.explode(F.array(F.concat_ws(" ", "w1", "w2"))).alias("ngram"),
        (F.lit(1900) + F.col("doc_id") % 100).cast("int").alias("year"),
        one.alias("match_count"),
        one.alias("page_count"),
        one.alias("volume_count"),
    )


def document_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every adjacent word pair of every document."""
    return facts(adjacent_pairs(document_words(spark, sf_dir)))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same facts as raw lines (column ``line``), in all the shapes a corpus may hold.

    The last digit of a document's id decides how its lines look: good ones, and each kind of
    malformed one.
    """
    pairs = adjacent_pairs(document_words(spark, sf_dir))
    digit = F.col("doc_id") % 10
    year = (F.lit(1900) + F.col("doc_id") % 100).cast("string")
    ngram = (
        F.when(digit == 1, F.col("w1"))
        .when(digit == 2, F.concat_ws(" ", "w1", "w2", "w1"))
        .when(digit == 3, F.concat_ws("  ", "w1", "w2"))
        .when(digit == 4, F.concat_ws(" ", "w1", "w2", F.lit("")))
        .otherwise(F.concat_ws(" ", "w1", "w2"))
    )
    year = F.when(digit == 5, F.concat(year, F.lit("x"))).otherwise(year)
    count = F.when(digit == 6, "0").otherwise("3")
    rest = F.when(digit == 7, "\t").otherwise("2\t1")
    return pairs.select(F.concat_ws("\t", ngram, year, count, rest).alias("line"))


def hebrew_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' facts with small Latin letters spelled in Hebrew ones; others stay."""
    latin = "".join(chr(ord("a") + i) for i in range(26))
    hebrew = "".join(chr(0x05D0 + i) for i in range(26))
    ngrams = document_ngrams(spark, sf_dir)
    return ngrams.withColumn("ngram", F.translate("ngram", latin, hebrew))


def product_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word product names by order year, counted over the ordered items.

    Items are counted by product and year before the product's name is looked up.
    """
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    sold = (
        items.join(orders, items.l_orderkey == orders.o_orderkey)
        .groupBy("l_partkey", F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("sold"))
    )
    return (
        sold.join(parts, sold.l_partkey == parts.p_partkey)
        .groupBy(F.col("p_name").alias("ngram"), "year")
        .agg(F.sum("sold").alias("match_count"))
    )


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacent word pairs as lines ``period w1 w2 TAB n1 n2`` (column ``value``), good and malformed.

    The last digit of a document's id decides; the values are the lengths of the words.
    """
    pairs = adjacent_pairs(document_words(spark, sf_dir))
    digit = F.col("doc_id") % 10
    period = (F.lit(1900) + F.col("doc_id") % 100).cast("string")
    period = F.when(digit == 3, F.concat(F.lit("x"), period)).when(digit == 7, "\\N").otherwise(period)
    second = F.when(digit == 2, F.concat_ws(" ", "w2", "w1")).when(digit == 8, F.lit("")).otherwise(F.col("w2"))
    key = F.when(digit == 1, F.concat_ws(" ", period, "w1")).otherwise(F.concat_ws(" ", period, "w1", second))
    n1, n2 = (F.char_length(w).cast("string") for w in ("w1", "w2"))
    values = (
        F.when(digit == 4, n1)
        .when(digit == 5, F.concat(n1, F.lit(" y"), n2))
        .when(digit == 6, F.concat(F.lit("\\N "), n2))
        .when(digit == 9, F.concat_ws(" ", n1, n2, n1))
        .otherwise(F.concat_ws(" ", n1, n2))
    )
    lone = (digit == 0) & (F.col("doc_id") % 20 == 0)
    return pairs.select(F.when(lone, key).otherwise(F.concat_ws("\t", key, values)).alias("value"))
