"""Stop words as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairstats.functions.words import stop_word_list


def stop_words(spark: SparkSession, language: str, path: str | None = None) -> DataFrame:
    """One column ``word``: the built-in list of a language, or a text file of one per line."""
    if path is None:
        # Not createDataFrame, whose size Spark does not know.
        words = " ".join(stop_word_list(language))
        return spark.sql("SELECT explode(split(:words, ' ')) AS word", args={"words": words})
    words = spark.read.text(path).select(F.trim(F.regexp_replace("value", r"\r", "")).alias("word"))
    return words.where(F.col("word") != "").distinct()
