"""From 2-gram facts to clean word pairs: field checks, stop words, letters, periods, samples."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairstats.functions.keys import parsed, period_bucket
from pairstats.functions.words import (
    check_language,
    first_word,
    has_stop_word,
    is_two_letter_words,
    is_two_words,
    lookup_form,
    second_word,
    stop_word_list,
)
from pairstats.operators.counts import HOT_PAIRS, HOT_WORDS, slice_hot
from pairstats.sinks.stage import materialize, split_written

# A longer list of stop words becomes a table, instead of text in the plan.
LONG_LIST = 5_000

# The shape of a line. At least four fields, of which empty ones at the end do not
# count; and, in a numeric line, digits with at most a sign (no blanks) in fields two and three.
COMPLETE = r"^[^\t]*\t[^\t]*\t[^\t]*\t+[^\t]"
DIGITS = r"^[+-]?[0-9]+\z"


def parse_ngram_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Split ``w1 w2 TAB year TAB count TAB ...`` into typed columns, next to the line itself.

    ``complete`` says whether there are four fields, ``numeric`` whether they also hold digits for
    a year and a count. A number that does not parse is NULL; one with blanks around it parses, but
    its line is not ``numeric``.
    """
    # A line is split once, in an explode: no later filter is moved below that, to split it again.
    fields = F.split(F.col(line), "\t")
    cut = lines.select(F.col(line).alias("line"), F.explode(F.array(fields)).alias("_fields"))
    ngram, year, matches, pages, volumes = (F.get("_fields", F.lit(i)) for i in range(5))
    # The whole line is searched only where its fourth field is empty and not its last.
    complete = (
        F.when(pages != "", True)
        .when(F.array_size("_fields") <= 4, False)
        .otherwise(F.col("line").rlike(COMPLETE))
    )
    return cut.select(
        "line",
        complete.alias("complete"),
        (complete & year.rlike(DIGITS) & matches.rlike(DIGITS)).alias("numeric"),
        ngram.alias("ngram"),
        parsed(year, "int").alias("year"),
        parsed(matches, "bigint").alias("match_count"),
        parsed(pages, "bigint").alias("page_count"),
        parsed(volumes, "bigint").alias("volume_count"),
    )


def split_words(ngrams: DataFrame) -> DataFrame:
    """Add ``w1`` and ``w2``; both NULL unless the 2-gram is two words."""
    ngram = F.col("ngram")
    two = is_two_words(ngram)
    return ngrams.withColumns(
        {"w1": F.when(two, first_word(ngram)), "w2": F.when(two, second_word(ngram))}
    )


def _words(language: str, stop_words: Iterable[str] | None) -> list[str]:
    check_language(language)
    return stop_word_list(language) if stop_words is None else list(stop_words)


def _line_is(ngrams: DataFrame, shape: str) -> Column:
    """The flag that parsing left; typed facts have none and need none."""
    return F.col(shape) if shape in ngrams.columns else F.lit(True)


def is_valid(
    ngrams: DataFrame, language: str, stop_words: Iterable[str] | None = None
) -> Column:
    """True for a row without a reject reason, for use in a filter (it may be NULL).

    Catalyst moves this filter below the projection that parses a line, so every mention of a
    column is worked out again. Hence the cheap test that fails most bad rows comes first, and
    words are cut out only to look them up. The order of the tests does not change the outcome.
    """
    ngram = F.col("ngram")
    return (
        is_two_letter_words(ngram, language)
        & ~has_stop_word(language, _words(language, stop_words))
        & _line_is(ngrams, "numeric")
        & F.col("year").isNotNull()
        & (F.col("match_count") > 0)
    )


def reject_reason(
    ngrams: DataFrame, language: str, stop_words: Iterable[str] | None = None
) -> Column:
    """The first check a row fails, NULL for a good row."""
    ngram, words = F.col("ngram"), _words(language, stop_words)
    counted = F.coalesce(F.col("match_count") > 0, F.lit(False))
    return (
        F.when(~_line_is(ngrams, "complete"), "few_fields")
        .when(~is_two_words(ngram), "not_two_words")
        .when(has_stop_word(language, words), "stop_word")
        .when(~is_two_letter_words(ngram, language), "non_letter")
        .when(~_line_is(ngrams, "numeric") | F.col("year").isNull() | ~counted, "bad_number")
    )


def split_valid(
    ngrams: DataFrame, language: str, stop_words: Iterable[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The good rows, and the rejected rows with their ``reason``; using both reads ``ngrams`` twice.

    ``ngrams`` holds ngram, year and match_count, and two flags if it came from text lines.
    """
    valid = ngrams.where(is_valid(ngrams, language, stop_words))
    reason = reject_reason(ngrams, language, stop_words)
    # A filter is not moved below an explode: there every mention of a column would be worked out again.
    judged = ngrams.select("*", F.explode(F.array(reason)).alias("reason"))
    return valid, judged.where(F.col("reason").isNotNull())


def split_valid_written(
    ngrams: DataFrame,
    language: str,
    stop_words: Iterable[str] | None = None,
    keep: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``split_valid`` out of a single scan of ``ngrams``.

    Every row is judged once and written under its outcome; the two tables read their own folders.
    ``keep`` names the columns to write, all unless given.
    """
    reason = reject_reason(ngrams, language, stop_words)
    judged = ngrams.select(*(keep or ngrams.columns), reason.alias("reason"))
    return split_written(judged, "reason", "outcomes")


def reject_report(
    ngrams: DataFrame, language: str, stop_words: Iterable[str] | None = None
) -> DataFrame:
    """Rows per outcome: each reject reason, and ``kept``."""
    outcome = F.coalesce(reject_reason(ngrams, language, stop_words), F.lit("kept"))
    return ngrams.groupBy(outcome.alias("reason")).agg(F.count(F.lit(1)).alias("n_rows"))


def pair_outcomes(
    ngrams: DataFrame, language: str, width: int = 10, stop_words: Iterable[str] | None = None
) -> DataFrame:
    """(reason, period, w1, w2, c12, n_facts): all facts in one pass.

    Good ones are counted by pair with a NULL reason, rejected ones by reason with NULL words.
    """
    reason = reject_reason(ngrams, language, stop_words)
    judged = ngrams.select("ngram", "year", "match_count", reason.alias("reason"))
    good, ngram = F.col("reason").isNull(), F.col("ngram")
    keyed = judged.select(
        "reason",
        F.when(good, period_bucket(F.col("year"), width)).alias("period"),
        F.when(good, first_word(ngram)).alias("w1"),
        F.when(good, second_word(ngram)).alias("w2"),
        "match_count",
    )
    return keyed.groupBy("reason", "period", "w1", "w2").agg(
        F.sum("match_count").alias("c12"), F.count(F.lit(1)).alias("n_facts")
    )


def stop_table(
    spark: SparkSession, stop_words: Iterable[str] | DataFrame | None
) -> list[str] | DataFrame | None:
    """Stop words as given, but a long list as a table."""
    if stop_words is None or isinstance(stop_words, DataFrame):
        return stop_words
    words = list(stop_words)
    if len(words) <= LONG_LIST:
        return words
    return spark.createDataFrame([(word,) for word in words], "word string")


def clean_pairs(
    ngrams: DataFrame,
    language: str,
    width: int = 10,
    fold_case: bool = False,
    stop_words: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """Good rows as (period, w1, w2, match_count). Case is kept unless ``fold_case`` is set.

    Stop words given as a table (column ``word``), or as a long list, are dropped by
    ``drop_stop_pairs``.
    """
    stop_words = stop_table(ngrams.sparkSession, stop_words)
    if isinstance(stop_words, DataFrame):
        pairs = clean_pairs(ngrams, language, width, fold_case, [])
        return drop_stop_pairs(pairs, stop_words, language)
    valid = ngrams.where(is_valid(ngrams, language, stop_words))
    w1, w2 = first_word(F.col("ngram")), second_word(F.col("ngram"))
    if fold_case:
        w1, w2 = F.lower(w1), F.lower(w2)
    period = period_bucket(F.col("year"), width)
    return valid.select(period.alias("period"), w1.alias("w1"), w2.alias("w2"), "match_count")


def drop_stop_pairs(pairs: DataFrame, stop_words: DataFrame, language: str) -> DataFrame:
    """Drop pairs with a word of ``stop_words(word)`` in either place, by anti-join.

    For lists too long for a literal set; words and list meet in the form they are looked up in.
    The list is first cut to words that occur, each with the number of its pairs: both sides of that
    join have one row for each word. Only what is left meets the pairs, sliced where a word is
    hot. Give it counted pairs, not facts: the outcome is the same, with fewer rows to shuffle.
    """
    check_language(language)
    listed = stop_words.select(lookup_form(F.col("word"), language).alias("_word")).distinct()
    listed = materialize(listed, "stop_words")
    columns = pairs.columns
    for place, other in (("w1", "w2"), ("w2", "w1")):
        keyed = pairs.withColumn("_word", lookup_form(F.col(place), language))
        seen = keyed.groupBy("_word").agg(F.count(F.lit(1)).alias("n_pairs"))
        found = materialize(seen.join(listed, "_word", "left_semi"), "stop_words")
        most, rows = found.agg(F.max("n_pairs"), F.sum("n_pairs")).first()
        limit = max((rows or 0) // HOT_WORDS, HOT_PAIRS)
        if (most or 0) > limit:
            marked, sliced = slice_hot(keyed, found, ["_word"], other, limit)
            pairs = marked.join(sliced, ["_word", "_slice"], "left_anti").select(columns)
        else:
            pairs = keyed.join(found, "_word", "left_anti").select(columns)
    return pairs


def sample_rows(df: DataFrame, fraction: float = 0.5, seed: int | None = None) -> DataFrame:
    """A random share of the rows, taken before any other work."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_hash(df: DataFrame, keys: Sequence[str], fraction: float = 0.5) -> DataFrame:
    """A share of the rows that depends on their keys only.

    Unlike ``sample_rows`` it picks the same rows in every run, whatever the partitioning, and
    in every engine: the keys' MD5, read as a number, is compared with the fraction.
    """
    text = F.concat_ws("\t", *[F.col(key).cast("string") for key in keys])
    slot = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.where(slot < F.lit(int(fraction * 2**32)))
