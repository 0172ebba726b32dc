"""The registered queries: each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairstats.functions.keys import pair_key, period_bucket
from pairstats.operators import clean, counts, scoring, select
from pairstats.plans import collocations as plans
from pairstats.plans.counters import RunCounters
from pairstats.sinks.sequence import write_numbered_sequence
from pairstats.sinks.stage import materialize, read_stage, stage_path, write_stage
from pairstats.sinks.text import write_pair_text, write_scored_text, write_top_k_report
from pairstats.sources.ngrams import (
    read_corpus,
    read_ngrams_sequence,
    read_ngrams_table,
    read_ngrams_text,
)
from pairstats.sources.scored import parse_scored_lines, read_scored_text, split_scored_lines
from pairstats.sources.stop_words import stop_words
from registry.tables import (
    adjacent_pairs,
    corpus_of,
    document_lines,
    document_ngrams,
    document_words,
    facts,
    hebrew_ngrams,
    product_ngrams,
    scored_lines,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6  # scores are compared rounded, because sums of doubles depend on their order
TIE_DIGITS = 9  # equal scores may differ in their last bits


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(name: str) -> Column:
    # Adding 0 turns -0.0 into 0.0.
    return (F.round(name, DIGITS) + F.lit(0.0)).alias(name)


def show_scores(df: DataFrame) -> DataFrame:
    scores = {"pmi", "npmi", "npmi_sum", "rel_npmi"}
    return df.select(*[rounded(c) if c in scores else F.col(c) for c in df.columns])


def product_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair counts of the product names."""
    return counts.pair_counts(clean.clean_pairs(product_ngrams(spark, sf_dir), "english"))


def document_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair counts of the documents, written so that they are counted once."""
    pairs = clean.clean_pairs(document_ngrams(spark, sf_dir), "english")
    return materialize(counts.pair_counts(pairs), "pair_counts")


def product_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.association_scores(
        plans.association_counts(product_ngrams(spark, sf_dir), "english")
    )


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.association_scores(
        plans.association_counts(document_ngrams(spark, sf_dir), "english")
    )


# --- sources -------------------------------------------------------------------------------


@query
def parse_ngram_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines, some of them malformed, split and parsed."""
    parsed = clean.parse_ngram_lines(document_lines(spark, sf_dir))
    return clean.split_words(parsed).select(
        "line",
        "complete",
        "numeric",
        "w1",
        "w2",
        "year",
        "match_count",
        "page_count",
        "volume_count",
    )


@query
def ngrams_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as text files, read back, cleaned and counted."""
    path = stage_path(spark, "lines")
    document_lines(spark, sf_dir).select("line").write.text(path)
    return counts.pair_counts(clean.clean_pairs(read_ngrams_text(spark, path), "english"))


@query
def ngrams_sequence_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as sequence files of (line number, line), read back, cleaned and counted."""
    path = stage_path(spark, "lines")
    # Keys above 32 bits, because smaller Python integers would be written as IntWritable.
    number = F.monotonically_increasing_id() + F.lit(2**32)
    numbered = document_lines(spark, sf_dir).select(number, "line")
    write_numbered_sequence(numbered, path)
    return counts.pair_counts(clean.clean_pairs(read_ngrams_sequence(spark, path), "english"))


@query
def ngrams_table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed facts in Parquet, of which only the columns in use are read."""
    path = stage_path(spark, "ngrams")
    document_ngrams(spark, sf_dir).write.parquet(path)
    return counts.pair_counts(clean.clean_pairs(read_ngrams_table(spark, path), "english"))


@query
def corpus_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair counts of the English documents alone, by way of one folder for each language."""
    paths = {}
    for language in ("english", "hebrew"):
        paths[language] = stage_path(spark, language)
        chosen = corpus_of(document_words(spark, sf_dir), language)
        facts(adjacent_pairs(chosen)).write.parquet(paths[language])
    corpus = read_corpus(spark, "english", paths, "parquet")
    return counts.pair_counts(clean.clean_pairs(corpus, "english"))


# --- cleaning ------------------------------------------------------------------------------


@query
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept and lines rejected, by the first check they fail."""
    lines = clean.parse_ngram_lines(document_lines(spark, sf_dir))
    return clean.reject_report(lines, "english")


@query
def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected lines themselves, with their reasons."""
    lines = clean.parse_ngram_lines(document_lines(spark, sf_dir))
    _, rejects = clean.split_valid(lines, "english")
    return rejects.select("line", "reason")


@query
def split_by_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and rejected lines out of one scan, each under its outcome."""
    lines = clean.parse_ngram_lines(document_lines(spark, sf_dir))
    good, rejects = clean.split_valid_written(lines, "english", keep=["line"])
    kept = good.select("line", F.lit("kept").alias("outcome"))
    return kept.union(rejects.select("line", F.col("reason").alias("outcome")))


@query
def scored_lines_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the well-formed scored lines."""
    good, _ = split_scored_lines(scored_lines(spark, sf_dir), dict.fromkeys(("n1", "n2"), "bigint"))
    return good


@query
def scored_lines_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The malformed scored lines, with their reasons."""
    _, rejects = split_scored_lines(scored_lines(spark, sf_dir), dict.fromkeys(("n1", "n2"), "bigint"))
    return rejects


@query
def clean_pairs_english(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_pairs(document_ngrams(spark, sf_dir), "english")


@query
def clean_pairs_fold_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = clean.clean_pairs(document_ngrams(spark, sf_dir), "english", fold_case=True)
    return counts.pair_counts(pairs)


@query
def clean_pairs_hebrew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents spelled in Hebrew letters, under the Hebrew rules."""
    return clean.clean_pairs(hebrew_ngrams(spark, sf_dir), "hebrew")


@query
def stop_word_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of letters only, stop words dropped by anti-join instead of a literal list."""
    letters = clean.clean_pairs(document_ngrams(spark, sf_dir), "english", stop_words=[])
    return clean.drop_stop_pairs(letters, stop_words(spark, "english"), "english")


@query
def stop_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each stop word of the list occurs in the documents, 0 for those that do not."""
    words = document_words(spark, sf_dir).select(F.explode("words").alias("w"))
    seen = words.groupBy(F.lower("w").alias("word")).agg(F.count(F.lit(1)).alias("n_rows"))
    every = stop_words(spark, "english").join(seen, "word", "left")
    return every.select("word", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@query
def clean_pairs_own_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair counts without the words of a list of one's own, in mixed case."""
    pairs = clean.clean_pairs(
        document_ngrams(spark, sf_dir), "english", stop_words=["The", "OF", "and"]
    )
    return counts.pair_counts(pairs)


@query
def period_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts by period, for two widths."""
    ngrams = document_ngrams(spark, sf_dir)
    return ngrams.groupBy(
        period_bucket(F.col("year")).alias("decade"),
        period_bucket(F.col("year"), 25).alias("quarter"),
    ).agg(F.sum("match_count").alias("n"))


@query
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders, chosen by their keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return clean.sample_by_hash(orders, ["o_orderkey", "o_custkey"], 0.5)


@query
def row_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts about a random half: its share, and whether any fact is in it too often."""
    whole = document_ngrams(spark, sf_dir)
    keys = ["ngram", "year"]
    # Both sides meet in one count of their rows: a join would sort all facts of either first.
    side = lambda df, sampled: df.select(*keys, F.lit(sampled).alias("sampled"))
    rows = side(whole, False).union(side(clean.sample_rows(whole, 0.5, seed=7), True))
    both = rows.groupBy(*keys).agg(
        F.count_if(~F.col("sampled")).alias("n_whole"), F.count_if("sampled").alias("n_sample")
    )
    share = F.sum("n_sample") / F.sum("n_whole")
    fits = F.col("n_sample") <= F.col("n_whole")
    return both.agg(
        F.sum("n_whole").alias("n_rows"),
        share.between(0.45, 0.55).alias("share_in_bounds"),
        F.min(fits).alias("all_in_whole"),
    )


# --- counts --------------------------------------------------------------------------------


@query
def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.pair_counts(clean.clean_pairs(document_ngrams(spark, sf_dir), "english"))


@query
def left_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.left_counts(document_pairs(spark, sf_dir))


@query
def right_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.right_counts(document_pairs(spark, sf_dir))


@query
def period_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.period_totals(document_pairs(spark, sf_dir))


@query
def count_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_levels(document_pairs(spark, sf_dir))


@query
def with_left_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.with_left_count(document_pairs(spark, sf_dir))


@query
def with_right_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.with_right_count(document_pairs(spark, sf_dir))


@query
def with_period_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.with_period_total(document_pairs(spark, sf_dir))


@query
def association_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.association_counts(document_ngrams(spark, sf_dir), "english")


@query
def association_counts_stop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with stop words from a table, which is applied to counted pairs."""
    stop = stop_words(spark, "english").select(F.upper("word").alias("word"))
    return plans.association_counts(document_ngrams(spark, sf_dir), "english", stop_words=stop)


@query
def association_counts_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a pair table in buckets of period and first word."""
    return plans.association_counts(document_ngrams(spark, sf_dir), "english", buckets=8)


@query
def association_counts_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.association_counts(product_ngrams(spark, sf_dir), "english", width=5)


@query
def reverse_pair_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with their words changed over, and the text key of the new order."""
    key = pair_key(F.col("period"), F.col("w1"), F.col("w2")).alias("pair_key")
    return counts.reverse_pairs(product_pairs(spark, sf_dir)).withColumn("pair_key", key)


# --- scores --------------------------------------------------------------------------------


@query
def pmi_npmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = plans.association_counts(product_ngrams(spark, sf_dir), "english")
    return show_scores(scoring.with_npmi(scoring.with_pmi(counted)))


@query
def npmi_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = plans.association_counts(document_ngrams(spark, sf_dir), "english")
    return show_scores(scoring.npmi_totals(scoring.with_npmi(counted)))


@query
def relative_npmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_scores(product_scores(spark, sf_dir))


@query
def association_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_scores(document_scores(spark, sf_dir))


# --- choice and order ----------------------------------------------------------------------


@query
def select_either_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product names, whose sums are negative, so that low scores pass by their share."""
    return show_scores(select.either_threshold(product_scores(spark, sf_dir), 0.05, 0.5))


@query
def collocations_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    ngrams = document_ngrams(spark, sf_dir)
    return show_scores(plans.extract_collocations(ngrams, "english", 0.7, 0.3))


@query
def collocations_hebrew(spark: SparkSession, sf_dir: str) -> DataFrame:
    ngrams = hebrew_ngrams(spark, sf_dir)
    return show_scores(plans.extract_collocations(ngrams, "hebrew", 0.7, 0.3))


@query
def one_per_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    ngrams = document_ngrams(spark, sf_dir)
    return show_scores(
        plans.extract_collocations(
            ngrams, "english", 0.7, 0.3, ties="one_per_score", digits=TIE_DIGITS
        )
    )


@query
def top_k_per_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = select.top_k(document_scores(spark, sf_dir), 10, TIE_DIGITS)
    return show_scores(best.select("period", "rank", "w1", "w2", "npmi"))


@query
def top_k_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More pairs for each period than one task should rank."""
    best = select.top_k(document_scores(spark, sf_dir), 1500, TIE_DIGITS)
    return show_scores(best.select("period", "rank", "w1", "w2", "npmi"))


@query
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ngrams = document_ngrams(spark, sf_dir)
    return plans.stage_counts(ngrams, "english", 0.7, 0.3, digits=TIE_DIGITS)


@query
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per stage of a run, counted by the run itself."""
    counters = RunCounters()
    found = plans.extract_collocations(
        document_ngrams(spark, sf_dir), "english", 0.7, 0.3, counters=counters
    )
    materialize(found, "collocations")
    return spark.createDataFrame(list(counters.rows().items()), "stage string, n_rows bigint")


# --- sinks ---------------------------------------------------------------------------------


@query
def stage_parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "pairs")
    write_stage(document_pairs(spark, sf_dir), path)
    return read_stage(spark, path)


@query
def scored_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "scores")
    write_scored_text(document_scores(spark, sf_dir), path, ["npmi", "rel_npmi"])
    values = {"npmi": "double", "rel_npmi": "double"}
    return show_scores(read_scored_text(spark, path, values))


@query
def text_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts with NULLs in any column and words of odd characters, through text and back."""
    path = stage_path(spark, "odd")
    pairs = document_pairs(spark, sf_dir)
    first, second = F.length("w1"), F.length("w2")
    odd = pairs.select(
        F.when(first % 5 > 0, F.col("period")).alias("period"),
        F.when(second % 7 == 0, F.concat("w1", F.lit(" \\N\t\\s")))
        .when(second % 7 != 1, F.col("w1"))
        .alias("w1"),
        F.when(first % 6 == 0, F.concat(F.lit("\\"), "w2", F.lit("\r\n"))).otherwise(F.col("w2")).alias("w2"),
        F.when(second % 3 > 0, F.col("c12")).alias("c12"),
        (F.col("c12") + 1).alias("further"),
        F.when(first % 4 > 0, F.concat_ws(" ", "w2", "w1")).alias("words"),
    )
    write_pair_text(odd, path, ["c12", "further", "words"])
    return read_scored_text(spark, path, {"c12": "bigint", "further": "bigint", "words": "string"})


@query
def delivered_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each pair in the written text: its line, after all part files before its own."""
    path = stage_path(spark, "scores")
    write_scored_text(document_scores(spark, sf_dir), path, ["npmi"], TIE_DIGITS)
    # Lines of one block of a file are read in their order by one task, so their ids rise by one; written
    # once, as another scan may number them otherwise.
    block = F.struct("_metadata.file_name", "_metadata.file_block_start").alias("block")
    lines = spark.read.text(path, lineSep="\n").select(
        block, F.monotonically_increasing_id().alias("id"), "value"
    )
    lines = materialize(lines, "lines")
    # One row for each block.
    blocks = lines.groupBy("block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    lines = lines.join(F.broadcast(before), "block")
    position = (F.col("before") + F.col("id") - F.col("first") + 1).alias("position")
    return show_scores(parse_scored_lines(lines.select(position, "value"), keep=["position"]))


@query
def counts_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "counts")
    counted = plans.association_counts(document_ngrams(spark, sf_dir), "english")
    write_pair_text(counted, path, ["c12", "c1", "c2"])
    return read_scored_text(spark, path, dict.fromkeys(("c12", "c1", "c2"), "bigint"))


@query
def top_k_report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "report")
    write_top_k_report(document_scores(spark, sf_dir), path, 10, TIE_DIGITS)
    return show_scores(read_scored_text(spark, path))
