"""Counts of pairs, of their words and of periods, and the joins that attach them to each pair.

The totals are attached by equi-joins from written tables, not by window sums: a window would
bring every pair of one word (or period) into one task. The written table's size lets Spark
broadcast a small table of totals. With a large one both sides are shuffled, and a word that holds
a large share of all pairs is spread over many slices by the hash of its other word. Adaptive
execution alone would not do: with thousands of partitions Spark keeps only average sizes of
shuffled blocks, and may not see the hot one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairstats.sinks.stage import materialize, materialize_buckets

PAIR = ("period", "w1", "w2")

# Values of ``level`` in ``count_levels``: Spark's grouping id over (period, w1, w2).
LEVELS = {0: "pair", 1: "left", 2: "right", 3: "period"}

# A word with more pairs than this is hot. In tables so large that more than ``HOT_WORDS`` words
# could be, the limit is that share of all pairs, so that there are always fewer.
HOT_PAIRS = 2_000_000
HOT_WORDS = 100_000

# The most rows of a table of period totals to broadcast.
MANY_PERIODS = 1_000_000


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Occurrences of each ordered pair in each period, over all its years."""
    return pairs.groupBy(*PAIR).agg(F.sum("match_count").alias("c12"))


def left_counts(counts: DataFrame) -> DataFrame:
    """Occurrences of each word in first place."""
    return counts.groupBy("period", "w1").agg(F.sum("c12").alias("c1"))


def right_counts(counts: DataFrame) -> DataFrame:
    """Occurrences of each word in second place."""
    return counts.groupBy("period", "w2").agg(F.sum("c12").alias("c2"))


def period_totals(counts: DataFrame) -> DataFrame:
    """Occurrences of all pairs in a period."""
    return counts.groupBy("period").agg(F.sum("c12").alias("n"))


def bucketed_pairs(counts: DataFrame, place: str = "w1", buckets: int | None = None) -> DataFrame:
    """The pair table, written in buckets of (period, ``place``).

    Totals of the words in that place, and the join that attaches them, then read bucket by bucket and
    shuffle no pair. Worth its one shuffle where the totals are too large to broadcast, and more so where
    the table is used again. A word hot enough to be sliced is still spread over many tasks.
    """
    if buckets is None:
        buckets = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize_buckets(counts, ["period", place], buckets, "pair_counts")


def _n_pairs() -> Column:
    return F.count(F.lit(1)).alias("n_pairs")


def word_totals(counts: DataFrame, place: str) -> DataFrame:
    """(period, ``place``, total, n_pairs): occurrences and number of pairs of each word there."""
    totals = counts.groupBy("period", place).agg(F.sum("c12").alias("total"), _n_pairs())
    return materialize(totals, f"{place}_totals")


def roll_up(totals: DataFrame) -> DataFrame:
    """(period, total, n_pairs) out of the totals of words, of which there are far fewer than pairs."""
    return totals.groupBy("period").agg(F.sum("total").alias("total"), F.sum("n_pairs").alias("n_pairs"))


def count_levels(counts: DataFrame) -> DataFrame:
    """Pair, word and period counts; ``level`` tells them apart (see ``LEVELS``).

    Each level is summed from the next finer one: words from the pairs, periods from the written totals
    of first words. No pair is copied, as grouping sets would do for each level. ``counts`` is read three
    times: give a written table.
    """
    left = word_totals(counts, "w1")
    levels = [counts.withColumnRenamed("c12", "total"), left, right_counts(counts), roll_up(left)]
    levels[2] = levels[2].withColumnRenamed("c2", "total")

    def row(level: int, part: DataFrame) -> DataFrame:
        words = [F.col(c) if c in part.columns else F.lit(None).cast("string").alias(c) for c in ("w1", "w2")]
        return part.select("period", *words, F.lit(level).alias("level"), "total")

    return reduce(DataFrame.unionByName, [row(level, part) for level, part in enumerate(levels)])


def join_by_period(rows: DataFrame, totals: DataFrame, periods: int | None = None) -> DataFrame:
    """Join a written table of one row per period, which is counted and then broadcast."""
    if periods is None:
        periods = totals.count()
    return rows.join(F.broadcast(totals) if periods <= MANY_PERIODS else totals, "period")


def _attach_word_total(counts: DataFrame, totals: DataFrame, place: str, rows: int) -> DataFrame:
    """Join the totals (period, ``place``, total, n_pairs) of a word in that place.

    ``rows`` is the number of all pairs. A hot word's pairs go to as many slices as they exceed the
    limit, and its total is repeated for each slice: fewer than twice ``HOT_WORDS`` rows more. The
    hot words themselves, fewer than ``HOT_WORDS``, are broadcast to mark the pairs.
    """
    keys = ["period", place]
    limit = max(rows // HOT_WORDS, HOT_PAIRS)
    if rows <= limit or totals.agg(F.max("n_pairs")).first()[0] <= limit:
        return counts.join(totals.drop("n_pairs"), keys)
    marked, sliced = slice_hot(counts, totals, keys, "w2" if place == "w1" else "w1", limit)
    return marked.join(sliced, [*keys, "_slice"])


def slice_hot(
    pairs: DataFrame, words: DataFrame, keys: list[str], other: str, limit: int
) -> tuple[DataFrame, DataFrame]:
    """``pairs`` and ``words`` (keys, n_pairs, more) with ``_slice``, for joins on keys and slice.

    A word with more than ``limit`` pairs has as many slices as it exceeds that; its pairs are dealt
    by the hash of column ``other``. The hot words, fewer than rows / limit, are broadcast.
    """
    slices = F.ceil(F.col("n_pairs") / F.lit(limit)).cast("int")
    hot = words.where(F.col("n_pairs") > limit).select(*keys, slices.alias("_slices"))
    own_slice = F.pmod(F.xxhash64(other), F.col("_slices")).cast("int")
    marked = pairs.join(F.broadcast(hot), keys, "left").select(
        *pairs.columns, F.coalesce(own_slice, F.lit(0)).alias("_slice")
    )
    each_slice = F.explode(F.sequence(F.lit(0), slices - 1)).alias("_slice")
    rest = [c for c in words.columns if c not in keys and c != "n_pairs"]
    return marked, words.select(*keys, *rest, each_slice)


def _with_word_count(counts: DataFrame, place: str, name: str) -> DataFrame:
    totals = word_totals(counts, place)
    rows = totals.agg(F.sum("n_pairs")).first()[0] or 0
    out = _attach_word_total(counts, totals, place, rows)
    return out.select(*counts.columns, F.col("total").alias(name))


# The functions below read ``counts`` twice, for the totals and for the join: give them a written
# table if it is costly to make.


def with_left_count(counts: DataFrame) -> DataFrame:
    """Attach ``c1``, the total of each pair's first word."""
    return _with_word_count(counts, "w1", "c1")


def with_right_count(counts: DataFrame) -> DataFrame:
    """Attach ``c2``, the total of each pair's second word."""
    return _with_word_count(counts, "w2", "c2")


def with_period_total(counts: DataFrame) -> DataFrame:
    """Attach ``n``, the total of each pair's period: a table of one row per period."""
    totals = materialize(period_totals(counts), "period_totals")
    return join_by_period(counts, totals).select(*counts.columns, "n")


def with_all_counts(counts: DataFrame) -> DataFrame:
    """Attach ``c1``, ``c2`` and ``n``. Totals of words are summed from the pairs, those of periods
    from the totals of first words."""
    left, right = word_totals(counts, "w1"), word_totals(counts, "w2")
    period = materialize(roll_up(left), "period_totals")
    periods, rows = period.agg(F.count(F.lit(1)), F.sum("n_pairs")).first()
    rows = rows or 0
    out = _attach_word_total(counts, left, "w1", rows)
    out = out.select(*counts.columns, F.col("total").alias("c1"))
    out = _attach_word_total(out, right, "w2", rows)
    out = out.select(*counts.columns, "c1", F.col("total").alias("c2"))
    period = period.select("period", F.col("total").alias("n"))
    return join_by_period(out, period, periods).select(*counts.columns, "c1", "c2", "n")


def reverse_pairs(pairs: DataFrame) -> DataFrame:
    """The same rows with the two words changed over."""
    rest = [c for c in pairs.columns if c not in PAIR]
    return pairs.select("period", F.col("w2").alias("w1"), F.col("w1").alias("w2"), *rest)
