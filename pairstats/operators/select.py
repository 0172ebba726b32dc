"""Choice and order of the scored pairs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to so many rows of each group, every task hands on that many; Spark does so up to 1000 by itself.
FEW_ROWS = 100

# Size of the quantile sketches, and the share of a group's rows that a bound lies lower than it need
# be: the error of a sketch of this size is below a tenth of a percent in 99 of 100 cases.
SKETCH, SLACK = 4096, 0.003
# A sketch is asked for fixed shares alone: 1, then each this much of the one before.
STEP = 0.8

# Letters of the first word by which rows of one score are told apart.
TIE_LETTERS = 4


def _at_least(score: Column, minimum: float) -> Column:
    # Spark sorts NaN above every number, so a plain comparison would keep it.
    return score.isNotNull() & ~F.isnan(score) & (score >= F.lit(float(minimum)))


def either_threshold(scores: DataFrame, min_npmi: float, rel_min_npmi: float) -> DataFrame:
    """Pairs whose score or whose share of the period's scores reaches its threshold."""
    return scores.where(
        _at_least(F.col("npmi"), min_npmi) | _at_least(F.col("rel_npmi"), rel_min_npmi)
    )


def _score(digits: int | None) -> Column:
    """The score to order by: equal scores may differ in their last bits unless rounded."""
    return F.col("npmi") if digits is None else F.round("npmi", digits)


def one_per_score(scores: DataFrame, digits: int | None = None) -> DataFrame:
    """One pair for each distinct score of a period: the first by (w1, w2).

    The lowest pair is an aggregate, so a score shared by most pairs of a period is reduced
    before the shuffle. A window would sort all of them in one task.
    """
    rest = [c for c in scores.columns if c not in ("period", "w1", "w2")]
    first = F.min(F.struct("w1", "w2", *rest)).alias("first")
    return (
        scores.groupBy("period", _score(digits).alias("_score"))
        .agg(first)
        .select("period", *[F.col("first")[c].alias(c) for c in scores.columns if c != "period"])
    )


def rank_order(scores: DataFrame, digits: int | None = None) -> DataFrame:
    """Periods ascending, scores descending, ties by (w1, w2).

    A range sort: the words in the key let a period, or one shared score, span many tasks.
    """
    return scores.orderBy(F.asc("period"), _score(digits).desc(), "w1", "w2")


def top_k(scores: DataFrame, k: int = 10, digits: int | None = None) -> DataFrame:
    """The ``k`` best pairs of each period with their ``rank``; rows without period are one, too.

    Building it starts no job. ``scores`` is read up to three times: give a written table if it is
    costly to make.
    """
    order, bucket = [F.asc("w1"), F.asc("w2")], F.substring("w1", 1, TIE_LETTERS)
    return best_rows(scores, "period", _score(digits), order, bucket, k)


def best_rows(
    rows: DataFrame, group: str, score: Column, order: list[Column], bucket: Column, k: int
) -> DataFrame:
    """The ``k`` best rows of each group with their ``rank``: by score, highest first, NULL last, then
    by ``order``. ``bucket`` is a coarse form of that order: it never falls along it (NULL first).

    A few rows are cut to k in every task before the shuffle. For more, two small aggregates bound what
    is ranked. A mergeable quantile sketch of each group's scores gives a score that some more than k
    rows should reach. Counts by bucket of the rows right at that score, which may be most of a
    group, say up to which bucket they are needed. All rows beyond are dropped before they are
    sorted. The sketch is random and may miss; the counts are exact, so where fewer than k rows reach
    the bound they show it, and the group is ranked whole.
    """
    ordered = [F.col("_score").desc_nulls_last(), *order]
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*ordered))
    rows = rows.withColumn("_score", score)
    if k > FEW_ROWS:
        rows = _within_bounds(rows, group, bucket, k)
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).drop("_score")


def _within_bounds(rows: DataFrame, group: str, bucket: Column, k: int) -> DataFrame:
    columns = rows.columns
    own, score, bound = F.col(group), F.col("_score"), F.col("_bound")
    sketch = F.kll_sketch_agg_double(score.cast("double"), SKETCH)
    sizes = rows.groupBy(own.alias("_group")).agg(
        sketch.alias("_sketch"), F.count(score).alias("_n")
    )
    # The share of a group's rows that should reach the bound, up to the next step of the grid.
    share = SLACK + F.lit(float(k)) / F.col("_n")
    steps = range(int(math.log(SLACK) / math.log(STEP)) + 1)
    quantiles = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(1 - STEP**i) for i in steps]))
    step = F.floor(F.ln(share) / math.log(STEP)).cast("int")
    bounds = sizes.where(share < 1).select("_group", F.get(quantiles, step).alias("_bound"))

    def bounded(bounds: DataFrame, how: str) -> DataFrame:
        return rows.join(bounds, own.eqNullSafe(F.col("_group")), how)

    double = score.cast("double")
    at = bounded(bounds, "inner").where(double >= bound)
    tie = double == bound
    sizes = at.groupBy("_group", "_bound", tie.alias("_tie"), F.when(tie, bucket).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_size")
    )
    running = Window.partitionBy("_group").orderBy("_tie", F.asc_nulls_first("_bucket"))
    reached = sizes.withColumn("_seen", F.sum("_size").over(running)).where(F.col("_seen") >= k)
    # The first bucket with which k rows are reached; a group without one is ranked whole.
    cuts = reached.groupBy("_group").agg(
        F.min_by(F.struct("_bound", "_tie", "_bucket"), "_seen").alias("_cut")
    )
    cut = F.col("_cut")
    within = F.coalesce(bucket <= cut["_bucket"], bucket.isNull())
    kept = cut.isNull() | (double > cut["_bound"]) | ((double == cut["_bound"]) & cut["_tie"] & within)
    return bounded(cuts, "left").where(kept).select(columns)
