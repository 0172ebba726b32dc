"""Scores of counted pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairstats.functions.scores import npmi, pmi, relative_npmi
from pairstats.operators.counts import join_by_period
from pairstats.sinks.stage import materialize


def with_pmi(counts: DataFrame) -> DataFrame:
    """Add ``pmi`` to rows that hold c12, c1, c2 and n."""
    return counts.withColumn("pmi", pmi(*map(F.col, ("c12", "c1", "c2", "n"))))


def with_npmi(counts: DataFrame) -> DataFrame:
    """Add ``npmi`` to rows that hold c12, c1, c2 and n."""
    return counts.withColumn("npmi", npmi(*map(F.col, ("c12", "c1", "c2", "n"))))


# Bits after the point in an exact sum, and how many of them go into its lower part.
POINT, LOWER = 52, 26


def exact_sum(value: Column) -> Column:
    """Sum of doubles that does not depend on the order of the rows, to the last bit.

    Each value is rounded to a multiple of 2**-52 and split into two whole numbers of 26 bits and
    more, which add up exactly. Some 10**11 values of size 1 fit; beyond, it is an error, not a wrong
    number. No score is larger than 1; a sum over values beyond 1024, or not finite, is the plain one.
    """
    finite = value.between(-(2.0**10), 2.0**10)
    scaled = F.round(F.when(finite, value) * 2.0**POINT).cast("bigint")
    upper = F.sum(F.shiftright(scaled, LOWER)).cast("double") * 2.0 ** (LOWER - POINT)
    lower = F.sum(scaled.bitwiseAND(F.lit(2**LOWER - 1))).cast("double") * 2.0**-POINT
    return F.when(F.coalesce(F.bool_and(finite), F.lit(True)), upper + lower).otherwise(F.sum(value))


def npmi_totals(scores: DataFrame) -> DataFrame:
    """Sum of the scores of all pairs of a period, negative ones too."""
    return scores.groupBy("period").agg(exact_sum(F.col("npmi")).alias("npmi_sum"))


def with_relative_npmi(scores: DataFrame) -> DataFrame:
    """Add ``rel_npmi``. ``scores`` is read twice: give a written table if it is costly to make."""
    totals = materialize(npmi_totals(scores), "npmi_totals")
    share = relative_npmi(F.col("npmi"), F.col("npmi_sum")).alias("rel_npmi")
    return join_by_period(scores, totals).select(*scores.columns, share)
