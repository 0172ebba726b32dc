"""Association scores as column expressions.

All counts are those of the kept pairs: ``c12`` of the ordered pair, ``c1`` of its first word in
first place, ``c2`` of its second word in second place and ``n`` of all pairs in the period.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pmi(c12: Column, c1: Column, c2: Column, n: Column) -> Column:
    """Pointwise mutual information, natural log."""
    return F.ln(c12) + F.ln(n) - F.ln(c1) - F.ln(c2)


def npmi(c12: Column, c1: Column, c2: Column, n: Column) -> Column:
    """PMI over ``-ln p(w1, w2)``; NULL where a period holds a single pair (0 / 0)."""
    return F.try_divide(pmi(c12, c1, c2, n), -(F.ln(c12) - F.ln(n)))


def relative_npmi(score: Column, score_sum: Column) -> Column:
    """Share of the period's sum of scores; NULL where the sum is 0.

    The sum takes in negative scores. Where it is negative, a pair with a negative score gets a
    positive share; where it is near 0, shares are large. Both follow from the definition.
    """
    return F.try_divide(score, score_sum)
