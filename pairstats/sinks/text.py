"""Text results: ``period w1 w2 TAB score``; see ``functions.keys`` for NULLs and odd characters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairstats.functions.keys import pair_key, text_field
from pairstats.operators.select import rank_order, top_k


def _line(values: Sequence[str]) -> Column:
    key = pair_key(F.col("period"), F.col("w1"), F.col("w2"))
    scores = F.concat_ws(" ", *[text_field(F.col(v)) for v in values])
    return F.concat_ws("\t", key, scores)


def write_pair_text(df: DataFrame, path: str, values: Sequence[str]) -> None:
    """Write each pair with its values, as the rows come. The path must be new.

    ``read_scored_text`` reads it back.
    """
    df.select(_line(values).alias("value")).write.mode("errorifexists").text(path)


def write_scored_text(
    df: DataFrame, path: str, values: Sequence[str] = ("npmi",), digits: int | None = None
) -> None:
    """Write ranked lines. The path must be new.

    Every part file is in rank order, and so is their sequence. A period is not tied to one
    file: a large one spans several. ``digits`` rounds the score for the order.
    """
    write_pair_text(rank_order(df, digits), path, values)


def write_top_k_report(
    df: DataFrame, path: str, k: int = 10, digits: int | None = None
) -> None:
    """Write the ``k`` best pairs of each period, a blank line before each period.

    Part files hold ranges of (period, rank), so that any k can be written; read in the order of
    their names they are the report.
    """
    lines = F.when(F.col("rank") == 1, F.array(F.lit(""), _line(["npmi"])))
    report = top_k(df, k, digits).repartitionByRange("period", "rank")
    report = report.sortWithinPartitions("period", "rank")
    (
        report.select(F.explode(lines.otherwise(F.array(_line(["npmi"])))).alias("value"))
        .write.mode("errorifexists")
        .text(path)
    )
