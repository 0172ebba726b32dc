"""Reader of scored text: ``period w1 w2 TAB v1 v2 ...``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairstats.functions.keys import NULL, field_text, nth_field, parsed, split_pair_key
from pairstats.sinks.stage import split_written


def parse_scored_lines(
    lines: DataFrame, values: Mapping[str, str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Pairs with their values out of column ``value``, after the columns ``keep``.

    Every line gives a row: what does not parse is NULL. ``split_scored_lines`` tells such lines apart.
    """
    values = _values(values)
    key = nth_field(F.col("value"), "\t", 1)
    rest = nth_field(F.col("value"), "\t", 2)
    columns = [
        _parsed(nth_field(rest, " ", i), kind).alias(name)
        for i, (name, kind) in enumerate(values.items(), start=1)
    ]
    return lines.select(*keep, *split_pair_key(key), *columns)


def _values(values: Mapping[str, str] | None) -> Mapping[str, str]:
    return {"npmi": "double"} if values is None else values


def _parsed(field: Column, kind: str) -> Column:
    return field_text(field) if kind == "string" else parsed(field, kind)


def scored_reject_reason(values: Mapping[str, str] | None = None) -> Column:
    """The first check a scored line in column ``value`` fails, NULL for a good one.

    ``few_fields``: no TAB, or fewer than three fields before it. ``many_fields``: more fields than
    there are names for, on either side. ``bad_period``, ``empty_word``. ``few_values``, ``bad_value``:
    a value is missing, or neither parses nor is marked as NULL.
    """
    return _reject_reason(*_cut(F.split("value", "\t")), values)


def _cut(parts: Column) -> tuple[Column, Column, Column]:
    """The number of parts of a line, and the fields of the first and of the last part."""
    return F.size(parts), F.split(F.get(parts, F.lit(0)), " "), F.split(F.element_at(parts, -1), " ")


def _reject_reason(parts: Column, key: Column, rest: Column, values: Mapping[str, str] | None) -> Column:
    values, fields = _values(values), (F.size(key), F.size(rest))
    period, *words = (F.get(key, F.lit(i)) for i in range(3))
    bad = F.lit(False)
    for i, kind in enumerate(values.values()):
        field = F.get(rest, F.lit(i))
        if kind != "string":
            bad = bad | ((field != NULL) & parsed(field, kind).isNull())
    return (
        F.when((parts < 2) | (fields[0] < 3), "few_fields")
        .when((parts > 2) | (fields[0] > 3) | (fields[1] > len(values)), "many_fields")
        .when((period != NULL) & parsed(period, "int").isNull(), "bad_period")
        .when((words[0] == "") | (words[1] == ""), "empty_word")
        .when(fields[1] < len(values), "few_values")
        .when(bad, "bad_value")
    )


def split_scored_lines(
    lines: DataFrame, values: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Pairs of the good lines (column ``value``), and the rejected lines (value, reason).

    The lines are read once: both sides are written by the way. Blank lines, which part the groups of a
    report, are neither.
    """
    # Lines and their parts are split once, in an explode: else each mention would split them again.
    cut = lines.select("value", F.explode(F.array(F.split("value", "\t"))).alias("_parts"))
    cut = cut.where(F.col("value") != "").select(
        "value", F.inline(F.array(F.struct(*_cut(F.col("_parts"))))).alias("_n", "_key", "_rest")
    )
    reason = _reject_reason(F.col("_n"), F.col("_key"), F.col("_rest"), values)
    # Written as what is before the first TAB, and the TAB with what follows: each is more alike from line to line.
    first = F.substring_index("value", "\t", 1)
    rest = F.expr("substring(cast(value AS binary), octet_length(substring_index(value, '\t', 1)) + 1)")
    judged = cut.select(first.alias("_first"), rest.cast("string").alias("_rest"), reason.alias("reason"))
    whole = F.concat("_first", "_rest").alias("value")
    good, rejects = split_written(judged, "reason", "scored_lines")
    return parse_scored_lines(good.select(whole), values), rejects.select(whole, "reason")


def split_scored_text(
    spark: SparkSession, path: str, values: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``split_scored_lines`` of text files."""
    return split_scored_lines(spark.read.text(path), values)


def read_scored_text(
    spark: SparkSession, path: str, values: Mapping[str, str] | None = None
) -> DataFrame:
    """Read pairs with their values, given as name -> type (default: ``npmi`` as double)."""
    # Blank lines part the groups of a report.
    return parse_scored_lines(spark.read.text(path).where(F.col("value") != ""), values)
