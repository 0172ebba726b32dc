"""Period buckets and the text form of a pair key.

A field of a text line is the plain word or number. NULL is ``\\N``, and characters that part fields
or lines are written as two, as is the backslash itself, so that every row can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_bucket(year: Column, width: int = 10) -> Column:
    """The first year of the bucket a year falls in (a decade unless told otherwise)."""
    return year - year % F.lit(width)


# Fixed values of the line format.
NULL = "\\N"
_ESCAPES = {" ": "\\s", "\t": "\\t", "\n": "\\n", "\r": "\\r"}
# Not two backslashes: then each escape could be undone by itself, whatever stands before it.
_BACKSLASH = ("\\", "\\b")


def text_field(value: Column) -> Column:
    """A value as a field of a text line, never NULL."""
    text = escaped = value.cast("string")
    for plain, mark in [_BACKSLASH, *_ESCAPES.items()]:
        escaped = F.replace(escaped, F.lit(plain), F.lit(mark))
    # Hardly any word needs it, so one search comes first.
    return F.coalesce(F.when(text.rlike(r"[\\ \t\n\r]"), escaped).otherwise(text), F.lit(NULL))


def field_text(field: Column) -> Column:
    """The inverse of ``text_field``, as text; a backslash that starts no escape stays."""
    plain = field
    for char, mark in [*_ESCAPES.items(), _BACKSLASH]:
        plain = F.replace(plain, F.lit(mark), F.lit(char))
    marked = F.contains(field, F.lit("\\"))
    return F.when(field != NULL, F.when(marked, plain).otherwise(field))


def pair_key(period: Column, w1: Column, w2: Column) -> Column:
    """``period w1 w2``, the key as it stands in a text file."""
    return F.concat_ws(" ", text_field(period), text_field(w1), text_field(w2))


def nth_field(text: Column, sep: str, n: int) -> Column:
    """Field ``n`` (from 1) of a delimited text, empty if there is none.

    Built on ``substring_index``, which works on the UTF-8 bytes, because a scan of raw lines
    spends most of its time here: ``split`` would build an array of all fields each time.
    """
    if n == 1:
        return F.substring_index(text, sep, 1)
    padded = F.concat(text, F.lit(sep * (n - 1)))
    return F.substring_index(F.substring_index(padded, sep, n), sep, -1)


# What may parse as a whole number: digits with at most a sign, and the characters that a cast trims.
_NUMBER = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*\z"


def parsed(field: Column, kind: str) -> Column:
    """A field as a number of type ``kind``, NULL where it does not parse.

    Only a field that may parse is cast: a cast that fails costs an exception inside Spark, some
    fifty times as long as the cast itself.
    """
    may = field.rlike(_NUMBER) if kind in ("int", "bigint") else field != NULL
    return F.when(may, field.try_cast(kind))


def split_pair_key(key: Column) -> tuple[Column, Column, Column]:
    """The (period, w1, w2) columns of a text key."""
    return (
        parsed(nth_field(key, " ", 1), "int").alias("period"),
        field_text(nth_field(key, " ", 2)).alias("w1"),
        field_text(nth_field(key, " ", 3)).alias("w2"),
    )
