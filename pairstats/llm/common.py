"""Helpers that several operators share."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as ASCII characters.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(column: str, parts: int) -> Column:
    """The part of a row by the CRC-32 of its id as text; -1 where the id is null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % parts, F.lit(-1)).cast("int")


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone, a null text read as empty; other columns never reach an operator."""
    return docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is worked out once a row."""
    return F.transform(F.array(value), body)[0]


def labelled(labels: DataFrame, column: str, learn: Column | None = None) -> DataFrame:
    """One (doc_id, label) for each labelled document; the larger of differing labels counts."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
    rows = rows if learn is None else rows.where(learn)
    return rows.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.col(column).cast("int")).alias("label")
    )


def bounded_sample(rows: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` of (doc_id, label), each label by its share, chosen by a hash of the id.

    Spark keeps ``bound`` rows of each task at most (a top-k), so this needs no large task.
    """
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def small(df: DataFrame, most: int = 2_000_000) -> DataFrame:
    """A written table of ids: broadcast if it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.count() <= most else df


def wrapped(docs: DataFrame) -> DataFrame:
    """(_doc, doc_id, text): every column of ``docs`` as one struct, out of the way of new names."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    return docs.select(
        whole,
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def give_back() -> None:
    """Return free memory to the system; the end of a task calls it, as workers wait beside others."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_texts(
    df: DataFrame, added: str, function: Callable, drop: str = "text", per_task: bool = False
) -> DataFrame:
    """``df`` with the columns ``added`` (a DDL schema) that ``function`` makes of a batch of texts.

    ``function`` takes the texts of one Arrow batch and returns one list for each added column.
    With ``per_task`` it takes nothing and returns such a function, once for each task.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(added)
    kept = [f for f in df.schema.fields if f.name != drop]
    schema = StructType(kept + new.fields)

    def run(batches):
        types = to_arrow_schema(new)
        over = function() if per_task else function
        for batch in batches:
            made = over(batch.column("text").to_pylist())
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(x, type=t.type) for x, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        batch = made = columns = over = None
        give_back()

    return df.mapInArrow(run, schema)
