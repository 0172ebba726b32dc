"""Written tables between the steps of a run."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Folders of local sessions that name none, and folders found to be shared, by application.
_local_folders: dict[str, str] = {}
_seen_folders: set[tuple[str, str]] = set()
# The folder of rows that have no reason to be rejected.
KEPT = "kept"
# Folders that a task of a split writes at the same time, and bytes that each holds back: with more
# folders than that Spark sorts the rest.
WRITERS, HELD = 16, 1 << 25
# How they are written: lines hardly ever repeat, so a dictionary is no use, but they begin alike.
PACKED = {
    "parquet.block.size": str(HELD),
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.page.size": str(1 << 22),
    "parquet.page.row.count.limit": "1000000",
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "9",
}
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# Names of the tables in buckets.
_bucketed: list[str] = []
# Folders of the open runs, the innermost last.
_runs: list[str] = []


def _hadoop_path(spark: SparkSession, folder: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)


def file_system(spark: SparkSession, folder: str):
    """The Hadoop file system that a folder resolves to."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return _hadoop_path(spark, folder).getFileSystem(conf)


def is_local(spark: SparkSession, folder: str) -> bool:
    """True if a folder, once resolved, is on a file system of the machine at hand."""
    return file_system(spark, folder).getUri().getScheme() == "file"


def _check_shared(spark: SparkSession, folder: str) -> None:
    """Refuse a folder on a local file system that executors do not see.

    A folder that all machines mount is local by name only: a marker written by the driver tells.
    """
    context = spark.sparkContext
    key = (context.applicationId, folder)
    if context.master.startswith("local") or key in _seen_folders or not is_local(spark, folder):
        return
    marker = f"{folder.rstrip('/')}/.pairstats-{uuid.uuid4().hex}"
    files, path = file_system(spark, folder), _hadoop_path(spark, marker)
    files.mkdirs(path)
    try:
        plain = path.toUri().getPath()
        tasks = max(2, context.defaultParallelism)
        if not all(context.parallelize(range(tasks), tasks).map(lambda _: os.path.isdir(plain)).collect()):
            raise ValueError(f"{folder} is local to the driver; name a folder all executors share")
    finally:
        files.delete(path, True)
    _seen_folders.add(key)


def stage_root(spark: SparkSession) -> str:
    """The shared folder for written tables: the session's ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder. A cluster session must name one that its
    executors see: a folder of one machine alone is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder or context.getCheckpointDir():
        folder = folder or context.getCheckpointDir()
        _check_shared(spark, folder)
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = context.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="pairstats-")
    return _local_folders[application]


def _application_folder(spark: SparkSession) -> str:
    return f"{stage_root(spark).rstrip('/')}/pairstats/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, in a folder of the application's own.

    Nothing is deleted here: the caller's result still reads from it. See ``written_tables`` and
    ``free_tables``.
    """
    folder = _runs[-1] if _runs else _application_folder(spark)
    return f"{folder}/{uuid.uuid4().hex}/{name}"


@contextlib.contextmanager
def written_tables(spark: SparkSession) -> Iterator[str]:
    """Tables written inside the block go with its end: take or write results before that."""
    folder = f"{_application_folder(spark)}/run-{uuid.uuid4().hex}"
    _runs.append(folder)
    try:
        yield folder
    finally:
        _runs.remove(folder)
        file_system(spark, folder).delete(_hadoop_path(spark, folder), True)


def free_tables(spark: SparkSession) -> None:
    """Delete all tables this application has written; results that read them are gone, too."""
    while _bucketed:
        spark.sql(f"DROP TABLE IF EXISTS {_bucketed.pop()}")
    folder = _application_folder(spark)
    file_system(spark, folder).delete(_hadoop_path(spark, folder), True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back.

    Later steps then read columns of a file instead of running the plan again, lost executors
    cost no more than the step at hand, and Spark knows the size of what it joins.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_buckets(df: DataFrame, keys: list[str], buckets: int, name: str) -> DataFrame:
    """``materialize``, as a table in buckets of ``keys``: later joins and sums by them need no shuffle.

    Rows go to their buckets before they are written, so that each bucket is one file. The table has
    a name of its own in the session's catalog, until ``free_tables``.
    """
    spark, path = df.sparkSession, stage_path(df.sparkSession, name)
    table = f"pairstats_{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    _bucketed.append(table)
    return spark.table(table)


def write_split(df: DataFrame, reason: str, path: str) -> None:
    """Write ``df`` in one pass, one folder for each value of ``reason``, rows without one under a
    folder of their own. The path must be new.

    There are few reasons, so a task writes all its folders at once and sorts no row. Rows of one folder are much
    alike, and all of them are written, so they are stored as what differs from the row before and compressed by zstd.
    """
    conf = df.sparkSession.conf
    kept = F.coalesce(F.col(reason), F.lit(KEPT))
    split = df.withColumn(reason, kept).write.mode("errorifexists").partitionBy(reason)
    before = conf.get(_WRITERS, None)
    conf.set(_WRITERS, str(WRITERS))
    try:
        split.options(**PACKED).parquet(path)
    finally:
        conf.unset(_WRITERS) if before is None else conf.set(_WRITERS, before)


def read_split(df: DataFrame, reason: str, path: str) -> tuple[DataFrame, DataFrame]:
    """What ``write_split`` wrote of ``df``: the rows without a reason, and the others with it.

    Each side reads its own folders.
    """
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    good = rows.where(F.col(reason) == KEPT).drop(reason)
    rejects = rows.where(F.col(reason) != KEPT)
    return good, rejects.select(*[c for c in df.columns if c != reason], reason)


def split_written(df: DataFrame, reason: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of ``df`` out of a single pass over it, in the shared folder."""
    path = stage_path(df.sparkSession, name)
    write_split(df, reason, path)
    return read_split(df, reason, path)


def write_stage(df: DataFrame, path: str) -> None:
    """Write a table of pairs for later use, one folder per period. The path must be new.

    Ranges over (period, w1, w2) give each task a few periods at most, hence few files, and let
    a large period span many tasks.
    """
    ordered = df.repartitionByRange(F.col("period"), F.col("w1"), F.col("w2"))
    ordered.write.mode("errorifexists").partitionBy("period").parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Read what ``write_stage`` wrote, with ``period`` in front."""
    df = spark.read.parquet(path)
    return df.select("period", *[c for c in df.columns if c != "period"])
