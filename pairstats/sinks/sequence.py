"""Sequence files ``<LongWritable, Text>``."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark import RDD
from pyspark.serializers import AutoBatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame

#: Records that the JVM passes on at once.
BATCH = 1000


def _records(numbered: DataFrame) -> RDD:
    """(number, line) of the rows, as the RDD that the writer takes.

    By way of the session's own calls, as when such files are read, which leave out the Python workers. Where
    a Spark version has other ones, the rows pass through Python.
    """
    context = numbered.sparkSession.sparkContext
    try:
        encoders = context._jvm.org.apache.spark.sql.Encoders
        kind = encoders.tuple(encoders.LONG(), encoders.STRING())
        pairs = getattr(numbered._jdf, "as")(kind).rdd()
        records = context._jvm.org.apache.spark.api.python.SerDeUtil.pairRDDToPython(pairs, BATCH)
        return RDD(records.toJavaRDD(), context, AutoBatchedSerializer(CPickleSerializer()))
    except (AttributeError, TypeError, Py4JError):
        return numbered.rdd.map(tuple)


def write_numbered_sequence(numbered: DataFrame, path: str) -> None:
    """Write rows (number, line) as records. The path must be new.

    Numbers must be beyond 32 bits, because smaller ones would be written as IntWritable.
    """
    _records(numbered).saveAsNewAPIHadoopFile(
        path,
        "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        keyClass="org.apache.hadoop.io.LongWritable",
        valueClass="org.apache.hadoop.io.Text",
    )
