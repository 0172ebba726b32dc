"""Steps of the registered queries that grow with the corpus."""

from __future__ import annotations

from pathlib import Path

from pyspark.core.rdd import PipelinedRDD

from pairstats.sinks import sequence, stage
from pairstats.sources.ngrams import read_ngrams_sequence
from registry import queries

LINES = [
    (2**32, "red fox\t1901\t3\t2\t1"),
    (2**32 + 1, ""),
    (2**40, "שלום €\U0001f600\t1902\t4\t2\t1"),
    (2**62, "a\\b c\t1\t1\t1"),
]


def test_sequence_is_written_without_python_workers(spark, tmp_path):
    numbered = spark.createDataFrame(LINES, "number bigint, line string")
    assert not isinstance(sequence._records(numbered), PipelinedRDD)
    sequence.write_numbered_sequence(numbered, str(tmp_path / "lines"))
    records = spark.sparkContext.sequenceFile(
        str(tmp_path / "lines"), "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text"
    )
    assert sorted(records.collect()) == LINES
    back = read_ngrams_sequence(spark, str(tmp_path / "lines"))
    assert sorted(r["line"] for r in back.collect()) == sorted(line for _, line in LINES)


def test_empty_sequence(spark, tmp_path):
    sequence.write_numbered_sequence(spark.createDataFrame([], "number bigint, line string"), str(tmp_path / "no"))
    assert read_ngrams_sequence(spark, str(tmp_path / "no")).count() == 0


def test_split_is_compressed_by_zstd(spark, tmp_path):
    df = spark.createDataFrame([("x", None), ("y", "bad"), (None, "bad")], "value string, reason string")
    stage.write_split(df, "reason", str(tmp_path / "split"))
    files = list(Path(tmp_path / "split").rglob("*.parquet"))
    assert files and all(".zstd." in f.name for f in files)
    good, rejects = stage.read_split(df, "reason", str(tmp_path / "split"))
    assert [tuple(r) for r in good.collect()] == [("x",)]
    assert sorted((tuple(r) for r in rejects.collect()), key=str) == [("y", "bad"), (None, "bad")]


def test_row_sample_joins_nothing(spark, tmp_path):
    rows = [(i, "en", "one two one two three") for i in range(2000)] + [(None, None, "a b"), (1, "en", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.row_sample(spark, str(tmp_path))
    assert "Join" not in found._jdf.queryExecution().toString()
    assert [tuple(r) for r in found.collect()] == [(8001, True, True)]


def test_row_sample_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r) for r in queries.row_sample(spark, str(tmp_path)).collect()] == [(None, None, None)]


def test_facts_join_words_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "en", "red fox jumps")], "doc_id bigint, lang string, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    pairs = queries.clean.clean_pairs(queries.document_ngrams(spark, str(tmp_path)), "english")
    assert pairs._jdf.queryExecution().optimizedPlan().toString().count("concat_ws(") == 1
    assert sorted(tuple(r) for r in pairs.collect()) == [(1900, "fox", "jumps", 1), (1900, "red", "fox", 1)]
