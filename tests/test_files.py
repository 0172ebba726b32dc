from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pairstats import association_counts
from pairstats.functions.keys import NULL, field_text, text_field
from pairstats.operators.clean import clean_pairs, parse_ngram_lines, split_valid_written
from pairstats.sinks import stage
from pairstats.sinks.stage import materialize, read_stage, stage_path, stage_root, write_stage
from pairstats.sinks.text import write_pair_text, write_scored_text, write_top_k_report
from pairstats.sources import ngrams as sources
from pairstats.sources.scored import read_scored_text, split_scored_lines, split_scored_text
from registry import queries
from worked_example import REJECTED, kept_lines

SCHEMA = "period int, w1 string, w2 string, npmi double, rel_npmi double"
ROWS = [
    (1990, "new", "york", 0.75, 0.1),
    (1990, "Big", "idea", 1.0000000000000004, 0.2),
    (1990, "alpha", "beta", 0.75, -0.0001),
    (1520, "old", "town", -0.25, 12345678.9),
    (2000, "solo", "pair", 1e-05, 0.3),
]


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def part_lines(path):
    return [f.read_text().splitlines() for f in sorted(path.glob("part-*"))]


def test_text_sink_is_ranked_and_exact(spark, scored, tmp_path):
    path = tmp_path / "out"
    write_scored_text(scored.repartition(4), str(path))
    lines = [line for part in part_lines(path) for line in part]
    assert lines == [
        "1520 old town\t-0.25",
        "1990 Big idea\t1.0000000000000004",
        "1990 alpha beta\t0.75",
        "1990 new york\t0.75",
        "2000 solo pair\t1.0E-5",
    ]
    assert rows_of(read_scored_text(spark, str(path))) == rows_of(scored.drop("rel_npmi"))


def test_text_sink_with_more_values(spark, scored, tmp_path):
    path = str(tmp_path / "out")
    write_scored_text(scored, path, ["npmi", "rel_npmi"])
    values = {"npmi": "double", "rel_npmi": "double"}
    assert rows_of(read_scored_text(spark, path, values)) == rows_of(scored)


def test_pair_text_of_counts(spark, tmp_path):
    rows = [(1990, "new", "york", 15, 20), (1990, "big", "idea", 20, 20)]
    df = spark.createDataFrame(rows, "period int, w1 string, w2 string, c12 bigint, c1 bigint")
    write_pair_text(df, str(tmp_path / "out"), ["c12", "c1"])
    lines = sorted(line for part in part_lines(tmp_path / "out") for line in part)
    assert lines == ["1990 big idea\t20 20", "1990 new york\t15 20"]
    back = read_scored_text(spark, str(tmp_path / "out"), {"c12": "bigint", "c1": "bigint"})
    assert back.dtypes == df.dtypes and rows_of(back) == rows_of(df)


def test_stage_text_of_counts_is_readable(spark, tmp_path):
    path = tmp_path / "counts"
    path.mkdir()
    (path / "part-0").write_text("1990 new york\t15 20\n1990 big idea\t20 20\n1990 bad x\tNaN 7\n")
    got = rows_of(read_scored_text(spark, str(path), {"c12": "bigint", "c1": "bigint"}))
    assert got == [
        (1990, "bad", "x", None, 7),
        (1990, "big", "idea", 20, 20),
        (1990, "new", "york", 15, 20),
    ]


@pytest.mark.parametrize("write", [write_scored_text, write_stage, write_top_k_report])
def test_sinks_never_overwrite(scored, tmp_path, write):
    write(scored, str(tmp_path / "out"))
    with pytest.raises(AnalysisException):
        write(scored, str(tmp_path / "out"))


def test_top_k_report(spark, scored, tmp_path):
    write_top_k_report(scored, str(tmp_path / "report"), 2)
    lines = [line for part in part_lines(tmp_path / "report") for line in part]
    assert lines == [
        "",
        "1520 old town\t-0.25",
        "",
        "1990 Big idea\t1.0000000000000004",
        "1990 alpha beta\t0.75",
        "",
        "2000 solo pair\t1.0E-5",
    ]
    assert read_scored_text(spark, str(tmp_path / "report")).count() == 4


def test_stage_table_is_split_by_period(spark, scored, tmp_path):
    path = str(tmp_path / "stage")
    write_stage(scored, path)
    back = read_stage(spark, path)
    assert back.dtypes == scored.dtypes and rows_of(back) == rows_of(scored)
    one = back.where(F.col("period") == 1990)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan


def test_materialize_keeps_schema_and_rows(scored):
    back = materialize(scored, "scores")
    assert back.dtypes == scored.dtypes and rows_of(back) == rows_of(scored)


def test_written_tables_go_to_the_shared_folder(spark):
    root = stage_root(spark)
    assert stage_path(spark, "x").startswith(root.rstrip("/"))
    assert stage_path(spark, "x") != stage_path(spark, "x")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or root == configured


class Cluster:
    """As much of a session on a cluster as ``stage_root`` asks for."""

    class sparkContext:
        master, applicationId = "yarn", "app"

        @staticmethod
        def getCheckpointDir():
            return None

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_cluster_needs_a_shared_folder(monkeypatch):
    monkeypatch.setattr(stage, "is_local", lambda *_: False)
    with pytest.raises(ValueError):
        stage_root(Cluster(None))
    assert stage_root(Cluster("hdfs:///shared")) == "hdfs:///shared"


def write_sequence(spark, rows, path):
    # Keys above 32 bits, because smaller Python integers would be written as IntWritable.
    records = spark.sparkContext.parallelize([(2**32 + i, r) for i, r in enumerate(rows)], 3)
    records.saveAsNewAPIHadoopFile(
        path,
        "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        keyClass="org.apache.hadoop.io.LongWritable",
        valueClass="org.apache.hadoop.io.Text",
    )


def test_all_readers_give_the_same_facts(spark, tmp_path):
    text, sequence, parquet = (str(tmp_path / d) for d in ("text", "sequence", "parquet"))
    rows = kept_lines() + [line for line in REJECTED if "\n" not in line]
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(text)
    write_sequence(spark, rows, sequence)
    read = sources.read_ngrams_text(spark, text)
    assert rows_of(read) == rows_of(sources.read_ngrams_sequence(spark, sequence))
    names = ["ngram", "year", "match_count", "page_count", "volume_count"]
    read.where("numeric").select(*names).write.parquet(parquet)
    want = rows_of(clean_pairs(read, "english"))
    for source, path in (("text", text), ("sequence", sequence), ("parquet", parquet)):
        corpus = sources.read_corpus(spark, "english", {"english": path}, source)
        assert rows_of(clean_pairs(corpus, "english")) == want
    assert len(want) == len(kept_lines())


def test_sample_while_reading(spark, tmp_path):
    path = str(tmp_path / "lines")
    rows = spark.range(4000).selectExpr("concat('new york\t1990\t', id + 1, '\t1\t1') AS value")
    rows.write.text(path)
    half = sources.read_ngrams_text(spark, path, 0.5, seed=5)
    assert 1700 < half.count() < 2300
    plan = half.where("year = 1990")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Project") < plan.index("Sample") < plan.index("Relation")


def test_quote_is_a_plain_character(spark, tmp_path):
    path = tmp_path / "lines"
    path.mkdir()
    ngrams = ['" york', '"new york', "new york"]
    (path / "part-0").write_text("".join(f"{n}\t1991\t3\t1\t1\n" for n in ngrams))
    read = sources.read_ngrams_text(spark, str(path))
    assert sorted(r.ngram for r in read.collect()) == ngrams


def test_unknown_language(spark):
    with pytest.raises(ValueError):
        sources.read_corpus(spark, "latin", {"latin": "x"})
    with pytest.raises(ValueError):
        association_counts(spark.createDataFrame([], sources.NGRAM_SCHEMA), "latin")


def test_report_spans_files_and_reads_in_order(spark, settings, tmp_path, monkeypatch):
    settings(shuffle__partitions="4", adaptive__coalescePartitions__enabled="false")
    rows = spark.range(0, 200).select(
        (F.col("id") % 3 * 10).cast("int").alias("period"),
        F.lit("a").alias("w1"),
        F.concat(F.lit("w"), F.col("id").cast("string")).alias("w2"),
        (F.col("id") / 200).alias("npmi"),
    )
    write_top_k_report(rows, str(tmp_path / "report"), 50)
    parts = part_lines(tmp_path / "report")
    assert len(parts) > 1
    lines = [line for part in parts for line in part]
    assert len(lines) == 153 and lines.count("") == 3
    scores = [(line.split()[0], -float(line.split("\t")[1])) for line in lines if line]
    assert scores == sorted(scores, key=lambda x: (int(x[0]), x[1]))


def test_sequence_files_need_no_python_worker(spark, tmp_path):
    path = str(tmp_path / "seq")
    pairs = spark.sparkContext.parallelize([(2**33, "new york\t1991\t3\t1\t1"), (2**33 + 1, "x")], 2)
    pairs.saveAsNewAPIHadoopFile(
        path,
        "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        keyClass="org.apache.hadoop.io.LongWritable",
        valueClass="org.apache.hadoop.io.Text",
    )
    read = sources.read_ngrams_sequence(spark, path)
    lineage = read._jdf.queryExecution().toRdd().toDebugString()
    assert "PythonRDD[" not in lineage and "MapPartitionsRDD" in lineage
    assert sorted(r.ngram for r in read.collect()) == ["new york", "x"]


ODD = [
    (1990, "c", "d", None, 0.2),
    (None, "a", "b", 0.5, None),
    (1990, None, "b", None, None),
    (1990, "a b", "tab\there", 0.25, 1.0),
    (1990, "\\N", "\\s\\b", 0.5, 0.5),
    (1990, "line\nend\r", "back\\slash", -0.5, 0.5),
    (None, None, None, None, None),
    (1990, "", "empty", 1.0, 1.0),
]


def test_text_keeps_nulls_and_odd_characters(spark, tmp_path):
    """What is written in a line comes back: no NULL moves a column, no character ends a field."""
    df = spark.createDataFrame(ODD, SCHEMA)
    write_pair_text(df, str(tmp_path / "out"), ["npmi", "rel_npmi"])
    values = {"npmi": "double", "rel_npmi": "double"}
    assert rows_of(read_scored_text(spark, str(tmp_path / "out"), values)) == rows_of(df)
    lines = [line for part in part_lines(tmp_path / "out") for line in part]
    assert "1990 c d\t\\N 0.2" in lines and "\\N a b\t0.5 \\N" in lines
    words = df.select("period", "w1", "w2", F.concat_ws(" ", "w2", "w1").alias("npmi"))
    write_pair_text(words, str(tmp_path / "words"), ["npmi"])
    back = read_scored_text(spark, str(tmp_path / "words"), {"npmi": "string"})
    assert rows_of(back) == rows_of(words)


@given(st.text(alphabet="ab\\Nnstr \t\n\r\x00é", max_size=12))
@hypothesis_settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_fields_round_trip(spark, word):
    field = text_field(F.lit(word))
    there, back = spark.range(1).select(field, field_text(field)).first()
    assert back == word and there != NULL and not set(there) & set(" \t\n\r")


def test_scored_rejects(spark, tmp_path):
    path = tmp_path / "scored"
    path.mkdir()
    good = ["1990 new york\t15 0.5", "\\N new \\N\t\\N \\N", "1990 a\\sb c\t-3 1.0E-5"]
    bad = {
        "1990 new york": "few_fields",
        "1990 new\t1 2": "few_fields",
        "\t": "few_fields",
        "1990 new york city\t1 2": "many_fields",
        "1990 new york\t1 2\t3": "many_fields",
        "1990 new york\t1 2 3": "many_fields",
        "199x new york\t1 2": "bad_period",
        " new york\t1 2": "bad_period",
        "1990  york\t1 2": "empty_word",
        "1990 new \t1 2": "empty_word",
        "1990 new york\t1": "few_values",
        "1990 new york\t": "few_values",
        "1990 new york\tx 2": "bad_value",
        "1990 new york\t1 y": "bad_value",
        "1990 new york\t 2": "bad_value",
    }
    (path / "part-0").write_text("\n".join([*good, "", *bad, ""]))
    values = {"c12": "bigint", "npmi": "double"}
    kept, rejects = split_scored_text(spark, str(path), values)
    assert {r.value: r.reason for r in rejects.collect()} == bad
    assert rows_of(kept) == sorted(
        [(1990, "new", "york", 15, 0.5), (None, "new", None, None, None), (1990, "a b", "c", -3, 1e-05)],
        key=repr,
    )


def test_both_sides_of_a_split_are_written_by_one_read(spark):
    """Each line passes once, however often the two tables are used."""
    lines = [f"1990 a w{i}\t{'x' if i % 3 else i}" for i in range(90)]
    seen = spark.sparkContext.accumulator(0)

    def count(row):
        seen.add(1)
        return row

    rdd = spark.sparkContext.parallelize([(line,) for line in lines], 4).map(count)
    kept, rejects = split_scored_lines(spark.createDataFrame(rdd, "value string"))
    assert (kept.count(), rejects.count(), kept.count()) == (30, 60, 30)
    assert seen.value == 90


def test_split_of_nothing(spark):
    df = spark.createDataFrame([], "value string, reason string")
    good, rejects = stage.split_written(df, "reason", "t")
    assert good.collect() == rejects.collect() == []
    assert good.columns == ["value"] and rejects.columns == ["value", "reason"]


def test_buckets_are_written_and_freed(spark):
    df = spark.range(1000).select((F.col("id") % 5).alias("a"), F.col("id").alias("b"))
    table = stage.materialize_buckets(df, ["a"], 4, "t")
    assert rows_of(table) == rows_of(df)
    name = stage._bucketed[-1]
    assert name in [t.name for t in spark.catalog.listTables()]
    stage.free_tables(spark)
    assert name not in [t.name for t in spark.catalog.listTables()] and stage._bucketed == []


def test_written_tables_can_be_freed(spark, tmp_path):
    df = spark.range(3)
    before = spark.sparkContext.getCheckpointDir()
    with stage.written_tables(spark) as folder:
        inside = stage.stage_path(spark, "t")
        assert inside.startswith(folder)
        assert materialize(df, "t").count() == 3
    assert not stage.file_system(spark, folder).exists(stage._hadoop_path(spark, folder))
    assert spark.sparkContext.getCheckpointDir() == before  # the caller's, untouched


def test_folder_of_one_machine_is_refused(spark, monkeypatch):
    class Context:
        master, applicationId, defaultParallelism = "spark://host:7077", "app", 2
        _jvm, _jsc = spark.sparkContext._jvm, spark.sparkContext._jsc

        def parallelize(self, *args):
            return self

        def map(self, _):
            return self

        def collect(self):
            return self.seen

    class Session:
        sparkContext = Context()

    Context.seen = [True, False]
    assert stage.is_local(spark, "/tmp/x") and stage.is_local(spark, "file:/tmp/x")
    with pytest.raises(ValueError):
        stage._check_shared(Session, "/tmp/pairstats-test-shared")
    Context.seen = [True, True]
    stage._check_shared(Session, "/tmp/pairstats-test-shared")


def test_delivered_order_holds_no_file_in_a_row(spark, settings, monkeypatch, tmp_path):
    """Places hold over several blocks of a file, and no row is as large as a part file."""
    settings(files__maxPartitionBytes="200", files__openCostInBytes="1")
    rows = [(1900 + k % 3 * 10, f"w{k:03d}", "v\rx", (k * 7 % 11) / 8, 0.0) for k in range(120)]
    scores = spark.createDataFrame(rows, SCHEMA)
    written = []

    def spy(df, name):
        out = materialize(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(queries, "document_scores", lambda *_: scores)
    monkeypatch.setattr(queries, "materialize", spy)
    found = sorted(tuple(r) for r in queries.delivered_order(spark, "").collect())
    ranked = sorted(rows, key=lambda r: (r[0], -r[3], r[1]))
    assert found == [(k, *r[:4]) for k, r in enumerate(ranked, start=1)]
    assert written == [len(rows)]


def test_a_split_sorts_no_row(spark, settings, monkeypatch):
    """A task writes all folders at once; only the columns asked for are written."""
    settings(maxConcurrentOutputFileWriters="0")
    writer, seen = type(spark.range(0).write), []
    plain = writer.parquet

    def spy(self, path, *more):
        seen.append(spark.conf.get(stage._WRITERS))
        return plain(self, path, *more)

    monkeypatch.setattr(writer, "parquet", spy)
    rows = [(f"w{k} v\t1991\t{k % 3}\t1\t1",) for k in range(60)]
    lines = parse_ngram_lines(spark.createDataFrame(rows, "line string"))
    good, rejects = split_valid_written(lines, "english", keep=["line"])
    assert good.columns == ["line"] and rejects.columns == ["line", "reason"]
    assert good.count() + rejects.count() == 60
    assert seen == [str(stage.WRITERS)] and spark.conf.get(stage._WRITERS) == "0"


def test_scored_lines_are_written_in_two_parts_and_whole_again(spark, monkeypatch):
    """Any bytes come back as they were; what is written takes little more than its words."""
    from pairstats.sources import scored

    written = []
    split = scored.split_written
    monkeypatch.setattr(scored, "split_written", lambda df, *x: written.append(df.columns) or split(df, *x))
    bad = [b"\t", b"a", b"a\t\t", b"\ta\t b", b" ", b"x\xe2\ty \xe2\x82\t\xff", "€\tא ב".encode(), b"1 a b\tx"]
    lines = spark.createDataFrame([(x,) for x in [*bad, b"", b"1990 a b\xe2\t5", None]], "b binary")
    kept, rejects = split_scored_lines(lines.select(F.expr("cast(b AS string)").alias("value")), {"n": "bigint"})
    assert written == [["_first", "_rest", "reason"]]
    got = rejects.selectExpr("cast(value AS binary) AS b", "reason").collect()
    assert sorted(bytes(r.b) for r in got) == sorted(bad) and all(r.reason for r in got)
    assert rejects.columns == ["value", "reason"] and kept.select("period", "n").collect() == [(1990, 5)]
