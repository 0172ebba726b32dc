"""The pipeline's stages and the registered queries."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registered
import corpus_pipeline
from check import TABLES, digest
from pairstats.llm.oracle import ORACLE

SMALL = "/root/testdata/sf0.001"
NAMES = [f"op{n}_" for n in range(1, 11)]


def test_every_operator_has_one_query():
    for start in NAMES:
        assert len([q for q in registered.queries() if q.startswith(start)]) == 1
    assert "pipeline" in registered.queries() and set(ORACLE) <= set(registered.queries())
    assert "pipeline" not in registered.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, documents, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    frame = registered.queries()[name](spark, SMALL)
    columns = sorted(frame.columns)
    result = duck.execute(ORACLE[name])
    order = [c[0] for c in result.description]
    assert sorted(order) == columns
    theirs = [tuple(row[order.index(c)] for c in columns) for row in result.fetchall()]
    assert digest([tuple(r) for r in frame.select(*columns).collect()]) == digest(theirs)


def test_stages(spark, documents):
    """Each stage takes what the one before kept; all but the last return the same columns."""
    docs = documents.unionByName(documents.limit(5))  # repeated rows
    docs = docs.unionByName(spark.createDataFrame([(None, None, "en", "x", 0)], docs.schema))
    docs = docs.repartition(3)
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        docs = corpus_pipeline.materialize(docs, name)
        assert docs.columns == documents.columns and docs.dtypes == documents.dtypes
        seen.append(docs.count())
        if name == "near_duplicates":
            ids = [r.doc_id for r in docs.select("doc_id").collect()]
            assert len(set(ids)) == len(ids)
    assert seen == sorted(seen, reverse=True) and seen[-1] > seen[0] // 2
    packed = corpus_pipeline.packing(spark, docs, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(ids)
    bad = docs.where("text RLIKE '@mail[0-9].example.com'").count()
    assert bad == 0 and docs.where("n_chars <> char_length(text)").count() == 0


def test_empty_corpus(spark, documents):
    docs = documents.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), name)
        assert docs.count() == 0
