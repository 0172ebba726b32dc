"""Every operator on null ids and texts, empty and long texts, repeated rows, empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pairstats.llm.caps import near_vectors
from pairstats.llm.common import fold_of, texts_of, wrapped
from pairstats.llm.compression import score_quality
from pairstats.llm.minhash import near_duplicates
from pairstats.llm.mixing import score_texts
from pairstats.llm.packing import pack_documents
from pairstats.llm.pieces import encoded_digests
from pairstats.llm.pii import digest_personal_data, mask_personal_data
from pairstats.llm.quality_rules import apply_quality_rules, keep_good
from pairstats.llm.toxicity import score_toxicity
from pairstats.llm.trie_counts import token_counts



def learn():
    return fold_of("doc_id", 3) != 1


BY_DOCUMENT = {
    "toxicity": lambda d, x: score_toxicity(texts_of(d), x, learn()),
    "trie": lambda d, x: token_counts(d),
    "minhash": lambda d, x: near_duplicates(d),
    "mixing": lambda d, x: score_texts(d, fold_of("doc_id", 7) != 2),
    "compression": lambda d, x: score_quality(texts_of(d), x, learn()),
    "rules": lambda d, x: apply_quality_rules(d, x),
    "pii": lambda d, x: digest_personal_data(d),
    "pieces": lambda d, x: encoded_digests(d),
}


@pytest.mark.parametrize("name", sorted(BY_DOCUMENT))
def test_one_row_for_each_row(spark, odd, labels, name):
    rows = BY_DOCUMENT[name](odd, labels).collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted(
        (r.doc_id for r in odd.select("doc_id").collect()), key=str
    )
    # Repeated rows get the same result.
    twice = [tuple(r) for r in rows if r.doc_id == 2]
    assert len(twice) == 2 and twice[0] == twice[1]
    for row in rows:
        if "score" in row.asDict():
            assert row.score is not None and row.score == row.score


@pytest.mark.parametrize("name", sorted(BY_DOCUMENT))
def test_empty_table(empty, no_labels, name):
    assert BY_DOCUMENT[name](empty, no_labels).collect() == []


def test_scores_without_labels_are_in_range(odd, no_labels):
    for score in (score_toxicity, score_quality):
        rows = score(texts_of(odd), no_labels, learn()).collect()
        assert all(0 <= r.score <= 1 for r in rows)


def test_whole_documents_keep_their_columns(odd, no_labels, empty):
    """What the pipeline does with rows: other columns, clashing names too, come back unchanged."""
    scored = score_toxicity(wrapped(odd), no_labels, learn()).select("_doc.*")
    assert scored.schema == odd.schema and scored.count() == odd.count()
    good = keep_good(odd, no_labels)
    assert good.columns == odd.columns and {r.doc_id for r in good.collect()} <= {7}
    masked = mask_personal_data(odd).select(odd.columns)
    assert masked.schema == odd.schema
    text = {r.doc_id: r.text for r in masked.where("doc_id IS NOT NULL").collect()}
    assert text[9] == "write to [EMAIL] or [PHONE] from [IP]" and text[3] is None
    assert mask_personal_data(empty).collect() == []


def test_packing(odd, empty):
    rows = pack_documents(odd).collect()
    assert len({r.sequence_id for r in rows}) >= 1 and pack_documents(empty).collect() == []
    assert sum(r.doc_id == 2 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 2
    lone = [r for r in rows if r.doc_id in (3, 4)]
    assert [(r.piece, r.start, r.length) for r in lone] == [(0, 0, 1)] * 2  # the end alone


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0]),
        (4, [0.9, 0.1, 0.0]), (5, None), (6, []), (7, [0.0, 0.0, 0.0]), (8, [nan, 1.0, 0.0]),
        (9, [inf, 1.0, 0.0]), (10, [None, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (11, [1.0, 0.0]),
        (12, [1e300, 0.0, 0.0]), (13, [-1.0, 0.0, 0.0]),
    ]
    schema = "vec_id bigint, embedding array<double>, label int, node int, size int"
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema)
    got = [tuple(r) for r in near_vectors(df).orderBy("vec_id").collect()]
    linked = [(i, 4, 1, i == 1) for i in (1, 2, 3, 3, 4, 12)]
    alone = [(i, 0, i, True) for i in (5, 6, 7, 8, 9, 10, 11, 13)]
    assert sorted(got[1:]) == sorted(linked + alone) and got[0] == (None, 0, None, True)
    assert near_vectors(df.where(F.lit(False))).collect() == []
