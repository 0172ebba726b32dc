"""Near-duplicates of texts and vectors against brute force; connected components."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from pairstats.llm import caps, minhash
from pairstats.llm.graph import blocks, components


def united(ids, links):
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(1, x) for x in range(2, 60)] + [(7, 7)]
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    rng.shuffle(links)
    df = spark.createDataFrame([*links, (None, 5), (6, None)], "a bigint, b bigint")
    got = {r.id: r.component for r in components(df).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == united({x for pair in real for x in pair}, real)
    assert components(df.where("a = -1")).collect() == []


def test_blocks_bring_all_pairs_together(spark):
    rows = spark.range(0, 300).selectExpr("id AS node", "CASE WHEN id < 250 THEN 1 ELSE id END AS k")
    dealt = blocks(rows, "k", "node", 40).collect()
    groups = defaultdict(set)
    for r in dealt:
        groups[r.k, r.left, r.right].add((r.node, r.own))
    assert max(map(len, groups.values())) < 160
    met = set()
    for (_, left, right), members in groups.items():
        for x, own in members:
            assert own in (left, right)
            met.update((x, y) for y, _ in members)
    assert met >= {(x, y) for x in range(250) for y in range(250)}


def shingle_set(text, width):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    if not words:
        return set()
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))}


def brute(texts, width):
    sets = {i: shingle_set(t or "", width) for i, t in texts.items()}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[:k]
        if sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return sets, united(ids, links)


@pytest.fixture(scope="module")
def copies():
    """Groups of near copies about the threshold, exact copies, and a chain of small changes."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts, at = {}, 0
    for _ in range(12):
        base = [word() for _ in range(60)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(60)] = word()
            texts[at] = " ".join(copy)
            at += 1
    for _ in range(40):
        texts[at] = "the same text of eight words for all"
        at += 1
    chain = [word() for _ in range(50)]
    for _ in range(30):
        chain = [*chain[2:], word(), word()]
        texts[at] = " ".join(chain)
        at += 1
    texts[at], texts[at + 1], texts[at + 2] = "ONE two", "one TWO", "one two three"
    return texts


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_equal_brute_force(spark, copies, width):
    df = spark.createDataFrame(list(copies.items()), "doc_id bigint, text string").repartition(5)
    sets, want = brute(copies, width)
    for r in minhash.near_duplicates(df, width).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])
        assert r.kept == (want[r.doc_id] == r.doc_id)


def test_blocks_alone_find_every_link(spark, copies, monkeypatch):
    """Small blocks, and no pairs from the two stars: the third step must find all."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "_star", lambda members, largest: members.selectExpr(
        "node AS a", "node AS b").where("a < 0"))
    df = spark.createDataFrame(list(copies.items()), "doc_id bigint, text string")
    _, want = brute(copies, 4)
    assert all(r.component_id == want[r.doc_id] for r in minhash.near_duplicates(df).collect())


def test_documents(documents, texts):
    _, want = brute(texts, 4)
    assert all(r.component_id == want[r.doc_id] for r in minhash.near_duplicates(documents).collect())


def test_rows_of_one_id_are_linked(spark):
    a, b = ("w x y z " * 3).strip(), "k l m n o p q r s"
    df = spark.createDataFrame([(5, a), (5, b), (6, a), (7, b), (8, "other text here now")],
                               "doc_id bigint, text string")
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == {(5, 5), (6, 5), (7, 5), (8, 8)}


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((150, 32))
    rows = []
    for k, v in enumerate(base):
        for _ in range(8 if k else 120):
            noise = rng.standard_normal(32) * rng.choice([0.05, 0.25, 0.33, 0.4])
            rows.append(v + noise * np.linalg.norm(v) / np.sqrt(32))
    rows += [rows[3]] * 30
    x = np.array(rows)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    df = spark.createDataFrame(
        [(i, r.tolist()) for i, r in enumerate(rows)], "vec_id bigint, embedding array<double>"
    ).repartition(5)
    got = {r.vec_id: r for r in caps.near_vectors(df).collect()}
    true = int((close.sum() - len(x)) // 2)
    ours = sum(r.n_links for r in got.values()) // 2
    assert true > 5000 and 0.99 * true <= ours <= true
    want = united(range(len(x)), [(a, b) for a, b in zip(*np.nonzero(np.triu(close, 1)), strict=True)])
    assert sum(got[i].component_id == want[i] for i in got) >= 0.99 * len(x)


def test_list_decoding_finds_all_exceeding_directions():
    code = caps.ProductCode(20, 5, 40, 1)
    rng = np.random.default_rng(2)
    unit = rng.standard_normal((20, 20))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    turned = (unit @ code.turn).reshape(20, code.parts, -1)
    sums = np.einsum("npw,pkw->npk", turned, code.codes)
    every = sums[:, 0]
    for part in range(1, code.parts):
        every = (every[:, :, None] + sums[:, part][:, None, :]).reshape(20, -1)
    for found, values in zip(code.passed(unit), every, strict=True):
        want = set(np.flatnonzero(values >= code.threshold)) or {int(values.argmax())}
        assert set(found.tolist()) == want


@pytest.mark.parametrize("n", [2_000, 100_000, 1_000_000, 10_000_000])
def test_pairs_at_the_threshold_share_a_filter_at_any_size(n):
    words, codes = caps.codes_for(64, n)
    for cosine in (0.9, 0.92):
        left, right = caps.random_pairs(64, 500, cosine, 99)
        hit = np.zeros(500, bool)
        for seed in range(codes):
            code = caps.ProductCode(64, words, caps.FILTERS, seed)
            some = np.flatnonzero(~hit)
            if len(some):
                hit[some] = caps.shared_filter(code, left[some], right[some])
        assert hit.mean() >= 0.99


def test_cap_threshold_is_exact():
    """On the sphere in three dimensions the share of a cap is (1 - height) / 2."""
    for share in (0.5, 0.1, 1e-3, 1e-6):
        assert abs(caps.cap_threshold(3, share) - (1 - 2 * share)) < 1e-9
    x = np.random.default_rng(5).standard_normal((400_000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert abs((x[:, 0] > caps.cap_threshold(16, 0.01)).mean() - 0.01) < 1e-3


def test_all_texts_and_vectors_of_one_id_are_linked(spark):
    a, b, c = "a b c d e f g", "k l m n o p q", "r s t u v w x"
    df = spark.createDataFrame([(5, a), (5, b), (5, c), (1, a), (3, b), (7, b)], "doc_id bigint, text string")
    assert {r.component_id for r in minhash.near_duplicates(df).collect()} == {1}
    x, y, z = np.eye(3).tolist()
    df = spark.createDataFrame([(5, x), (5, y), (5, z), (1, x), (3, y), (7, y)],
                               "vec_id bigint, embedding array<double>")
    assert {r.component_id for r in caps.near_vectors(df).collect()} == {1}


@pytest.mark.parametrize("dimensions", [1, 2, 64, 768, 4096])
def test_rounding_to_bytes_loses_no_pair(dimensions):
    """Pairs at exactly the threshold, also with a few components far above all others."""
    for heavy in (0, 3):
        left, right = caps.random_pairs(dimensions, 200, caps.COSINE, 7)
        if heavy and dimensions > 8:
            rng = np.random.default_rng(3)
            left, right = left.copy(), right.copy()
            left[:, :heavy] = right[:, :heavy] = rng.standard_normal((200, heavy)) * 20
            left, right = caps._units(left), caps._units(right)
        rows = lambda x: np.frombuffer(b"".join(caps.rounded(x)), np.int8).reshape(len(x), -1)
        found = set(zip(*(k.tolist() for k in caps.close(rows(left), rows(right)))))
        want = np.argwhere(left @ right.T >= caps.COSINE - 1e-9)
        assert {tuple(k) for k in want.tolist()} <= found and len(want)
        # Rounding adds few pairs: none of two unrelated vectors.
        if dimensions >= 64 and not heavy:
            assert len(found) == 200


@pytest.mark.parametrize("dimensions", [300, 2000])
def test_long_vectors_equal_brute_force(spark, dimensions):
    """Links on both sides of the threshold, copies scaled by any factor, more than one batch's lengths."""
    left, right = caps.random_pairs(dimensions, 40, caps.COSINE + 1e-6, 11)
    _, under = caps.random_pairs(dimensions, 40, caps.COSINE - 1e-6, 11)
    vectors = np.concatenate([left, right * 1e-9, under * 1e9])
    df = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>"
    )
    units = caps._units(vectors)
    linked = units @ units.T >= caps.COSINE
    got = {r.vec_id: r.n_links for r in caps.near_vectors(df).collect()}
    assert got == {i: int(linked[i].sum()) - 1 for i in range(len(vectors))}
