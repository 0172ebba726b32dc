"""Language-model scores: counts and word costs do not depend on bounds of memory."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from pairstats.llm import mixing


def test_many_counts_keep_their_ratio(spark):
    """300,000 words that begin with a and 100,000 that begin with b: three to one, not even odds."""
    words = spark.range(400_000).select(
        F.concat(F.unhex(F.lit("00")), F.when(F.col("id") % 4 == 0, "b").otherwise("a").cast("binary"),
                 F.col("id").cast("string").cast("binary")).alias("word"),
        F.lit(1).alias("c"),
    )
    first = (1 << 6) | (ord("a") >> 2)  # the six bits that a and b share
    n0, n1 = mixing.bit_tables(words)[1][(0x20 << 8) | first].astype(float)
    assert abs(n0 / n1 - 3) < 0.01


def test_counts_that_fit_stay():
    total = np.array([400_000, 70_000, 65_535, 1, 0, 65_536, 131_071, 131_071, 7, 9])
    got = mixing.fitted(total).reshape(-1, 2).astype(float)
    assert math.isclose(got[0, 0] / got[0, 1], 40 / 7, rel_tol=1e-3)
    assert got[1].tolist() == [65_535, 1] and got[4].tolist() == [7, 9]
    assert got[2, 0] == 0 and got[2, 1] == 32_768 and got[3, 0] == got[3, 1] > 60_000


def test_scores_do_not_depend_on_where_words_are_held(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * k * k) % 37} x{k % 5}" for k in range(60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    score = lambda: {
        r.doc_id: (r.score, r.base_score, r.n_known)
        for r in mixing.score_texts(docs, F.col("doc_id") % 3 != 1).collect()
    }
    want = score()
    monkeypatch.setattr(mixing, "FREQUENT", 1)
    got = score()
    assert all(np.allclose(got[i], want[i], rtol=1e-9, atol=0) for i in want)


def test_classes_come_from_all_texts(spark):
    """A second alphabet in 20 of 6,020 texts has a class of its own, however the table is dealt."""
    common = [(i, f"some plain english words number {i} and what follows them " * 3) for i in range(6000)]
    rare = [(9000 + i, f"ЖЩЮЯ ЖЮЩЯЮ ЯЩЖ ЮЖ {i} ЩЖЮЯ ЯЮ " * 3) for i in range(20)]
    docs = spark.createDataFrame(common + rare, "doc_id bigint, text string").withColumn("learn", F.lit(True))
    for parts in (1, 7):
        centres = mixing.find_classes(docs.repartition(parts, "doc_id"))
        assert len(centres) <= mixing.CLASSES and np.allclose(np.linalg.norm(centres, axis=1), 1)
        of = lambda t: int(np.argmax(centres @ mixing.letter_pairs(t.lower().encode())))  # noqa: E731, B023
        assert {of(t) for _, t in rare}.isdisjoint({of(t) for _, t in common})


def test_classes_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert mixing.find_classes(docs.withColumn("learn", F.lit(False))).shape == (1, mixing.PAIRS)


def test_letter_pairs_are_shares_of_hashed_pairs():
    raw = bytes(range(256)) * 3 + b"the end"
    want = np.zeros(mixing.PAIRS)
    for x, y in zip(raw, raw[1:]):
        want[(x * 167 + y * 31) % mixing.PAIRS] += 1
    assert np.allclose(mixing.letter_pairs(raw) ** 2, want / want.sum())


def test_order_by_digits():
    rng = np.random.default_rng(1)
    for top in (3, 70_000, 1 << 40):
        a, b = rng.integers(-1, top, 5000), rng.integers(-1, 4, 5000)
        assert (mixing._order(a, b) == np.lexsort((a, b))).all()


def test_numbers_of_words():
    """Words by class; white space is ASCII only; an end follows every text."""
    texts = ["A b c a", "", " \x0bB\x1c ", "x"]
    import pyarrow as pa

    centres = np.eye(2, mixing.PAIRS)
    keys, ids, text, sizes = mixing._numbered(pa.array(texts), centres)
    words = [[], [], [], []]
    for i, t in zip(ids, text):
        words[t].append(keys[i][1:])
    assert words == [[b"a", b"b\xc2\xa0c", b"a", b""], [b""], [b"b\x1c", b""], [b"x", b""]]
    assert sizes.tolist() == [len(t.encode()) for t in texts] and len(set(keys)) == len(keys)


def test_least_count_keeps_within_the_bound(spark):
    words = spark.range(1000).select((F.col("id") + 1).alias("c"))
    for most in (0, 1, 10, 500, 1000):
        least = mixing.least_count(words, most)
        kept = words.where(F.col("c") >= least).count()
        below = 2 ** (math.floor(math.log2(min(least, 1001)) * 8 - 1) / 8)  # where the next step begins
        assert kept <= most
        assert kept == 1000 or words.where(F.col("c") >= below - 1e-9).count() > most


def brute_states(words):
    """(state, hit) after two words and after one word at each place, by looking back."""
    out = []
    runs = {2: 0, 1: 0}
    for i, w in enumerate(words):
        guess = {}
        for k in (2, 1):
            context = words[i - k : i] if i >= k else None
            seen = [j for j in range(k, i) if context and words[j - k : j] == context]
            guess[k] = words[seen[-1]] if seen else None
        row = []
        for k in (2, 1):
            foretold = guess[k] is not None and not (k == 1 and guess[1] == guess[2])
            bucket = min(math.ceil(math.log2(runs[k] + 1)), mixing.RUNS - 1)
            row += [bucket + 1 if foretold else 0, foretold and guess[k] == w]
        for k in (2, 1):
            runs[k] = runs[k] + 1 if guess[k] == w else 0
        out.append(tuple(row))
    return out


def test_repeats_and_own_shares_beside_looking_back():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 5, n).tolist() for n in (1, 40, 200, 3)] + [[0, 1, 2] * 30]
    ids = np.concatenate([np.array(t) for t in texts])
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    s2, h2, s1, h1 = mixing.repeats(ids, text)
    weight, own = mixing.own_shares(ids, text)
    at = 0
    for t in texts:
        want = brute_states(t)
        got = [(int(s2[at + i]), bool(h2[at + i]), int(s1[at + i]), bool(h1[at + i])) for i in range(len(t))]
        assert got == want
        for i, w in enumerate(t):
            x = mixing.SHARE * i / (i + mixing.LATER)
            assert math.isclose(weight[at + i], x)
            assert math.isclose(own[at + i], x * max(t[:i].count(w) - mixing.LESS, 0) / max(i, 1))
        at += len(t)


def test_letter_pairs_of_texts_are_theirs_alone(monkeypatch):
    raws = [b"", b"a", b"ab", b"the end", b"", b"z" * 300, bytes(range(256))]
    monkeypatch.setattr(mixing, "PAIRED", 3)
    for some, raw in zip(mixing._letter_pairs(raws), raws, strict=True):
        want = np.zeros(mixing.PAIRS)
        for x, y in zip(raw, raw[1:]):
            want[(x * 167 + y * 31) % mixing.PAIRS] += 1
        want = want / want.sum() if len(raw) > 1 else np.full(mixing.PAIRS, 1 / mixing.PAIRS)
        assert np.allclose(some**2, want)


def test_words_counted_in_parts_add_up(spark, monkeypatch):
    """Few words held at once: counts passed on early lose none."""
    rows = [(" ".join(f"w{(i * k) % 50}" for k in range(40)), i % 3 > 0) for i in range(1200)]
    docs = spark.createDataFrame(rows, "text string, learn boolean").coalesce(1)
    centres = np.ones((1, mixing.PAIRS))
    want = {}
    for text, learn in rows:
        for w in [*text.split(), ""]:
            want[b"\0" + w.encode()] = want.get(b"\0" + w.encode(), 0) + learn
    counted = {}
    for most in (600_000, 10):
        monkeypatch.setattr(mixing, "COUNTED", most)
        found = mixing._counted(docs, centres).where("kind = 0").groupBy("word").agg(F.sum("c").alias("c"))
        counted[most] = {bytes(r.word): r.c for r in found.collect()}
    assert counted[10] == counted[600_000] == want
