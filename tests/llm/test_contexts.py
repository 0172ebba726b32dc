"""Bit predictors with contexts across words: what words follow matters, counts and sums beside brute force."""

from __future__ import annotations

import collections
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pairstats.llm import contexts, mixing


def trained(texts, rounds=3):
    """(mixer, hashes of the words by text) of texts of one class."""
    words = [contexts.hashed_words([t])[0] for t in texts]
    tables, counts = contexts.empty_counts(), np.zeros((1, contexts.LEAVES))
    for w in words:
        none = np.zeros(len(w), np.int64)
        contexts.count(tables, contexts.hashed_contexts(w, none, none), w)
        counts[0] += np.bincount(contexts.leaf(w, none), minlength=contexts.LEAVES)
    mixer = contexts.ContextMixer([contexts.eight_bits(t) for t in tables], *contexts.share_tree(counts, 0.05))
    for _ in range(rounds):
        for w in words:
            none = np.zeros(len(w), np.int64)
            mixer.learn(contexts.hashed_contexts(w, none, none), w, none)
    return mixer, words


def test_words_that_followed_others_cost_less_after_them(spark):
    """The same words once each, in the order that training texts show and turned around."""
    names = [f"{a}{b}" for a in ("red", "old", "big", "dry") for b in ("fox", "hat", "sea")]
    after = {w: names[(i * 5 + 1) % len(names)] for i, w in enumerate(names)}
    chain = [names[0]]
    while after[chain[-1]] not in chain:
        chain.append(after[chain[-1]])
    rows = [(3 * i, " ".join(chain[i % 7 : i % 7 + 6])) for i in range(300)]
    rows += [(1, " ".join(chain)), (4, " ".join(chain[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in mixing.score_texts(docs, F.col("doc_id") % 3 != 1).collect()}
    assert math.isclose(got[1].base_score, got[4].base_score)
    assert got[1].score > got[4].score + 2


def test_every_occurrence_is_counted(spark):
    """The first bit of each code after one word, beside a count of all adjacent words."""
    texts = [" ".join(f"w{(i * k) % 7}" for k in range(1, 30)) for i in range(40)]
    docs = spark.createDataFrame([(t, True) for t in texts] + [("w1 w2", False)], "text string, learn boolean")
    centres = np.ones((1, mixing.PAIRS))
    for parts in (1, 3):
        tables, leaves = mixing.context_tables(docs.repartition(parts), centres)
        want, times = collections.Counter(), collections.Counter()
        for t in texts:
            word, text = contexts.hashed_words([t.encode()])
            before = contexts.hashed_contexts(word, np.zeros(len(word), np.int64), text)
            _, bit, _, slots = next(contexts.code_bits(before, word))
            times.update((word % contexts.LEAVES).tolist())
            want.update((int(s), int(b)) for s, b in zip(slots[0], bit))
        assert leaves.tolist() == [[times[i] for i in range(contexts.LEAVES)]]
        for slot, n in {s: (want[s, 0], want[s, 1]) for s, _ in want}.items():
            n = contexts.eight_bits(np.array([n[0] + (n[1] << 32)]))
            assert tables[0][slot] == n[0]


def test_probabilities_of_all_codes_add_up():
    """After any words the codes' probabilities sum to 1, with a text's own weights as without."""
    mixer, words = trained([b"the cat sat on the mat and the dog sat on the log " * 4] * 5)
    for n in (0, 1, 5, 150):
        some = np.tile(words[0], 3)[:n]
        total = 0.0
        for code in range(contexts.LEAVES):
            text = np.append(some, np.uint32(code)).astype(np.uint32)
            none = np.zeros(len(text), np.int64)
            ratio = mixer.ratios(contexts.hashed_contexts(text, none, none), text, none, none)[-1]
            total += math.exp(ratio + mixer.leaves[0, code])
        assert abs(total - 1) < 1e-4


def test_texts_are_scored_alone():
    """What is scored beside a text changes nothing, in whichever place it comes."""
    mixer, words = trained([b"a b c d e f g " * 40, b"a c b d f e " * 30])

    def score(*some):
        word = np.concatenate(some)
        text = np.repeat(np.arange(len(some)) * 3, [len(x) for x in some])
        none = np.zeros(len(word), np.int64)
        return mixer.ratios(contexts.hashed_contexts(word, none, text), word, none, text)

    alone = score(words[0])
    assert np.allclose(score(words[1], words[0], words[1])[len(words[1]) :][: len(alone)], alone, atol=1e-5)


def test_words_are_hashed_alike():
    texts = ["A b c a", "", " \x0bB\x1c ", "x", "the end "]
    centres = np.eye(2, mixing.PAIRS)
    keys, ids, text, _ = mixing._numbered(pa.array(texts), centres)
    word, of = contexts.hashed_words(mixing._raw(pa.array(texts)))
    assert of.tolist() == text.tolist() and word.tolist() == contexts.key_hashes(keys)[ids].tolist()
    assert contexts.hashed_words([])[0].tolist() == contexts.key_hashes([]).tolist() == []
    assert len(set(word.tolist())) == len({keys[i][1:] for i in ids})


def test_counts_travel_whole():
    counts = np.array([0, 1, 300 << 32, (70_000 << 32) + 140_000, 255], np.int64)
    assert contexts.unpacked(contexts.packed(counts), 5, np.int64).tolist() == counts.tolist()
    small = contexts.eight_bits(counts)
    assert small[:3].tolist() == [0, 256, 150] and small[4] == 255 << 8
    assert abs((small[3] >> 8) / (small[3] & 255) - 2) < 0.02


def test_blocks_are_counted_and_fetched_once():
    """One step for four bits counts every slot, and a block's counts are those of its slots."""
    rng = np.random.default_rng(2)
    word = rng.integers(0, 1 << 32, 3000, np.uint32)
    word[::3] = word[0]
    none = np.zeros(len(word), np.int64)
    before = contexts.hashed_contexts(word, none, none)
    blocks = contexts.empty_counts()
    contexts.count_codes(blocks, before[:], word)
    tables = [contexts.slot_counts(b) for b in blocks]
    want = [collections.Counter() for _ in tables]
    for _, bit, _, slots in contexts.code_bits(before, word):
        for n, s in zip(want, slots, strict=True):
            n.update((int(i), int(b)) for i, b in zip(s, bit, strict=True))
    for table, n in zip(tables, want, strict=True):
        assert table.nonzero()[0].tolist() == sorted({s for s, _ in n})
        assert all(table[s] == n[s, 0] + (n[s, 1] << 32) for s, _ in n)
    pairs = zip(contexts.code_bits(before, word), contexts.counted_bits(tables, before, word), strict=True)
    for (k, bit, node, slots), (k2, bit2, node2, counts) in pairs:
        assert k == k2 and (bit == bit2).all() and (node == node2).all()
        assert all((t[s] == c).all() for t, s, c in zip(tables, slots, counts, strict=True))


def test_words_are_cut_as_python_cuts_them():
    for raws in ([], [b""], [b" ", b"", b"a"], [b"\ta  b\n", b"c", b"\x0b\x0c\r", b"\x08d\x0e e\x1c "]):
        flat, _, starts, ends, text = contexts.cut_words(raws)
        got = [(t, flat[s:e].tobytes()) for t, s, e in zip(text.tolist(), starts, ends, strict=True)]
        assert got == [(i, w) for i, raw in enumerate(raws) for w in raw.split()]
