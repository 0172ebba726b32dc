"""Memory of counting phrases."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from pairstats.llm import phrases


def _peak(run) -> int:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_merging_takes_few_phrases_apart():
    names = [b"w%d" % i for i in range(600)]
    first, second = np.divmod(np.arange(18_000), 600)
    packed = [
        phrases._pack(np.stack([first + 1, second + 1, np.full(18_000, k + 1)]), np.full(18_000, 2), names)
        for k in range(40)
    ]
    table = pa.table(
        {
            "lang": ["en"] * 40,
            **{c: pa.array([p[i] for p in packed], pa.binary()) for i, c in enumerate(("words", "ids", "counts"))},
        }
    )
    merge = phrases._merger(10)
    found = {}
    # 40 runs of 18,000: codes and counts, in the order found and sorted, and the order.
    peak = _peak(lambda: found.update(out=merge(table)))
    assert found["out"].to_pylist() == [{"lang": "en", "phrase": None, "size": 0, "f": 0}]
    assert peak < 50 * 720_000


def test_spilling_frees_tables_as_they_come():
    names = [b"", *(b"w%d" % i for i in range(1000))]
    rng = np.random.default_rng(3)
    trie = phrases.Trie()
    ids = rng.integers(1, 1001, (3, 1_200_000))
    tracemalloc.start()
    try:
        trie.add(ids[0] << 2 * phrases.BITS | ids[1] << phrases.BITS | ids[2])
        entries = len(trie)
        held = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        rows = [r[2] for r in phrases._runs(trie, names, [0] * len(names), 64)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(rows) == entries
    assert peak < held + 8 * entries
