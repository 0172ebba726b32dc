"""Texts as sequences of chunks that a tokenizer treats apart, each distinct one handled once."""

from __future__ import annotations

import contextlib
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np

#: Distinct chunks kept in memory by a task; beyond that it starts afresh.
KEPT = 300_000

#: White space other than a single blank between characters that are none.
_ODD = ["  ", " \n", "\n "] + [
    chr(c)
    for c in [*range(9, 10), *range(11, 14), *range(28, 32), 133, 160, 5760, *range(8192, 8203),
              8232, 8233, 8239, 8287, 12288]
]
_SAFE = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?= [^\s\x1c-\x1f\x85])")
_RUNS = re.compile("▁+[^▁]*")


def blank_keys(text: str) -> list[str]:
    """Cut before each single blank between two characters that are no white space.

    A byte-level tokenizer's pattern never matches across such a place. A chunk that begins with
    that blank is given without it, any other one with a blank behind it: see ``chunk_of``.
    """
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or any(o in text for o in _ODD):
        first, *rest = _SAFE.split(text)
        return [first + " ", *[c[1:] if " " not in c[1:] else c + " " for c in rest]]
    keys = text.split(" ")
    keys[0] += " "
    return keys


def chunk_of(key: str) -> str:
    return key[:-1] if key[-1] == " " else " " + key


def piece_chunks(text: str) -> list[str]:
    """The text as pieces see it: ``▁`` for blanks and in front, cut before each run of ``▁``.

    No piece holds ``▁`` after another character, so no merge crosses such a place.
    """
    if not text:
        return []
    if "  " in text or "▁" in text or text[0] == " " or text[-1] == " ":
        return _RUNS.findall("▁" + text.replace(" ", "▁"))
    return ["▁" + p for p in text.split(" ")]


@contextlib.contextmanager
def no_collection() -> Iterator[None]:
    """Python's search for cycles is off inside: there are none among chunks, but millions of objects."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class Index(dict):
    """The number of each chunk, given at its first occurrence."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self)
        return n


def batches_of(
    texts: list[str], cut: Callable[[str], list[str]], learn: Callable[[list[str]], None],
    forget: Callable[[], None], index: Index, size: int = 400,
):
    """Yield (texts, chunk numbers of each) for some texts at a time.

    ``learn`` gets the chunks that are new, in the order of their numbers, before they are used.
    """
    known = len(index)
    for at in range(0, len(texts), size):
        if known > KEPT:
            index.clear()
            forget()
            known = 0
        part = texts[at : at + size]
        rows = []
        for text in part:
            chunks = cut(text)
            rows.append(np.fromiter(map(index.__getitem__, chunks), np.int64, len(chunks)))
        if len(index) > known:
            every = list(index)
            learn(every[known:])
            known = len(index)
        yield part, rows


class Ragged:
    """Integers of any number for each chunk, gathered for many chunks at once."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.values = np.empty(0, np.int32)
        self.ends = np.zeros(1, np.int64)

    def extend(self, lists: list) -> None:
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((v for x in lists for v in x), np.int32, int(lengths.sum()))
        self.values = np.concatenate([self.values, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def of(self, numbers: np.ndarray) -> np.ndarray:
        starts = self.ends[numbers]
        lengths = self.ends[numbers + 1] - starts
        total = int(lengths.sum())
        before = np.cumsum(lengths) - lengths
        return self.values[np.repeat(starts - before, lengths) + np.arange(total)]
