"""Packing documents into sequences of a fixed number of tokens, improved by local search.

Documents become pieces of at most ``CAPACITY`` tokens. Pieces are dealt by hash into groups of about
``GROUP`` (some thousands, so that a group wastes about one sequence); each group is packed in one task.
Best-fit decreasing gives a first packing. Local search then moves a document between underfull bins, or
exchanges one for one or one for two, always so that the sum of squared fills grows: full bins become
fuller and the emptiest ones drain until they are empty and go.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairstats.llm.common import give_back, texts_of
from pairstats.sinks.stage import materialize

CAPACITY = 2048
#: The id after each document.
END = 0
GROUP = 8192
#: Passes over the underfull bins at most; most groups settle in fewer.
PASSES = 12


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Fixed value: how byte-level tokenizers cut a text before merging.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _bytes_of_characters() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves, the other bytes for characters from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


def _ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Tokens by their rank, and special ones, of a plain byte-level file; None of any other."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    cut, model = parts["pre_tokenizer"] or {}, parts["model"]
    added = parts["added_tokens"]
    plain = (
        parts["normalizer"] is None
        and (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex")) == ("ByteLevel", False, True)
        and model["type"] == "BPE"
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
    )
    special = {t["content"]: t["id"] for t in added}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    # A rank is an id where ids count the merges in their order.
    if not plain or [vocabulary.get(m.replace(" ", "")) for m in merges] != [*range(256, 256 + len(merges))]:
        return None
    of = _bytes_of_characters()
    return {bytes(of[c] for c in token): i for token, i in vocabulary.items()}, special


def _encoder(path: str):
    """A function from a text to its ids, those that the tokenizers library gives.

    A plain byte-level file is run by tiktoken, several times as fast; that gives up on white space of
    a hundred thousand characters and more in a row, which the tokenizers library then takes.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    slow = None

    def whole(text: str) -> list[int]:
        nonlocal slow
        slow = slow or Tokenizer.from_file(path)
        return slow.encode(text, add_special_tokens=False).ids

    known = _ranks(path)
    if known is None:
        return whole
    ranks, special = known
    fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except ValueError:
            return whole(text)

    return encode


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document of ``n`` tokens: only its first piece may be shorter."""
    first = n % capacity or capacity
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n], strict=True)]


def tokenized_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of (doc_id, text), each document ended by ``END``.

    A null or empty text is the end alone; rows of the same id are documents of their own.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

    def run(batches):
        encode = _encoder(path)
        for batch in batches:
            rows = []
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for doc_id, text in zip(ids, texts, strict=True):
                tokens = np.array([*encode(text.as_py()), END], "<u4")
                for k, (start, length) in enumerate(pieces_of(len(tokens), capacity)):
                    crc = zlib.crc32(tokens[start : start + length].tobytes())
                    rows.append((doc_id, k, start, length, crc))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        encode = batch = texts = rows = columns = None
        give_back()

    return texts_of(docs).mapInArrow(run, schema)


class Bins:
    """Bins of one group while they are improved; an item is a position in ``size``."""

    def __init__(self, size: list[int], capacity: int) -> None:
        self.size, self.capacity = size, capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        self.place = [0] * len(size)
        self._best_fit()

    def _best_fit(self) -> None:
        """Largest first, each into the fullest bin that has room."""
        room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0  # bit r: some bin has exactly r tokens left
        for item in sorted(range(len(self.size)), key=lambda k: -self.size[k]):
            need = self.size[item]
            above = mask >> need
            if above:
                left = need + (above & -above).bit_length() - 1
                b = room[left].pop()
                if not room[left]:
                    mask &= ~(1 << left)
            else:
                left, b = self.capacity, len(self.items)
                self.items.append([])
                self.fill.append(0)
            self.items[b].append(item)
            self.place[item] = b
            self.fill[b] += need
            room[left - need].append(b)
            mask |= 1 << (left - need)

    def move(self, item: int, b: int) -> None:
        a, n = self.place[item], self.size[item]
        self.items[a].remove(item)
        self.items[b].append(item)
        self.place[item] = b
        self.fill[a] -= n
        self.fill[b] += n

    def improve(self) -> None:
        for _ in range(PASSES):
            if not self._pass():
                return

    def _pass(self) -> bool:
        """Give each underfull bin, the fullest first, what fills it best from emptier ones."""
        open_bins = [b for b, f in enumerate(self.fill) if 0 < f < self.capacity]
        open_bins.sort(key=lambda b: (-self.fill[b], b))
        # Items of underfull bins by size; only positions in emptier bins count.
        by: dict[int, list[int]] = {}
        mask = 0
        for b in open_bins:
            for item in self.items[b]:
                by.setdefault(self.size[item], []).append(item)
                mask |= 1 << self.size[item]
        changed = False
        for b in open_bins:
            slack = self.capacity - self.fill[b]
            if not 0 < slack < self.capacity:
                continue
            best = self._best_change(b, slack, by, mask)
            if best is None:
                continue
            _, came, gone = best
            a = self.place[came]
            self.move(came, b)
            for item in gone:
                self.move(item, a)
            changed = True
        return changed

    def _best_change(self, b: int, slack: int, by: dict, mask: int):
        """(gain in tokens, item that comes, items that go) that fills the bin best."""
        best, seen = None, set()
        for out, gone in self._outs(b):
            if out in seen:  # the same gain as before
                continue
            seen.add(out)
            top = out + slack
            least = out + (best[0] if best else 0)
            sizes = mask & ((1 << (top + 1)) - 1)
            while sizes:
                n = sizes.bit_length() - 1
                if n <= least:
                    break
                came = self._from_emptier(by[n], b)
                if came is not None:
                    best = (n - out, came, gone)
                    break
                sizes &= ~(1 << n)
                mask &= ~(1 << n)  # nor for what goes otherwise
            if best and best[0] == slack:
                break
        return best

    def _outs(self, b: int):
        """(tokens, items) of nothing, one or two items of a bin; items of one size are the same, so
        there are few: the sizes of a bin add up to its fill."""
        yield 0, ()
        of: dict[int, list[int]] = {}
        for item in self.items[b]:
            of.setdefault(self.size[item], []).append(item)
        for n, same in of.items():
            yield n, (same[0],)
        sizes = list(of)
        for k, n in enumerate(sizes):
            if len(of[n]) > 1:
                yield 2 * n, (of[n][0], of[n][1])
            for m in sizes[:k]:
                yield n + m, (of[n][0], of[m][0])

    def _from_emptier(self, items: list[int], b: int):
        """One of some items that is in a bin not fuller than this one; the emptiest come last."""
        for item in reversed(items):
            a = self.place[item]
            if a != b and self.fill[a] <= self.fill[b]:
                return item
        return None


def packed(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """(bin, offset) of each length; bins are numbered from 0 without gaps."""
    bins = Bins(lengths, capacity)
    bins.improve()
    numbers, offsets, n = [0] * len(lengths), [0] * len(lengths), 0
    for items in bins.items:
        at = 0
        for item in items:
            numbers[item], offsets[item] = n, at
            at += lengths[item]
        n += bool(items)
    return numbers, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``, at most ``capacity``) with sequence_id and offset.

    Full pieces are sequences of their own; the others are packed group by group. Which group a piece
    is in depends on its document and number, so no key gathers more than its share.
    """
    # About GROUP rows each; the count comes from the written table's metadata.
    groups = max(1, -(-pieces.count() // GROUP))
    key = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(groups)).alias("_group")
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields]
    schema = ", ".join([*fields, "sequence_id bigint", "offset bigint"])
    names = pieces.columns

    def run(key, table):
        number, offset = packed(table.column("length").to_pylist(), capacity)
        first = key[0].as_py() << 32
        table = table.select(names)
        table = table.append_column("sequence_id", pa.array([first + n for n in number], pa.int64()))
        return table.append_column("offset", pa.array(offset, pa.int64()))

    return pieces.select("*", key).groupBy("_group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every document.

    A row without id is packed like any other. An empty table gives an empty result.
    """
    made = tokenized_pieces(docs, path or tokenizer_path(), capacity)
    return pack(materialize(made, "pieces"), capacity)
