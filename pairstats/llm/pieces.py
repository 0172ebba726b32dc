"""Encoding and decoding with a SentencePiece model of merge type, by backtracking.

A text falls into chunks that no merge crosses. In a chunk, the longest piece at a position comes
first; it stays while it and the piece before are what merging the two joined strings gives. Else the
next shorter piece is tried; where none fits, the position is marked as failed in a bitfield, the piece before is taken
back and its shorter ones are tried. A sequence of which all adjacent pairs are stable is the one
that merging yields, so the result is exact, in time linear in practice.

Chunks are cut further wherever two characters stand side by side in no piece, since no merge crosses
such a place either. What is left is mostly plain words; each distinct one is encoded once, and one run of
the automaton over many of them joined gives the longest piece at every position.

Chunks with several ``▁`` in a row are merged directly: the pieces of such runs share one score, and
ties, which merging breaks by position, are no property of a pair.
"""

from __future__ import annotations

import hashlib
import heapq
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from pairstats.llm.chunks import KEPT, Index, batches_of, no_collection, piece_chunks
from pairstats.llm.common import map_texts, texts_of

SPACE = "▁"
#: Pairs of pieces whose stability a task remembers.
PAIRS = 300_000
#: Parts that the automaton runs over at once.
TOGETHER = 2_000
#: Up to so many characters, looking at all pairs again is faster than a heap of them.
SHORT = 24


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """A model's pieces, and the encoder over them."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.unknown = model.unk_id()
        self.control = {i for i in range(n) if model.is_control(i)}
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        for i, piece in enumerate(self.text):
            if model.is_byte(i):
                self.bytes[i] = int(piece[3:5], 16)
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.ids[piece] = i
                self.score[piece] = model.get_score(i)
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) > 1:
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        # Characters that stand side by side in some piece, as two numbers in one.
        beside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.beside = np.array(sorted(ord(a) << 21 | ord(b) for a, b in beside), np.int64)
        used = set("".join(self.ids))
        # Parts texts that are matched together: a character of no piece.
        self.apart = next(c for c in map(chr, range(0x10FFFF, 0, -1)) if c not in used)
        self.plain = [piece.replace(SPACE, " ") for piece in self.text]
        self.stable_pairs: dict[tuple[str, str], bool] = {}

    def merged(self, s: str) -> list[str]:
        """The pieces of ``s`` by merging: the best scored pair first, the leftmost of equals."""
        score = self.score
        if len(s) <= SHORT:
            short = list(s)
            while True:
                best, at = None, -1
                for i in range(len(short) - 1):
                    value = score.get(short[i] + short[i + 1])
                    if value is not None and (best is None or value > best):
                        best, at = value, i
                if at < 0:
                    return short
                short[at : at + 2] = [short[at] + short[at + 1]]
        parts: list[str | None] = list(s)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                both = parts[i] + parts[j]
                if both in score:
                    heapq.heappush(heap, (-score[both], i, both))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if parts[i] is None or after[i] >= n or parts[i] + parts[after[i]] != both:
                continue
            j = after[i]
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def stable(self, left: str, right: str) -> bool:
        """Whether merging the two joined strings gives the two again."""
        known = self.stable_pairs.get((left, right))
        if known is None:
            if len(self.stable_pairs) > PAIRS:
                self.stable_pairs.clear()
            known = self.merged(left + right) == ([left, right] if left else [right])
            self.stable_pairs[left, right] = known
        return known

    def reach(self, text: str) -> list[int]:
        """Length of the longest piece that begins at each position; 1 where none does."""
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        out = np.ones(len(text), np.int64)
        np.maximum.at(out, found[:, 0] - found[:, 1] + 1, found[:, 1])
        return out.tolist()

    def reaches(self, parts: list[str]) -> list[list[int]]:
        """``reach`` of each part, by one run over all of them."""
        every, at, out = self.reach(self.apart.join(parts)), 0, []
        for part in parts:
            out.append(every[at : at + len(part)])
            at += len(part) + 1
        return out

    def parts_of(self, chunks: list[str]) -> list[list[str]]:
        """Each chunk, cut between characters that stand side by side in no piece."""
        every = self.apart.join(chunks) + self.apart
        chars = np.frombuffer(every.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        pairs = chars[:-1] << 21 | chars[1:]
        at = np.minimum(np.searchsorted(self.beside, pairs), len(self.beside) - 1)
        cuts = np.append(np.flatnonzero(self.beside[at] != pairs) + 1, len(chars))
        # What parts the chunks is cut off on both sides; a chunk of that very character is one part.
        ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1) - 1
        lasts = np.searchsorted(cuts, ends).tolist()
        cuts, out, k, start = cuts.tolist(), [], 0, 0
        for last, end in zip(lasts, ends.tolist(), strict=True):
            if last == k:
                out.append([every[start:end]])
            else:
                places = [start, *cuts[k : last + 1]]
                out.append([every[a:b] for a, b in zip(places, places[1:])])
            k, start = last + 2, end + 1
        return out

    def encode_chunk(self, chunk: str, reach: list[int] | None = None) -> list[str]:
        """The pieces of a chunk; a character without a piece stands for itself.

        ``reach`` gives the longest piece at each position.
        """
        if chunk in self.score and self.stable("", chunk):
            return [chunk]
        if chunk.startswith(SPACE * 2):
            return self.merged(chunk)
        n = len(chunk)
        reach = self.reach(chunk) if reach is None else reach
        failed = bytearray(n + 1)
        out: list[str] = []
        at, size = 0, reach[0] if n else 0
        while at < n:
            last = out[-1] if out else ""
            while size:
                piece = chunk[at : at + size]
                if (
                    not failed[at + size]
                    and (size == 1 or piece in self.score)
                    and self.stable(last, piece)
                ):
                    break
                size -= 1
            if size:
                out.append(piece)
                at += size
                size = reach[at] if at < n else 0
            else:
                failed[at] = 1
                if not out:  # cannot happen with a consistent model
                    return self.merged(chunk)
                size = len(out.pop())
                at -= size
                size -= 1
                if not size:
                    # Its single character was the last choice there: that position fails, too.
                    while out and not size:
                        failed[at] = 1
                        size = len(out.pop())
                        at -= size
                        size -= 1
                    if not size:
                        return self.merged(chunk)
        return out

    def ids_of(self, pieces: list[str]) -> list[int]:
        """Ids, with the bytes of characters that have no piece."""
        out = []
        for piece in pieces:
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass"))
            else:
                out.append(self.unknown)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for c in piece_chunks(text) for i in self.ids_of(self.encode_chunk(c))]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the blank that encoding puts in front is taken away again."""
        text = self.decoded(ids)
        return text[1:] if text[:1] == " " else text

    def decoded(self, ids: list[int]) -> str:
        """The text of ids as they stand; control ids, which encoding never makes, are nothing."""
        if self.bytes.keys().isdisjoint(ids) and self.control.isdisjoint(ids):
            return "".join(map(self.plain.__getitem__, ids))
        out, held = [], bytearray()
        for i in ids:
            if i in self.bytes:
                held.append(self.bytes[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append("" if i in self.control else self.plain[i])
        out.append(held.decode("utf-8", "replace"))
        return "".join(out)


def encoded_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row of ``docs``.

    A null text is read as empty, which has no ids and decodes to nothing; repeated rows and rows
    without id get their own results.
    """
    path = path or model_path()

    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()

    def task():
        model, index = Pieces(path), Index()
        counts: list[int] = []
        lines: list[str] = []
        plain: list[str] = []
        # Number of ids, the ids as text and the decoded text of each part met.
        known: dict[str, tuple[int, str, str]] = {}

        def encode(parts: list[str]) -> None:
            for at in range(0, len(parts), TOGETHER):
                some = parts[at : at + TOGETHER]
                for part, reach in zip(some, model.reaches(some), strict=True):
                    ids = model.ids_of(model.encode_chunk(part, reach))
                    known[part] = len(ids), ",".join(map(str, ids)), model.decoded(ids)

        def learn(chunks: list[str]) -> None:
            cut = model.parts_of(chunks)
            if len(known) > KEPT:
                known.clear()
            encode(list(dict.fromkeys(p for parts in cut for p in parts if p not in known)))
            for parts in cut:
                found = [known[p] for p in parts]
                counts.append(sum(n for n, _, _ in found))
                lines.append(",".join([line for _, line, _ in found]))
                plain.append("".join([text for _, _, text in found]))

        def forget() -> None:
            for kept in (counts, lines, plain):
                kept.clear()

        def run(texts: list[str]) -> list[list]:
            totals, ids_digests, text_digests = [], [], []
            with no_collection():
                for _, rows in batches_of(texts, piece_chunks, learn, forget, index):
                    for numbers in rows:
                        numbers = numbers.tolist()
                        totals.append(sum(map(counts.__getitem__, numbers)))
                        ids_digests.append(sha(",".join(map(lines.__getitem__, numbers))))
                        text = "".join(map(plain.__getitem__, numbers))
                        text_digests.append(sha(text[1:] if text[:1] == " " else text))
            return [totals, ids_digests, text_digests]

        return run

    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_texts(texts_of(docs), added, task, per_task=True)
