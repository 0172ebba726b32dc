"""Bit predictors with hashed contexts across words, mixed with the words' shares.

A word's code is CODE bits of its hash, a text's end being the empty word. Bit by bit a code is predicted from

* the share, among the words of the text's class, of those whose code goes on with a 1;
* how often the bit was 0 and 1 after the one, and after the two words before, over all occurrences in
  all training texts, in hashed tables of fixed size. The class belongs to every context.

The logits are added up with weights that a gate chooses (by bit and by how well both contexts are known), and
an adaptive map refines the sum. Weights are learned online, an occurrence being taken out of the counts that
predict it; while a text is scored they are adapted to what it held so far. Words of one code keep the
proportion of their shares, so that the probabilities of all words add up to 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bits of a word's code (a multiple of 4), words before that contexts hold, binary logarithm of a table's slots.
CODE, SPANS, SLOTS = 8, 2, 22
LEAVES = 1 << CODE
#: Slots that travel together.
PART = 1 << 14
#: How much is known of a context: nothing, and beyond these counts.
KNOWN = (0, 2, 12)
LEVELS = (len(KNOWN) + 1) ** SPANS
#: Logits are cut at LARGEST, and in so many buckets.
LARGEST, BUCKETS = 8.0, 33
#: Starting weights of the share and of each context, and what each step of learning adds to curvatures.
START, CALM = (0.9, *(0.3,) * SPANS), 20.0
#: A text's own weights: words until they are adapted first (then whenever these doubled), and their calmness.
FIRST, CALM_TEXT = 6, 200.0
#: Texts that are scored together, and powers that a task remembers.
TEXTS, REMEMBERED = 250, 1 << 21
_PHI = np.uint32(2654435761)
_BELOW = (1 << 32) - 1
_ONE = np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_BASE = np.uint64(_BASE)
_powered = (np.empty(0, np.uint64), np.empty(0, np.uint64))

_N = np.arange(256.0)
_DELTA = 0.4
# Of halved counts one occurrence is less than 1, which hardly matters.
_LESS = np.maximum(_N - 1, 0)


def _looked_up(n0: np.ndarray, n1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logit and level of knowledge of a slot: the count of 0 above that of 1, 8 bits each."""
    logit = np.log((n1[None, :] + _DELTA) / (n0[:, None] + _DELTA)).astype(np.float32).ravel()
    return logit, np.searchsorted(KNOWN, (n1[None, :] + n0[:, None]).ravel(), "left").astype(np.uint8)


_LOGIT, _LEVEL = _looked_up(_N, _N)
#: The same where an occurrence of a 0, then where one of a 1 is taken out.
_LOGIT_LESS, _LEVEL_LESS = (np.concatenate(x) for x in zip(_looked_up(_LESS, _N), _looked_up(_N, _LESS), strict=True))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, modulo 2 ** 64."""
    global _powered
    if len(_powered[0]) >= size:
        return _powered
    found = tuple(np.cumprod(np.append(_ONE, np.full(size, x))) for x in (_BASE, _INVERSE))
    if size <= REMEMBERED:
        _powered = found
    return found


def word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """32 bits for each word of some letters: a polynomial of its letters, 0 for an empty word."""
    up, down = _powers(len(flat) + 1)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + _ONE) * up[: len(flat)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(32)).astype(np.uint32)


def key_hashes(keys: list[bytes]) -> np.ndarray:
    """Hashes of the words of keys (class as a byte, then the word)."""
    ends = np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys)))
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])[: len(keys)] + 1
    return word_hashes(np.frombuffer(b"".join(keys), np.uint8), starts, ends)


def cut_words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(letters, which are blank, where words begin and end in them, number of each word's text) of some texts."""
    flat = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    blank = (flat == 0x20) | (flat - np.uint8(0x09) < 5)
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edges = np.append(0, edges)
    starts, ends = edges[::2], edges[1::2]  # the last letter is blank
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    number = np.diff(np.searchsorted(starts, np.append(0, np.cumsum(sizes + 1))))
    return flat, blank, starts, ends, np.repeat(np.arange(len(raws)), number)


def with_ends(values: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of words and the number of each one's text, an end (0) after the words of each text."""
    out = np.zeros(len(values) + n_texts, values.dtype)
    out[np.arange(len(values)) + text] = values
    return out, np.repeat(np.arange(n_texts), np.bincount(text, minlength=n_texts) + 1)


def hashed_words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of its text), an end after the words of each text."""
    flat, _, starts, ends, text = cut_words(raws)
    return with_ends(word_hashes(flat, starts, ends), text, len(raws))


def hashed_contexts(word: np.ndarray, kind: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
    """Hashes of the one and of the two words before, for words one after another in texts."""
    fresh = np.ones(len(word), bool)
    fresh[1:] = text[1:] != text[:-1]
    none = np.uint32(7)
    h = (kind.astype(np.uint32) + np.uint32(1)) * np.uint32(0x27D4EB2F)
    out, begun = [], np.zeros(len(word), bool)
    for span in range(1, SPANS + 1):
        begun[span - 1 :] |= fresh[: len(word) - span + 1]  # the text begins less than ``span`` words before
        before = np.full(len(word), none)
        before[span:] = word[: len(word) - span]
        h = (h ^ np.where(begun, none, before)) * _PHI
        h ^= h >> np.uint32(15)
        out.append(h)
    return out


def _blocks(contexts: list[np.ndarray], word: np.ndarray):
    """Yield (number, code, four bits of it, block of sixteen slots by context) for all words at once."""
    code = word & np.uint32(LEAVES - 1)
    for four in range(CODE // 4):
        prefix = (code >> np.uint32(CODE - 4 * four)) + np.uint32(1 << (4 * four))
        blocks = []
        for h in contexts:
            x = h + prefix * np.uint32(0x9E3779B1)
            x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
            blocks.append(x >> np.uint32(36 - SLOTS))
        nibble = (code >> np.uint32(CODE - 4 * four - 4)) & np.uint32(15)
        yield four, code, nibble, blocks


def _nibble_bits(four: int, code: np.ndarray, nibble: np.ndarray):
    """Yield (bit number, bit, node of the tree of codes, slot within a block)."""
    for b in range(4):
        k = 4 * four + b
        bit = (nibble >> np.uint32(3 - b)) & np.uint32(1)
        node = np.uint32(1 << k) | (code >> np.uint32(CODE - k))
        yield k, bit, node, np.uint32(1 << b) | (nibble >> np.uint32(4 - b))


def code_bits(contexts: list[np.ndarray], word: np.ndarray):
    """Yield (bit number, bit, node of the tree of codes, slots by context) for all words at once.

    Four bits of a code share a block of sixteen slots.
    """
    for four, code, nibble, blocks in _blocks(contexts, word):
        for k, bit, node, within in _nibble_bits(four, code, nibble):
            yield k, bit, node, [x << np.uint32(4) | within for x in blocks]


def counted_bits(tables: list[np.ndarray], contexts: list[np.ndarray], word: np.ndarray):
    """``code_bits`` with what the tables hold in place of slots. A block is fetched once for its four bits."""
    first = np.arange(0, 16 * len(word), 16)
    for four, code, nibble, blocks in _blocks(contexts, word):
        rows = [t.reshape(-1, 16).take(x, axis=0).ravel() for t, x in zip(tables, blocks, strict=True)]
        for k, bit, node, within in _nibble_bits(four, code, nibble):
            at = first + within
            yield k, bit, node, [r.take(at) for r in rows]


def leaf(word: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The number of a class and code."""
    return kind.astype(np.int64) * LEAVES + (word & np.uint32(LEAVES - 1))


def empty_counts() -> list[np.ndarray]:
    """Tables to count in: the count of 1 above that of 0, 32 bits each."""
    return [np.zeros(1 << SLOTS, np.int64) for _ in range(SPANS)]


def count_codes(blocks: list[np.ndarray], contexts: list[np.ndarray], word: np.ndarray) -> None:
    """Count the four bits of each block, one step for what ``slot_counts`` makes counts of four slots."""
    for _, _, nibble, found in _blocks(contexts, word):
        for table, x in zip(blocks, found, strict=True):
            np.add.at(table, x << np.uint32(4) | nibble, 1)


def slot_counts(block: np.ndarray) -> np.ndarray:
    """Counts of the slots, that of 1 above that of 0, from how often each block had each four bits."""
    out = np.zeros((len(block) // 16, 16), np.int64)
    n = block.reshape(-1, 16)
    for b in range(3, -1, -1):
        n0, n1 = n[:, ::2], n[:, 1::2]
        out[:, 1 << b : 2 << b] = n1 << 32 | n0
        n = n0 + n1  # of the bits before
    return out.ravel()


def count(tables: list[np.ndarray], contexts: list[np.ndarray], word: np.ndarray) -> None:
    """Add some words to counts of slots; of many words, ``count_codes`` first."""
    blocks = empty_counts()
    count_codes(blocks, contexts, word)
    for table, block in zip(tables, blocks, strict=True):
        table += slot_counts(block)


def packed(counts: np.ndarray) -> bytes:
    """Numbers, their bytes sorted by place: the high ones are nearly all 0."""
    raw = np.ascontiguousarray(counts.view(np.uint8).reshape(-1, counts.itemsize).T)
    return pa.compress(raw.tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(raw, size * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(width, size).T).view(kind).ravel()


def eight_bits(counts: np.ndarray) -> np.ndarray:
    """Counts of 0 and 1 as 8 bits each, both of a slot halved together until they fit."""
    n0, n1 = counts & _BELOW, counts >> 32
    shift = np.maximum(np.ceil(np.log2((np.maximum(n0, n1) + 1) / 256)), 0).astype(np.int64)
    half = (1 << shift) >> 1
    n0, n1 = (np.minimum((n + half) >> shift, 255) for n in (n0, n1))
    return (n0 << 8 | n1).astype(np.uint16)


def share_tree(counts: np.ndarray, other: float) -> tuple[np.ndarray, np.ndarray]:
    """(logits of the nodes, logarithms of the shares of codes) by class, from training words by class and code."""
    of = np.maximum(counts.sum(1, keepdims=True), 1)
    leaf = (1 - other) * counts / of + other * counts.sum(0) / max(counts.sum(), 1) + 1e-12
    leaf /= leaf.sum(1, keepdims=True)
    tree = np.concatenate([np.zeros_like(leaf), leaf], 1)
    for level in range(CODE - 1, -1, -1):
        at = np.arange(1 << level, 2 << level)
        tree[:, at] = tree[:, 2 * at] + tree[:, 2 * at + 1]
    logits = np.zeros(leaf.shape, np.float32)
    logits[:, 1:] = np.log(tree[:, 3::2] / tree[:, 2::2])
    return logits, np.log(leaf)


class ContextMixer:
    """Gated weights and the adaptive map over shares and contexts."""

    def __init__(self, tables: list[np.ndarray], logits: np.ndarray, leaves: np.ndarray) -> None:
        self.tables, self.logits, self.leaves = tables, logits.ravel(), leaves
        self.weights = np.tile(np.array(START), (CODE, LEVELS, 1))
        self.seen = np.zeros((CODE, BUCKETS, 2))

    @staticmethod
    def bucket(logit: np.ndarray) -> np.ndarray:
        """Two buckets for each unit of logits that are at most LARGEST."""
        return (logit * np.float32(2) + np.float32(BUCKETS / 2)).astype(np.int64)

    def _inputs(self, counts, node, first, own=None):
        """(logits to mix, gate) of a bit; of ``own`` bits an occurrence is taken out."""
        inputs, gate = [self.logits.take(first + node)], 0
        logit, level = (_LOGIT, _LEVEL) if own is None else (_LOGIT_LESS, _LEVEL_LESS)
        half = None if own is None else own << np.uint32(16)
        for n in counts:
            n = (n if half is None else n | half).astype(np.int64)
            inputs.append(logit.take(n))
            gate = gate * np.uint8(len(KNOWN) + 1) + level.take(n)
        return inputs, gate.astype(np.int64)

    def learn(self, contexts: list[np.ndarray], word: np.ndarray, kind: np.ndarray) -> None:
        """One step over some words."""
        first = kind.astype(np.int64) * LEAVES
        for k, bit, node, counts in counted_bits(self.tables, contexts, word):
            one = bit == 1
            x, gate = self._inputs(counts, node, first, bit)
            weights = self.weights[k]
            mixed = np.zeros(len(word), np.float32)
            for w, v in zip(weights.T.astype(np.float32), x, strict=True):
                mixed += w.take(gate) * v
            mixed = np.clip(mixed, -LARGEST, LARGEST)
            p = 1 / (1 + np.exp(-mixed))
            seen = np.bincount(self.bucket(mixed) * 2 + bit, minlength=2 * BUCKETS)
            self.seen[k] += seen.reshape(BUCKETS, 2)
            # Along the slope, no farther than the curvature allows.
            curve = np.bincount(gate, p * (1 - p) * sum(v * v for v in x), minlength=LEVELS) + CALM
            error = one - p
            for i, v in enumerate(x):
                weights[:, i] += np.bincount(gate, error * v, minlength=LEVELS) / curve

    def ratios(
        self, before: list[np.ndarray], word: np.ndarray, kind: np.ndarray, text: np.ndarray
    ) -> np.ndarray:
        """Natural logarithm of each word's probability in its contexts over its share.

        Words of a text come in order. Each text begins with the weights learned and adds its own to them, one
        for each input, after 2 ** FIRST words and whenever these have doubled.
        """
        out = np.zeros(len(text))
        # Some texts at once, in little memory.
        cuts = np.flatnonzero(np.diff(text // TEXTS)) + 1
        for at, to in zip([0, *cuts], [*cuts, len(text)], strict=True):
            if to > at:
                part = slice(at, to)
                out[part] = self._ratios([x[part] for x in before], word[part], kind[part], text[part])
        return out

    def _ratios(
        self, contexts: list[np.ndarray], word: np.ndarray, kind: np.ndarray, text: np.ndarray
    ) -> np.ndarray:
        starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        number = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(text))))
        place = np.arange(len(text)) - starts[number]
        turn = np.frexp(place >> FIRST)[1]
        refined = (self.seen[:, :, 1] + 0.5) / (self.seen.sum(2) + 1.0)
        refined = refined.astype(np.float32)
        shape = (len(START), len(starts))
        slope, curve = np.zeros(shape), np.zeros(shape)
        out = np.zeros(len(text))
        last = int(turn.max())
        for t in range(last + 1):
            at = np.flatnonzero(turn == t)
            of = number[at]
            own = [d.take(of) for d in (slope / (curve + CALM_TEXT)).astype(np.float32)]
            errors, bends = np.zeros((2, len(own), len(at)), np.float32)
            first = kind[at].astype(np.int64) * LEAVES
            total = np.ones(len(at))  # a product of CODE factors of some 0.0002 at least
            for k, bit, node, counts in counted_bits(self.tables, [c[at] for c in contexts], word[at]):
                x, gate = self._inputs(counts, node, first)
                mixed = np.zeros(len(at), np.float32)
                for w, d, v in zip(self.weights[k].T.astype(np.float32), own, x, strict=True):
                    mixed += (w.take(gate) + d) * v
                mixed = np.clip(mixed, -LARGEST, LARGEST)
                p = 1 / (1 + np.exp(-mixed))
                q = (p + refined[k].take(self.bucket(mixed))) / 2
                one = bit == 1
                total *= np.where(one, q, 1 - q)
                if t < last:
                    error, bend = one - p, p * (1 - p)
                    for i, v in enumerate(x):
                        errors[i] += error * v
                        bends[i] += bend * v * v
            if t < last:
                for i in range(len(own)):
                    slope[i] += np.bincount(of, errors[i], minlength=len(starts))
                    curve[i] += np.bincount(of, bends[i], minlength=len(starts))
            out[at] = np.log(total)
        return out - self.leaves.ravel().take(leaf(word, kind))
