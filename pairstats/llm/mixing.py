"""Language-model scores by logistic mixing of bit predictors with hashed contexts.

A text is its lower-cased words and an end. Its class, one of CLASSES, comes first and chooses the counts
that all else uses: classes are centres of letter pairs, found on all training texts: every task sums
its own up in a few weighted centres (they separate languages and layouts). Then each word costs, in this order:

* a bit, whether it is the word that followed the last occurrence of the two words before in this text;
  if not, a bit for the one word before. How sure these are depends on how often in a row they were right:
  so the model adapts online to what a text repeats;
* else its share of the words so far in this text, mixed with what bit predictors make of its share of the
  training words and the words before it (see ``contexts``: counted over all occurrences, weights adapted while
  the text is scored), mixed, as it may be new, with the probability that the bits of its letters get.

A letter is eight bits. Predictors with contexts of one to four letters look up, in hashed tables of
fixed size, how often the bit was 0 and 1 over the distinct training words; their logits are added
up with weights that a gate chooses (by bit and by how well the longest contexts are known), learned online,
and an adaptive map refines the sum. A word's own occurrence is taken out of the tables while
weights are learned, as if it came before the update. The tables, weights and shares of all tasks add
up, so everything is learned from all training texts; the tables' size is a parameter of the method.
"""

from __future__ import annotations

import math
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairstats.llm import contexts
from pairstats.llm.common import give_back, texts_of
from pairstats.sinks.stage import materialize

#: Letters of context of each bit predictor, and the binary logarithm of its table's slots.
ORDERS = {1: 19, 2: 21, 3: 22, 4: 22}
#: Classes of texts (at most 8), weighted centres that a task sums its texts up in, and hashed letter pairs.
CLASSES, CENTRES, PAIRS = 8, 32, 1024
#: Texts a task sums up at once, tasks whose centres are summed up together, and texts whose pairs are counted at once.
SUMMED, MERGED, PAIRED = 1000, 64, 20
#: Weight of all classes' word shares beside those of the text's own class.
OTHER = 0.05
#: Words whose shares and bits every task knows; the rest is joined.
FREQUENT = 131_072
#: Tasks that fill tables of their own before these are added up.
TABLE_TASKS = 16
CHUNK = 1 << 16
#: Distinct words a task counts before it passes counts on.
COUNTED = 600_000
RATE, DELTA = 0.15, 0.4
#: Logarithms of the counts that a slot may hold.
_LOGS = np.log(np.arange(65_536) + DELTA)
BUCKETS = 33
RUNS = 6
#: Weight of the text's own words: SHARE * words so far / (words so far + LATER). Each word of the
#: text counts LESS a fraction of an occurrence.
SHARE, LATER, LESS = 0.1, 60.0, 0.6

_PHI = np.uint32(2654435761)
_SPACE = 0x20


# Bits of words


def _letters(keys: list[bytes]) -> tuple[np.ndarray, dict[int, np.ndarray], np.ndarray]:
    """All letters of words, each word ended by a blank; context hashes; lengths with the blank.

    A key is the class as a byte, then the word. The class belongs to every context.
    """
    flat = np.frombuffer(b" ".join([k[1:] for k in keys]) + b" ", np.uint8)
    lengths = np.fromiter(map(len, keys), np.int64, len(keys))
    kind = np.repeat(np.fromiter((k[0] for k in keys), np.uint32, len(keys)), lengths)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(flat)) - np.repeat(starts, lengths)
    hashes = {}
    h = kind * np.uint32(0x27D4EB2F) + np.uint32(0x1234567)
    for order in range(1, max(ORDERS) + 1):
        before = np.full(len(flat), _SPACE, np.uint32)
        before[order:] = flat[:-order] if order < len(flat) else before[order:]
        before[place < order] = _SPACE  # nothing of the word before
        if order == 1:
            hashes[1] = (kind << np.uint32(16)) | (before << np.uint32(8))  # exact, with bits so far
        h = (h ^ (before + np.uint32(order * 977))) * _PHI
        h ^= h >> np.uint32(15)
        if order > 1 and order in ORDERS:
            hashes[order] = h.copy()
    return flat, hashes, lengths


def _slots(order: int, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    if order == 1:
        return context | node
    x = context + node * np.uint32(0x9E3779B1)
    return (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - ORDERS[order])


def _bits(words: list[bytes]):
    """Yield (bit number, bit, slots by order) for all letters at once, and lengths first."""
    flat, hashes, lengths = _letters(words)
    yield lengths
    wide = flat.astype(np.uint32)
    for k in range(8):
        node = (np.uint32(1) << np.uint32(k)) | (wide >> np.uint32(8 - k))
        bit = ((flat >> np.uint8(7 - k)) & np.uint8(1)).astype(np.int64)
        yield k, bit, {o: _slots(o, h, node) for o, h in hashes.items()}


def _listed(values: pa.Array) -> list[bytes]:
    """Values as bytes; far faster than ``to_pylist``."""
    return values.to_numpy(zero_copy_only=False).tolist()


def _word_parts(batch, size: int = 30_000):
    words = _listed(batch.column("word"))
    for at in range(0, len(words), size):
        yield at, words[at : at + size]


def fitted(total: np.ndarray) -> np.ndarray:
    """Counts of 0 and 1, slot by slot, as 16 bits: both of a slot halved together until they fit."""
    pairs = total.reshape(-1, 2)
    shift = np.maximum(np.ceil(np.log2((pairs.max(1) + 1) / 65_536)), 0).astype(np.int64)[:, None]
    return np.minimum((pairs + ((1 << shift) >> 1)) >> shift, 65_535).astype(np.uint16).ravel()


def bit_tables(vocabulary: DataFrame) -> dict[int, np.ndarray]:
    """Counts (slots x 2) by order over the distinct training words: each word counts once."""
    schema = "order int, chunk int, counts binary"

    def fill(batches):
        tables = {o: np.zeros((2 << b), np.int32) for o, b in ORDERS.items()}
        for batch in batches:
            for _, words in _word_parts(batch):
                bits = _bits(words)
                next(bits)
                for _, bit, slots in bits:
                    for o, s in slots.items():
                        np.add.at(tables[o], s.astype(np.int64) * 2 + bit, np.ones(len(s), np.int32))
        yield from _packed(tables)
        tables = batch = words = bits = bit = slots = None
        give_back()

    def add(key, table):
        import zlib

        total = None
        for raw in table.column("counts").to_pylist():
            part = np.frombuffer(zlib.decompress(raw), np.int32)
            total = part.astype(np.int64) if total is None else total + part
        raw = zlib.compress(fitted(total).tobytes(), 1)
        return pa.table({"order": [key[0].as_py()], "chunk": [key[1].as_py()], "counts": [raw]},
                        schema=pa.schema([("order", pa.int32()), ("chunk", pa.int32()),
                                          ("counts", pa.binary())]))

    import zlib

    parts = vocabulary.where("c > 0 AND length(word) > 1").select("word").coalesce(TABLE_TASKS)
    parts = parts.mapInArrow(fill, schema)
    # Bounded: the chunks of all tables, some 10 MB together.
    rows = parts.groupBy("order", "chunk").applyInArrow(add, schema).collect()
    out = {o: np.zeros(2 << b, np.uint16) for o, b in ORDERS.items()}
    for r in rows:
        at = r["chunk"] * CHUNK
        part = np.frombuffer(zlib.decompress(r["counts"]), np.uint16)
        out[r["order"]][at : at + len(part)] = part
    return {o: t.reshape(-1, 2) for o, t in out.items()}


def _packed(tables: dict[int, np.ndarray]):
    import zlib

    for order, table in tables.items():
        for chunk, at in enumerate(range(0, len(table), CHUNK)):
            part = table[at : at + CHUNK]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([order], pa.int32()), pa.array([chunk], pa.int32()),
                     pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                    names=["order", "chunk", "counts"],
                )


class Mixer:
    """Gated weights and the adaptive map over the tables' logits."""

    def __init__(self, tables: dict[int, np.ndarray]) -> None:
        self.tables = tables
        self.logits: dict[int, np.ndarray] = {}
        self.weights = np.full((8 * 9, len(ORDERS)), 0.35)
        self.seen = np.zeros((8, BUCKETS, 2))

    def freeze(self) -> None:
        for o, t in self.tables.items():
            n = t.astype(np.float32)
            self.logits[o] = np.log((n[:, 1] + DELTA) / (n[:, 0] + DELTA)).astype(np.float32)
            n = n.sum(1)
            self.known = getattr(self, "known", {})
            self.known[o] = ((n > 0).astype(np.uint8) + (n > 3)).astype(np.uint8)

    @staticmethod
    def bucket(logit: np.ndarray) -> np.ndarray:
        return np.clip(np.round(logit * 2) + BUCKETS // 2, 0, BUCKETS - 1).astype(np.int64)

    def learn(self, words: list[bytes]) -> None:
        """One online step over some words, each left out of the counts it is predicted from."""
        bits = _bits(words)
        next(bits)
        pairs = {o: t.view(np.uint32).ravel() for o, t in self.tables.items()}
        for k, bit, slots in bits:
            own, logits, gate = bit.astype(np.int32), [], np.zeros(len(bit), np.int64)
            for o, s in slots.items():
                n = pairs[o].take(s)  # the count of 1 above that of 0
                # Of halved counts one occurrence is less than 1, which hardly matters.
                n0 = np.maximum((n & 0xFFFF).astype(np.int32) - (1 - own), 0)
                n1 = np.maximum((n >> 16).astype(np.int32) - own, 0)
                logits.append(_LOGS.take(n1) - _LOGS.take(n0))
                if o >= 3:
                    total = n0 + n1
                    gate += ((total > 0).astype(np.int64) + (total > 3)) * (3 if o == 4 else 1)
            weights = self.weights[k * 9 : k * 9 + 9]
            mixed = sum(x * weights[:, i].take(gate) for i, x in enumerate(logits))
            p = 1 / (1 + np.exp(-np.clip(mixed, -20, 20)))
            seen = np.bincount(self.bucket(mixed) * 2 + bit, minlength=2 * BUCKETS)
            self.seen[k] += seen.reshape(BUCKETS, 2)
            error = bit - p
            size = np.bincount(gate, minlength=9) + 200.0
            for i, x in enumerate(logits):
                weights[:, i] += RATE * np.bincount(gate, error * x, minlength=9) / size

    def score(self, words: list[bytes]) -> np.ndarray:
        """log10 of the probability that letters spell each word, its end included."""
        bits = _bits(words)
        lengths = next(bits)
        total = 0.0
        refined = (self.seen[:, :, 1] + 0.5) / (self.seen.sum(2) + 1.0)
        for k, bit, slots in bits:
            gate = self.known[4].take(slots[4]) * np.uint8(3) + self.known[3].take(slots[3])
            weights = self.weights[k * 9 : k * 9 + 9].astype(np.float32)
            mixed = sum(
                self.logits[o].take(s) * weights[:, i].take(gate) for i, (o, s) in enumerate(slots.items())
            )
            mixed = np.clip(mixed, -20, 20)
            p = (1 / (1 + np.exp(-mixed)) + refined[k].take(self.bucket(mixed))) / 2
            total = total + np.log10(np.where(bit == 1, p, 1 - p))
        ends = np.cumsum(lengths)
        return np.add.reduceat(total, ends - lengths)


def train_mixer(vocabulary: DataFrame, held: Broadcast) -> tuple:
    """(weights, counts of the map): every task learns online over its words; averages of all."""

    def run(batches):
        mixer, n = Mixer(held.value), 0
        for batch in batches:
            for _, words in _word_parts(batch, 4000):
                mixer.learn(words)
                n += len(words)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(n)]), pa.array([mixer.weights.ravel().tolist()]),
                 pa.array([mixer.seen.ravel().tolist()])],
                names=["n", "weights", "seen"],
            )
        mixer = batch = words = None
        give_back()

    parts = vocabulary.where("c > 0 AND length(word) > 1").select("word")
    rows = parts.mapInArrow(run, "n double, weights array<double>, seen array<double>").collect()
    plain = Mixer(held.value)
    if not rows:
        return plain.weights, plain.seen
    total = sum(r["n"] for r in rows)
    weights = sum(np.array(r["weights"]) * r["n"] for r in rows) / total
    seen = sum(np.array(r["seen"]) for r in rows)
    return weights.reshape(plain.weights.shape), seen.reshape(plain.seen.shape)


def spelled(vocabulary: DataFrame, held: Broadcast, trained: tuple) -> DataFrame:
    """``vocabulary`` (word, c, among others) with ``spell``, the log10 probability of its letters."""

    def run(batches):
        mixer = Mixer(held.value)
        mixer.weights, mixer.seen = trained
        mixer.freeze()
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for at, words in _word_parts(batch):
                out[at : at + len(words)] = mixer.score(words)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*names, "spell"])
        mixer = batch = words = out = None
        give_back()

    names = vocabulary.columns
    return vocabulary.mapInArrow(run, "word binary, c bigint, all_c bigint, spell double")


# Words of texts


def _raw(texts: pa.Array) -> list[bytes]:
    """The bytes of texts, A-Z lower-cased."""
    return [t.lower() for t in _listed(texts.cast(pa.binary()))]


def letter_pairs(raw: bytes) -> np.ndarray:
    """Square roots of the shares of hashed pairs of letters of the whole text, lower-cased."""
    return _letter_pairs([raw])[0]


def _letter_pairs(raws: list[bytes]) -> np.ndarray:
    """``letter_pairs`` of some texts, few at once for little memory."""
    out = np.full((len(raws), PAIRS), PAIRS**-0.5)
    for at in range(0, len(raws), PAIRED):
        some = raws[at : at + PAIRED]
        sizes = np.fromiter(map(len, some), np.int64, len(some))
        x = np.frombuffer(b"".join(some) + b" ", np.uint8).astype(np.uint16)
        # Products may wrap: PAIRS divides what they wrap at.
        pair = (x[:-1] * np.uint16(167) + x[1:] * np.uint16(31)) & np.uint16(PAIRS - 1)
        place = np.repeat(np.arange(len(some)) * PAIRS, sizes) + pair
        counts = np.bincount(place, minlength=len(some) * PAIRS)
        # The last letter of a text makes no pair with what comes after it.
        counts -= np.bincount(place[np.cumsum(sizes)[sizes > 0] - 1], minlength=len(counts))
        long = sizes > 1
        out[at : at + PAIRED][long] = np.sqrt(counts.reshape(-1, PAIRS)[long] / (sizes[long, None] - 1))
    return out


def weighted_centres(
    x: np.ndarray, weight: np.ndarray, most: int, rounds: int, by_weight: bool
) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` unit centres of unit vectors by spherical k-means, and the weight of each.

    The first is the one nearest the mean; each further start is the vector farthest from all before it or,
    ``by_weight``, that with the most weight times squared distance.
    """
    first = int(np.argmax(x @ (weight @ x)))
    starts, near = [first], x @ x[first]
    while len(starts) < min(most, len(x)):
        far = np.maximum(1 - near, 0)
        far = weight * far**2 if by_weight else far
        k = int(np.argmax(far))
        if far[k] <= 1e-6:  # what is left equals a start
            break
        starts.append(k)
        near = np.maximum(near, x @ x[k])
    centres = x[starts]
    for _ in range(rounds):
        of = np.argmax(x @ centres.T, 1)
        for k in range(len(centres)):
            mine = of == k
            if mine.any():
                centres[k] = weight[mine] @ x[mine]
        centres /= np.linalg.norm(centres, axis=1, keepdims=True) + 1e-12
    of = np.argmax(x @ centres.T, 1)
    held = np.bincount(of, weight, len(centres))
    return centres[held > 0], held[held > 0]


def find_classes(docs: DataFrame) -> np.ndarray:
    """Centres (at most CLASSES x PAIRS) of all training texts.

    A task sums its texts up in CENTRES weighted centres, outlying ones first, so that a rare language keeps
    one; those of MERGED tasks are summed up again, twice over, and the few that are left become the classes.
    """
    schema = "task int, weight double, x array<float>"

    def rows(task: int, x: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([task] * len(x), pa.int32()), pa.array(weight, pa.float64()),
             pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))],
            names=["task", "weight", "x"],
        )

    def run(batches):
        x, weight = np.empty((0, PAIRS), np.float32), np.empty(0)
        for batch in batches:
            for at in range(0, batch.num_rows, SUMMED):
                more = _letter_pairs(_raw(batch.column("text").slice(at, SUMMED)))
                x = np.concatenate([x, more.astype(np.float32)])
                weight = np.concatenate([weight, np.ones(len(more))])
                x, weight = weighted_centres(x, weight, CENTRES, 2, False)
        if len(x):
            yield rows(TaskContext.get().partitionId(), x, weight)

    def merge(key, table):
        x, weight = _stacked(table.column("x").to_pylist(), table.column("weight").to_pylist())
        x, weight = weighted_centres(x, weight, CENTRES, 5, False)
        return pa.Table.from_batches([rows(key[0].as_py(), x, weight)])

    found = docs.where("learn").select("text").mapInArrow(run, schema)
    for _ in range(2):
        found = found.withColumn("task", (F.col("task") / MERGED).cast("int"))
        found = found.groupBy("task").applyInArrow(merge, schema)
    # Bounded: CENTRES rows for each MERGED * MERGED tasks.
    found = found.orderBy("task", F.desc("weight"), "x").collect()
    if not found:
        return np.full((1, PAIRS), PAIRS**-0.5)
    x, weight = _stacked([r["x"] for r in found], [r["weight"] for r in found])
    return weighted_centres(x, weight, CLASSES, 20, True)[0]


def _stacked(x: list, weight: list) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and weights in an order of their own, whichever way they came."""
    x, weight = np.array(x, float), np.array(weight, float)
    order = np.lexsort((*x.T[:8], weight))
    return x[order], weight[order]


def _runs(hit: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """How many hits in a row come right before each place; a new text starts at 0."""
    n = np.arange(len(hit))
    miss = np.maximum.accumulate(np.where(~hit, n, -1))
    start = np.maximum.accumulate(np.where(fresh, n, -1))
    last = np.concatenate([[-1], miss[:-1]])
    return n - np.maximum(last + 1, start)


def _order(*keys: np.ndarray) -> np.ndarray:
    """Stable order by keys of at least -1, the last one first: by digits of 16 bits, which numpy sorts fastest."""
    digits = []
    for k in keys:
        k = k + 1
        digits += [(k >> s).astype(np.uint16) for s in range(0, max(int(k.max()).bit_length(), 1), 16)]
    return np.lexsort(digits)


def repeats(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(state after two words, hit, state after one word, hit) of each word.

    ``ids`` numbers the words of some texts one after another, ``text`` says whose each is. State
    0 means that the context is new, or that both contexts foretell the same; else it is 1 and
    the bucket of the run of hits.
    """
    n = len(ids)
    fresh = np.ones(n, bool)
    fresh[1:] = text[1:] != text[:-1]
    one = np.full(n, -1, np.int64)
    one[1:] = np.where(fresh[1:], -1, ids[:-1])
    two = np.full(n, -1, np.int64)
    two[2:] = np.where(fresh[2:] | fresh[1:-1], -1, ids[:-2])
    out, foretold = [], None
    for keys in ((two, one, text), (one, text)):
        order = _order(*keys[:-1])  # of one key in the order of their places, and so of texts
        same = np.ones(n - 1, bool)
        for k in keys:
            k = k[order]
            same &= k[1:] == k[:-1]
        before = np.full(n, -1, np.int64)
        before[order[1:][same]] = order[:-1][same]
        guess = np.where(before >= 0, ids[before], -1)
        hit = guess == ids
        run = _runs(hit, fresh)
        bucket = np.minimum(np.ceil(np.log2(run + 1)).astype(np.int64), RUNS - 1)
        state = np.where(guess >= 0, bucket + 1, 0)
        if foretold is not None:
            state = np.where(guess == foretold, 0, state)
        hit &= state > 0
        out += [state, hit]
        foretold = guess
    return tuple(out)


def own_shares(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weight of the text's own words at each place, that times the word's share of them)."""
    n = len(ids)
    place = np.arange(n)
    starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    so_far = place - np.repeat(starts, np.diff(np.concatenate([starts, [n]])))
    order = _order(ids)  # of one word in the order of their places, and so of texts
    new = np.ones(n, bool)
    sorted_ids, sorted_text = ids[order], text[order]
    new[1:] = (sorted_ids[1:] != sorted_ids[:-1]) | (sorted_text[1:] != sorted_text[:-1])
    first = np.maximum.accumulate(np.where(new, place, 0))
    times = np.empty(n, np.int64)
    times[order] = place - first
    weight = SHARE * so_far / (so_far + LATER)
    return weight, weight * np.maximum(times - LESS, 0) / np.maximum(so_far, 1)


def _coded(texts: pa.Array, centres: np.ndarray):
    """(distinct keys, number of each word's key, number of its text, bytes of each text).

    A key is the text's class as a byte, then the word; the end is a class alone.
    """
    raws = _raw(texts)
    kinds = _kinds(raws, centres)
    flat, blank, starts, ends, text = contexts.cut_words(raws)
    lengths, text = contexts.with_ends(ends - starts, text, len(raws))
    # Letters without blanks lie as Arrow has them.
    buffers = [None, pa.py_buffer(np.append(0, np.cumsum(lengths))), pa.py_buffer(flat[~blank])]
    coded = pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers).dictionary_encode()
    # A word is numbered once for each class that has it.
    n = len(coded.dictionary)
    ids = kinds[text] * n + coded.indices.to_numpy()
    used = np.zeros(len(centres) * n, np.int64)
    used[ids] = 1
    number = np.cumsum(used) - 1
    kind, word = np.divmod(np.flatnonzero(used), n)
    heads = pa.array([bytes([k]) for k in range(len(centres))], pa.large_binary())
    none = pa.scalar(b"", pa.large_binary())
    keys = pc.binary_join_element_wise(heads.take(pa.array(kind)), coded.dictionary.take(pa.array(word)), none)
    return keys, number[ids], text, np.fromiter(map(len, raws), np.int64, len(raws))


def _numbered(texts: pa.Array, centres: np.ndarray):
    """``_coded`` with keys as bytes."""
    keys, *found = _coded(texts, centres)
    return _listed(keys), *found


def _counted(docs: DataFrame, centres: np.ndarray) -> DataFrame:
    """(kind, word, c, n): of words, training and all occurrences, added up within a task.

    Kinds 2 and 1 are states after two and one words, with hits and occurrences in training texts.
    """

    def rows(kind: int, words, c, n):
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(words), pa.int32()), words.cast(pa.binary()),
             pa.array(c, pa.int64()), pa.array(n, pa.int64())],
            names=["kind", "word", "c", "n"],
        )

    def summed(parts: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("c", "sum")])
        return sums.rename_columns({"c_sum": "c"}).select(["word", "c"])

    def told(counts: pa.Table):
        for part in counts.combine_chunks().to_batches():
            yield rows(0, part.column("word"), part.column("c"), [0] * part.num_rows)

    def run(batches):
        parts: list[pa.Table] = []
        held = 0
        states = np.zeros((2, RUNS + 1, 2), np.int64)
        for batch in batches:
            texts, learn = batch.column("text"), batch.column("learn").to_numpy(False)
            for at in range(0, len(texts), 500):
                words, ids, text, _ = _coded(texts.slice(at, 500), centres)
                mine = learn[at : at + 500][text]
                c = np.bincount(ids, mine, len(words)).astype(np.int64)
                parts.append(pa.table({"word": words, "c": c}))
                held += len(words)
                found = repeats(ids, text)
                for k in (0, 1):
                    state, hit = found[2 * k], found[2 * k + 1]
                    use = mine if not k else mine & ~found[1]
                    for j, part in enumerate((use & hit, use)):
                        states[k, :, j] += np.bincount(state[part], minlength=RUNS + 1)
                if held > 2 * COUNTED:
                    parts = [summed(parts)]
                    held = parts[0].num_rows
                    if held > COUNTED:
                        yield from told(parts[0])
                        parts, held = [], 0
        if parts:
            yield from told(summed(parts))
        for k in (0, 1):
            keys = pa.array([bytes([s]) for s in range(RUNS + 1)])
            yield rows(2 - k, keys, states[k, :, 0], states[k, :, 1])
        parts = batch = texts = words = ids = text = learn = mine = found = c = None
        give_back()

    return docs.select("text", "learn").mapInArrow(run, "kind int, word binary, c bigint, n bigint")


def _kinds(raws: list[bytes], centres: np.ndarray) -> np.ndarray:
    """The class of each text."""
    return np.argmax(_letter_pairs(raws) @ centres.T, 1)


def _told(batches, centres: np.ndarray):
    """Yield (hashes of the words before, hash, class) of each word, some texts at a time."""
    for batch in batches:
        texts = batch.column("text")
        for at in range(0, len(texts), 100):
            raws = _raw(texts.slice(at, 100))
            word, text = contexts.hashed_words(raws)
            kind = _kinds(raws, centres).astype(np.uint8)[text]
            yield contexts.hashed_contexts(word, kind, text), word, kind


def context_tables(docs: DataFrame, centres: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Counts of the bits after one and after two words, over all occurrences in the training texts.

    After them, the training words by class and code.
    """
    leaves = len(centres) * contexts.LEAVES
    schema = "span int, part int, counts binary"
    types = pa.schema([("span", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])

    def fill(batches):
        tables = [*contexts.empty_counts(), np.zeros(leaves, np.int64)]
        for before, word, kind in _told(batches, centres):
            contexts.count_codes(tables[:-1], before, word)
            tables[-1] += np.bincount(contexts.leaf(word, kind), minlength=leaves)
        for span, table in enumerate(tables):
            table = contexts.slot_counts(table) if span < contexts.SPANS else table
            for part, at in enumerate(range(0, len(table), contexts.PART)):
                counts = table[at : at + contexts.PART]
                if counts.any():
                    columns = [[span], [part], [contexts.packed(counts)]]
                    yield pa.RecordBatch.from_pydict(dict(zip(types.names, columns, strict=True)), types)
        tables = table = counts = before = word = kind = None
        give_back()

    def add(key, table):
        shares = key[0].as_py() == contexts.SPANS
        total = np.zeros(leaves if shares else contexts.PART, np.int64)
        for raw in table.column("counts"):
            total += contexts.unpacked(raw.as_py(), len(total), np.int64)
        raw = contexts.packed(total if shares else contexts.eight_bits(total))
        return pa.table([pa.array([x.as_py()], pa.int32()) for x in key] + [pa.array([raw])], schema=types)

    found = docs.where("learn").select("text").mapInArrow(fill, schema)
    # Bounded: the parts of all tables, at most 16 MB together.
    rows = found.groupBy("span", "part").applyInArrow(add, schema).collect()
    out = [np.zeros(1 << contexts.SLOTS, np.uint16) for _ in range(contexts.SPANS)]
    counts = np.zeros(leaves, np.int64)
    for r in rows:
        at, raw = r["part"] * contexts.PART, bytes(r["counts"])
        if r["span"] == contexts.SPANS:
            counts = contexts.unpacked(raw, leaves, np.int64)
        else:
            out[r["span"]][at : at + contexts.PART] = contexts.unpacked(raw, contexts.PART, np.uint16)
    return out, counts.reshape(len(centres), contexts.LEAVES)


def train_contexts(docs: DataFrame, centres: np.ndarray, held: Broadcast) -> tuple:
    """(weights, counts of the map): every task learns online over its training texts; averages of all."""

    def run(batches):
        mixer, n = contexts.ContextMixer(*held.value), 0
        for before, word, kind in _told(batches, centres):
            mixer.learn(before, word, kind)
            n += len(word)
        if n:
            values = np.concatenate([mixer.weights.ravel() * n, mixer.seen.ravel()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values) + 1)), pa.array(np.append(values, n))], names=["place", "value"]
            )
        mixer = before = word = kind = None
        give_back()

    found = docs.where("learn").select("text").mapInArrow(run, "place bigint, value double")
    # Bounded: one row for each weight and count, and one for the number of words.
    rows = found.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
    plain = contexts.ContextMixer(*held.value)
    if not rows:
        return plain.weights, plain.seen
    *values, n = (r["value"] for r in rows)
    size = plain.weights.size
    weights = np.array(values[:size]) / n
    return weights.reshape(plain.weights.shape), np.array(values[size:]).reshape(plain.seen.shape)


def least_count(words: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach, within an eighth of a power of two."""
    step = F.floor(F.log2("c") * 8).cast("int").alias("step")
    # Some 500 rows at most: eight for each power of two.
    steps = words.where("c > 0").groupBy(step).agg(F.count("*").alias("n"), F.min("c").alias("c"))
    least = (1 << 63) - 1
    for r in steps.orderBy(F.desc("step")).collect():
        most -= r["n"]
        if most < 0:
            break
        least = r["c"]
    return least


def score_texts(docs: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte).

    ``learn`` says by doc_id which texts are learned from. One row for each row of ``docs``, repeated
    ones and those without id too (these are not learned from). A null or empty text is one end.
    Without a training text every word costs what its letters cost at even odds.
    """
    learns = F.coalesce(learn, F.lit(False)) & F.col("doc_id").isNotNull()
    plain = texts_of(docs).withColumn("learn", learns)
    centres = find_classes(plain)
    counted = materialize(
        _counted(plain, centres)
        .groupBy("kind", "word")
        .agg(F.sum("c").alias("c"), F.sum("n").alias("n")),
        "words",
    )
    states = np.full((2, RUNS + 1, 2), 0.0)
    for r in counted.where("kind > 0").collect():
        states[2 - r["kind"], r["word"][0]] = r["c"], r["n"]
    hits = (states[:, :, 0] + 0.2) / (states[:, :, 1] + 1.0)
    hits[:, 0] = 0.0  # nothing foretold
    # A word has one row for each class.
    bare = F.expr("substring(word, 2)")
    vocabulary = counted.where("kind = 0").select(
        "word", "c", F.sum("c").over(Window.partitionBy(bare)).alias("all_c")
    )
    vocabulary = materialize(vocabulary, "vocabulary")
    kind = F.expr("hex(substring(word, 1, 1))")
    totals = vocabulary.groupBy(kind.alias("kind")).agg(
        F.sum("c").alias("n"),
        F.sum((F.col("c") == 1).cast("long")).alias("once"),
    )
    totals = {r["kind"]: (r["n"], r["once"]) for r in totals.collect()}  # CLASSES rows
    n = sum(x for x, _ in totals.values())
    v = vocabulary.where("all_c > 0").select(bare.alias("bare")).distinct().count()
    broadcast = docs.sparkSession.sparkContext.broadcast
    linked, leaves = context_tables(plain, centres)
    model = broadcast((linked, *contexts.share_tree(leaves, OTHER)))  # fixed size
    linked = train_contexts(plain, centres, model)
    tables = broadcast(bit_tables(vocabulary))  # fixed size
    words = spelled(vocabulary, tables, train_mixer(vocabulary, tables))
    base = F.log10((F.col("all_c") + 1) / F.lit(float(n + v + 1)))
    new, size = F.lit(0.5), F.lit(1.0)
    for k, (of, once) in totals.items():
        # The share of new words among a class's words when each is left out in turn.
        new = F.when(kind == k, F.lit((once + 1) / (of + 2))).otherwise(new)
        size = F.when(kind == k, F.lit(float(max(of, 1)))).otherwise(size)
    share = (1 - OTHER) * F.col("c") / size + OTHER * F.col("all_c") / F.lit(float(max(n, 1)))
    # The probability as a known word, before its contexts, and log10 of that as a new one.
    known, letters = ((1 - new) * share).alias("known"), (F.col("spell") + F.log10(new)).alias("letters")
    words = materialize(words.select("word", "c", "all_c", base.alias("base"), known, letters), "costs")
    tables.destroy()
    # Bounded: FREQUENT words.
    top = words.where(F.col("c") >= least_count(words, FREQUENT)).select("word", "all_c", "base", "known", "letters")
    held, facts = {}, array("d")
    for w, *x in top.toLocalIterator():
        held[bytes(w)] = len(held)
        facts.extend(x)
    # The last row is that of words not held.
    facts = np.append(np.frombuffer(facts), np.zeros(4)).reshape(-1, 4)
    frequent = broadcast((held, facts))
    del held, facts
    fields = "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, part double"
    fields += ", n_bytes bigint, word binary, n bigint, rest array<float>, own array<float>, ratio array<float>"

    def run(batches):
        (known, costs), mixer = frequent.value, contexts.ContextMixer(*model.value)
        mixer.weights, mixer.seen = linked
        row = TaskContext.get().partitionId() << 40
        with np.errstate(divide="ignore"):
            yes, no = np.log10(hits), np.log10(1 - hits)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for at in range(0, len(texts), 500):
                some = texts.slice(at, 500)
                words, numbers, text, n_bytes = _numbered(some, centres)
                found = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
                rare, facts = found < 0, costs[found]
                state2, hit2, state1, hit1 = repeats(numbers, text)
                miss = ~hit2 & ~hit1
                weight, own = own_shares(numbers, text)
                at_miss = np.flatnonzero(miss)
                word = contexts.key_hashes(words)[numbers]
                kind = np.fromiter((w[0] for w in words), np.uint8, len(words))[numbers]
                before = [x[at_miss] for x in contexts.hashed_contexts(word, kind, text)]
                ratio = np.ones(len(text))
                ratio[at_miss] = np.exp(mixer.ratios(before, word[at_miss], kind[at_miss], text[at_miss]))
                before = word = kind = None
                # As they travel to the join, where the costs of rare words are worked out.
                rest, own, ratio = (x.astype(np.float32) for x in (1 - weight, own, ratio))
                spelled_ = miss & ~rare[numbers]
                cost = np.where(hit2, yes[0][state2], no[0][state2])
                cost = cost + np.where(
                    hit2, 0.0, np.where(hit1, yes[1][state1], no[1][state1])
                )
                mine, one = numbers[spelled_], rest[spelled_].astype(float)
                part = facts[mine, 2] * ratio[spelled_] + 10.0 ** facts[mine, 3]
                with np.errstate(divide="ignore"):
                    part = np.log10(one * part + own[spelled_])
                # Never below the letters alone, which need no power of ten.
                cost[spelled_] += np.maximum(part, np.log10(one) + facts[mine, 3])
                size = len(some)
                total = lambda x: np.bincount(text, x, size)  # noqa: E731, B023
                first = np.arange(row, row + size)
                row += size
                none = pa.nulls(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first), ids.slice(at, 500),
                     pa.array(np.bincount(text, minlength=size)),
                     pa.array(total(facts[numbers, 0] > 0).astype(np.int64)),
                     pa.array(total(facts[numbers, 1])), pa.array(total(cost)),
                     pa.array(n_bytes),
                     *[none.cast(t) for t in types[7:]]],
                    names=names,
                )
                where = np.flatnonzero(rare[numbers])
                if not len(where):
                    continue
                keys = text[where] * len(words) + numbers[where]
                keys, back = np.unique(keys, return_inverse=True)
                count = len(keys)
                none = pa.nulls(count)
                late = np.flatnonzero(miss[where])
                late = late[np.argsort(back[late], kind="stable")]
                ends = np.cumsum(np.bincount(back[late], minlength=count))
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(x[where][late]))
                    for x in (rest, own, ratio)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first[keys // len(words)]), *[none.cast(t) for t in types[1:7]],
                     pa.array([words[k] for k in (keys % len(words)).tolist()], pa.binary()),
                     pa.array(np.bincount(back, minlength=count)), *lists],
                    names=names,
                )
        known = costs = mixer = batch = texts = words = found = facts = None
        give_back()

    names = [f.split()[0] for f in fields.split(", ")]
    types = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.int64(), pa.binary(), pa.int64()]
    types += [pa.list_(pa.float32())] * 3
    seen = materialize(plain.select("doc_id", "text").mapInArrow(run, fields), "scored")
    model.destroy()
    frequent.destroy()
    # Each occurrence of a rare word that was not foretold, as above.
    cost = (
        "greatest(log10({0}rest{1} * (known * {0}ratio{1} + pow(10D, letters)) + {0}own{1}), "
        "log10({0}rest{1}) + letters)"
    )
    # Most words are rare in the text, too: a single one needs no loop.
    late = F.expr(
        f"if(size(rest) = 1, {cost.format('', '[0]')}, "
        f"aggregate(arrays_zip(rest, own, ratio), 0D, (sum, x) -> sum + {cost.format('x.', '')}))"
    )
    rest = (
        seen.where("word IS NOT NULL")
        .select("row", "word", "n", "rest", "own", "ratio")
        .join(words, "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("all_c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
            F.sum(F.col("n") * F.col("base")).alias("more_base"),
            F.sum(late).alias("more_part"),
        )
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    score = F.col("part") + zero("more_part") - F.lit(math.log10(len(centres)))
    return (
        seen.where("word IS NULL")
        .drop("word", "n", "rest", "own", "ratio")
        .join(rest, "row", "left")
        .select(
            "doc_id",
            "n_tokens",
            (F.col("n_known") + zero("more_known")).alias("n_known"),
            F.lit(n).cast("bigint").alias("train_tokens"),
            (F.col("base") + zero("more_base")).alias("base_score"),
            score.alias("score"),
            "n_bytes",
            F.when(F.col("n_bytes") > 0, -score * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"),
        )
    )
