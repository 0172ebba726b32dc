"""Collocations of two and three words, counted in burst tries of hash containers.

Counting (``phrase_counts``): each task numbers the words it meets and counts all words, pairs and triples
of its texts in a ``Trie``. A shallow index over word ids leads to hash containers; a container that grows
too large bursts in two, between two first words where it has several, else between two second or third
words. When the trie is full, its subtrees are spilled whole, as sorted runs of the prefix partition
(language, first two words) they belong to, each with its own list of words. Runs of a
partition are merged by one task; a partition that grew too large is dealt once more by the whole
phrase, so one frequent prefix never meets in one task. Nothing is estimated: counts are exact.

Scoring (``collocations``): plain joins and sums over the phrases that reach the least count, a small part
of all; joins of a frequent word are sliced.

Defined cases: a null text is empty, a null language is ``und``; upper-case letters other than A to Z stay;
repeated rows count again; an empty table gives no rows; further columns are ignored. A text of any
length is read in windows that share their last two words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairstats.llm.common import give_back
from pairstats.operators.counts import slice_hot
from pairstats.operators.select import best_rows
from pairstats.sinks.stage import materialize

# What ends a piece, and what parts the words of a piece (as bytes).
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Words of the longest phrase.
LONGEST = 3
#: Phrases below this count are no candidates.
LEAST = 10
#: Results for each language.
BEST = 2_000

#: Bytes of text taken at once.
WINDOW = 1_000_000
#: Entries of a container before it bursts, and of a trie before it is spilled.
BURST, FULL = 1 << 16, 1_000_000
#: Bits of a word id in a code; words of a task before it spills and starts afresh.
BITS = 21
MASK = (1 << BITS) - 1
WORDS = 300_000
#: Bytes of text for each prefix partition, and the most partitions.
PARTITION_BYTES, PARTITIONS = 8_000_000, 512
#: Entries of a partition above which it is dealt again.
LARGE = 3_000_000
#: A part of more cuts than this share of all, and than this number, is joined in slices.
HOT_SHARE, HOT_CUTS = 1_000, 1_000

_RUN = "lang string, part int, entries bigint, words binary, ids binary, counts binary"
_COUNTS = "lang string, phrase string, size int, f bigint"

#: Every end of a piece becomes one byte that no UTF-8 text holds; letters A to Z become small.
_GAP = b"\xff"
_TABLE = bytes(
    0xFF if c in ENDS else 0x20 if c in BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


class Words(dict):
    """Ids of the words of one language; all languages of a task count on in the same lists.

    ``names`` holds the words by their ids, ``langs`` the numbers of their languages; id 0 is a gap.
    """

    def __init__(self, lang: int, names: list[bytes], langs: list[int]) -> None:
        self.lang, self.names, self.langs = lang, names, langs
        self[_GAP] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        self.langs.append(self.lang)
        return n


class Container:
    """Counts of codes in a hash table of open places; code 0 marks a free one."""

    def __init__(self, bits: int = 10) -> None:
        self.clear(bits)

    def clear(self, bits: int = 10) -> None:
        self.bits, self.used = bits, 0
        self.codes = np.zeros(1 << bits, np.int64)
        self.counts = np.zeros(1 << bits, np.int64)

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        """Add counts of distinct codes."""
        if (self.used + len(codes)) * 2 > len(self.codes):
            old = self.items()
            need = (self.used + len(codes)) * 3
            self.clear(max(10, int(need - 1).bit_length()))
            self._put(*old)
        self._put(codes, counts)

    def _put(self, codes: np.ndarray, counts: np.ndarray) -> None:
        mask = len(self.codes) - 1
        mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        place = (mixed >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(codes):
            there = self.codes[place]
            free = there == 0
            self.codes[place[free]] = codes[free]
            # Of several codes for one free place the last is in it; the others go on.
            mine = self.codes[place] == codes
            self.counts[place[mine]] += counts[mine]
            self.used += int((mine & free).sum())
            rest = ~mine
            codes, counts, place = codes[rest], counts[rest], (place[rest] + 1) & mask

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        taken = self.codes != 0
        return self.codes[taken], self.counts[taken]


class Trie:
    """Hash containers under an index of prefixes; the containers in order cover all codes.

    A code holds up to three word ids, the first in front, so a prefix is a range of codes.
    """

    def __init__(self, burst: int = BURST) -> None:
        self.burst = burst
        self.starts, self.containers = [0], [Container()]

    def __len__(self) -> int:
        return sum(c.used for c in self.containers)

    def add(self, codes: np.ndarray) -> None:
        """Count codes, in any order and repeated."""
        codes, counts = np.unique(codes, return_counts=True)
        cuts = np.append(np.searchsorted(codes, np.array(self.starts)), len(codes))
        for i in range(len(self.containers) - 1, -1, -1):
            a, b = cuts[i], cuts[i + 1]
            if a < b:
                self.containers[i].add(codes[a:b], counts[a:b])
                if self.containers[i].used > self.burst:
                    self._burst(i)

    def _burst(self, i: int) -> None:
        """Cut a container in two at its middle, between first words if it holds several."""
        codes, counts = self.containers[i].items()
        order = np.argsort(codes)
        codes, counts = codes[order], counts[order]
        for level in (2 * BITS, BITS, 0):
            prefixes = codes >> level
            if prefixes[0] != prefixes[-1]:
                break
        middle = prefixes[len(codes) // 2]
        if middle == prefixes[0]:
            middle = prefixes[np.searchsorted(prefixes, middle, "right")]
        cut = int(np.searchsorted(prefixes, middle))
        self.containers[i].clear()
        self.containers[i].add(codes[:cut], counts[:cut])
        further = Container()
        further.add(codes[cut:], counts[cut:])
        self.starts.insert(i + 1, int(middle) << level)
        self.containers.insert(i + 1, further)
        # A half may still be too large where one batch brought very much.
        for j in (i + 1, i):
            if self.containers[j].used > self.burst and self.containers[j].used > 1:
                self._burst(j)

    def spill(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yield each subtree as (sorted codes, counts), and empty the trie; a table goes as its subtree comes."""
        containers = self.containers[::-1]
        self.starts, self.containers = [0], [Container()]
        while containers:
            codes, counts = containers.pop().items()
            order = np.argsort(codes)
            yield codes[order], counts[order]


def windows(texts: Iterable[bytes]) -> Iterator[bytes]:
    """Translated texts, a gap after each, joined or cut to some ``WINDOW`` bytes.

    A text is cut in front of a blank or gap alone.
    """
    held, size = [], 0
    for text in texts:
        if size + len(text) > WINDOW and held:
            yield _GAP.join(held) + _GAP
            held, size = [], 0
        if len(text) <= WINDOW:
            held.append(text.translate(_TABLE))
            size += len(text)
            continue
        text = text.translate(_TABLE)
        at = 0
        while len(text) - at > WINDOW:
            places = [p for p in (text.find(b" ", at + WINDOW), text.find(_GAP, at + WINDOW)) if p >= 0]
            if not places:
                break
            yield text[at : min(places)]
            at = min(places)
        yield text[at:] + _GAP
    if held:
        yield _GAP.join(held) + _GAP


def codes_of(window: bytes, words: Words, carried: tuple[int, int]) -> tuple[np.ndarray, tuple]:
    """Codes of all phrases that end in a window, and its last two ids (0: a gap) for the next."""
    found = window.replace(_GAP, b" \xff ").split()
    ids = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
    ids = np.concatenate([np.array(carried, np.int64), ids])
    first, second, third = ids[:-2], ids[1:-1], ids[2:]
    here = third > 0
    pair = here & (second > 0)
    triple = pair & (first > 0)
    codes = np.concatenate(
        [
            third[here] << 2 * BITS,
            second[pair] << 2 * BITS | third[pair] << BITS,
            first[triple] << 2 * BITS | second[triple] << BITS | third[triple],
        ]
    )
    return codes, (int(ids[-2]), int(ids[-1]))


def _pack(ids: np.ndarray, counts: np.ndarray, names: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """A run: its words, the numbers of each phrase's words in that list (0: none), the counts.

    ``ids`` has a row for each place of a word, sorted; the first words are kept as their steps.
    """
    import zstandard

    press = zstandard.ZstdCompressor(level=1).compress
    kind = np.uint16 if len(names) < 65_535 else np.uint32
    steps = np.diff(ids[0], prepend=0)
    count = np.uint8 if counts.max() < 256 else np.int64
    return (
        press(b" ".join(names)),
        press(np.stack([steps, ids[1], ids[2]]).astype(kind).tobytes()),
        press(counts.astype(count).tobytes()),
    )


def _unpack(words: bytes, ids: bytes, counts: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    names = expand(words).split(b" ")
    kind = np.uint16 if len(names) < 65_535 else np.uint32
    numbers = np.frombuffer(expand(ids), kind).astype(np.int64).reshape(LONGEST, -1)
    numbers[0] = np.cumsum(numbers[0])
    counts = expand(counts)
    count = np.uint8 if len(counts) == numbers.shape[1] else np.int64
    return names, numbers, np.frombuffer(counts, count).astype(np.int64)


def _mix(*hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(hashes[0]), np.uint64)
    for h in hashes:
        out = (out ^ h.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _groups(keys: np.ndarray) -> Iterator[np.ndarray]:
    """Places of equal keys, each group in the order it had."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    yield from (g for g in np.split(order, cuts) if len(g))


def _local(ids: np.ndarray, names: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Word ids as numbers in a list of the words in use alone; 0 stays 0."""
    used, numbers = np.unique(ids, return_inverse=True)
    numbers = numbers.reshape(ids.shape)
    if used[0] == 0:
        return numbers, [names[i] for i in used[1:].tolist()]
    return numbers + 1, [names[i] for i in used.tolist()]


def _runs(trie: Trie, names: list, langs: list, partitions: int) -> Iterator[tuple]:
    """The trie's subtrees as rows of sorted runs, one for each language and prefix partition."""
    hashes = np.fromiter(map(zlib.crc32, names), np.uint64, len(names))
    numbers = np.array(langs)
    every, n, keys = [], [], []
    for codes, counts in trie.spill():
        first = codes >> 2 * BITS
        part = _mix(hashes[first], hashes[codes >> BITS & MASK]) % np.uint64(partitions)
        every.append(codes)
        n.append(counts)
        keys.append(numbers[first] * partitions + part.astype(np.int64))
    del hashes, numbers
    codes, counts, key = np.concatenate(every), np.concatenate(n), np.concatenate(keys)
    del every, n, keys
    for group in _groups(key):
        own = codes[group]
        ids, used = _local(np.stack([own >> 2 * BITS, own >> BITS & MASK, own & MASK]), names)
        lang, number = divmod(int(key[group[0]]), partitions)
        yield lang, number, len(group), *_pack(ids, counts[group], used)


def _run_batch(rows: list[tuple]):
    import pyarrow as pa

    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in _RUN.split(", ")]
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _counter(partitions: int):
    """Counts the phrases of a task's texts; yields batches of runs."""

    def run(batches):
        import pyarrow as pa

        trie, names, langs = Trie(), [b""], [0]
        by_lang: dict[str, Words] = {}

        def spill():
            called, rows, size = list(by_lang), [], 0
            for lang, *rest in _runs(trie, names, langs, partitions):
                rows.append((called[lang], *rest))
                size += sum(map(len, rest[2:]))
                if size > 8_000_000:
                    yield _run_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _run_batch(rows)
            rows = None
            give_back()

        for batch in batches:
            languages = batch.column("lang").to_pylist()
            texts = batch.column("text").cast(pa.binary())
            for lang in sorted(set(languages)):
                if lang not in by_lang:
                    by_lang[lang] = Words(len(by_lang), names, langs)
                carried = (0, 0)
                for window in windows(texts[i].as_py() for i, x in enumerate(languages) if x == lang):
                    codes, carried = codes_of(window, by_lang[lang], carried)
                    trie.add(codes)
                    if len(trie) > FULL or len(names) > WORDS:
                        yield from spill()
                    if len(names) > WORDS:
                        last = [names[i] for i in carried]
                        del names[1:], langs[1:]
                        by_lang = {x: Words(w.lang, names, langs) for x, w in by_lang.items()}
                        carried = tuple(by_lang[lang][word] if word else 0 for word in last)
        yield from spill()
        trie = names = langs = by_lang = batch = texts = codes = None
        give_back()

    return run


def _deal_again(batches):
    """Deals runs once more, by the whole phrase; ``pieces`` says into how many."""
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            names, ids, counts = _unpack(row["words"], row["ids"], row["counts"])
            hashes = np.array([0] + [zlib.crc32(n) for n in names], np.uint64)
            # Not the hash that chose the partition, or all would fall together again.
            mixed = _mix(*hashes[ids[::-1]])
            piece = (mixed >> np.uint64(7)) % np.uint64(row["pieces"])
            rows, numbers = [], []
            for group in _groups(piece.astype(np.int64)):
                local, own = _local(ids[:, group], [b"", *names])
                rows.append((row["lang"], row["part"], len(group), *_pack(local, counts[group], own)))
                numbers.append(int(piece[group[0]]))
            out = _run_batch(rows)
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(numbers, pa.int32())], names=[*out.schema.names, "piece"]
            )


def merge_runs(runs: Iterable[tuple[list[bytes], np.ndarray, np.ndarray]]):
    """(words, ids of each phrase, counts) of all runs together; ids count from 1, 0 is none."""
    names, ids, counts = _merged(runs)
    return names, ids if ids.ndim > 1 else _places(ids), counts


def _merged(runs: Iterable[tuple[list[bytes], np.ndarray, np.ndarray]]):
    """``merge_runs`` with one code for each phrase where the words fit its bits, else a row for each place.

    Runs are taken one by one. A phrase is held as one code while the words fit its bits, so that
    memory is some four numbers a phrase.
    """
    index: dict[bytes, int] = {}
    every, counts, wide = [], [], False
    for names, ids, n in runs:
        numbers = np.fromiter(
            (index.setdefault(name, len(index) + 1) for name in names), np.int64, len(names)
        )
        ids = np.concatenate([[0], numbers])[ids]
        if not wide and len(index) > MASK:
            every, wide = [_places(codes) for codes in every], True
        every.append(ids if wide else ids[0] << 2 * BITS | ids[1] << BITS | ids[2])
        counts.append(n)
    del ids
    ids, counts = np.concatenate(every, axis=-1), np.concatenate(counts)
    every.clear()
    order = np.lexsort(ids[::-1]) if wide else np.argsort(ids)
    ids, counts = ids[..., order], counts[order]
    del order
    new = np.diff(ids, axis=-1) != 0
    starts = np.flatnonzero(np.append(True, new.any(axis=0) if wide else new))
    ids = ids[..., starts]
    return list(index), ids, np.add.reduceat(counts, starts)


def _places(codes: np.ndarray) -> np.ndarray:
    """The word ids of codes, a row for each place."""
    out = np.empty((LONGEST, len(codes)), np.int64)
    for row, level in zip(out, (2 * BITS, BITS, 0), strict=True):
        np.right_shift(codes, level, out=row)
        row &= MASK
    return out


def _merger(least: int):
    """Merges the runs of a partition; phrases below ``least`` go, all words add to a total."""

    def merge(table):
        import pyarrow as pa

        columns = [table.column(c) for c in ("words", "ids", "counts")]
        runs = (_unpack(*(c[i].as_py() for c in columns)) for i in range(len(table)))
        names, ids, counts = _merged(runs)
        lang = table.column("lang")[0].as_py()
        single = ids[1] == 0 if ids.ndim > 1 else ids >> BITS & MASK == 0
        total = int(counts[single].sum())
        often = np.flatnonzero(counts >= least)
        # Few phrases are left; only their codes are taken apart.
        ids = ids[..., often]
        ids = ids if ids.ndim > 1 else _places(ids)
        size = (ids > 0).sum(axis=0)
        phrases = [
            b" ".join(names[i - 1] for i in row if i).decode("utf-8", "replace") for row in ids.T.tolist()
        ]
        out = pa.table(
            {
                "lang": pa.array([lang] * (len(often) + 1), pa.string()),
                "phrase": pa.array([None, *phrases], pa.string()),
                "size": pa.array([0, *size.tolist()], pa.int32()),
                "f": pa.array([total, *counts[often].tolist()], pa.int64()),
            }
        )
        names = ids = counts = single = often = phrases = runs = None
        give_back()
        return out

    return merge


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, size, f): phrases of one to three words that occur ``least`` times or more.

    Rows of size 0, with a null phrase, hold numbers of words; their sum is that of a language.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    partitions = min(PARTITIONS, size // PARTITION_BYTES + 1)
    runs = materialize(texts.mapInArrow(_counter(partitions), _RUN), "runs")

    # Partitions beyond a bound are dealt again; their list is short, each stands for that many entries.
    sizes = runs.groupBy("lang", "part").agg(F.sum("entries").alias("all")).where(F.col("all") > LARGE)
    large = materialize(
        sizes.select("lang", "part", F.ceil(F.col("all") * 2 / LARGE).cast("int").alias("pieces")), "large"
    )
    every = runs.withColumn("piece", F.lit(0))
    if not large.isEmpty():
        again = runs.join(large, ["lang", "part"]).mapInArrow(_deal_again, f"{_RUN}, piece int")
        every = every.join(large, ["lang", "part"], "left_anti").unionByName(again)
    merged = every.groupBy("lang", "part", "piece").applyInArrow(_merger(least), _COUNTS)
    return materialize(merged, "phrases")


def _words(phrase: str):
    return F.split(phrase, " ")


def _with_count(cuts: DataFrame, counts: DataFrame, part: str, name: str) -> DataFrame:
    """``cuts`` with the count of the phrase in column ``part``; those of a frequent one in slices."""
    keys = ["lang", part]
    uses = cuts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pairs"))
    named = counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    named = materialize(uses.join(named, keys), "parts")
    rows, most = named.agg(F.sum("n_pairs"), F.max("n_pairs")).first()
    limit = max((rows or 0) // HOT_SHARE, HOT_CUTS)
    if (most or 0) <= limit:
        return cuts.join(named.drop("n_pairs"), keys)
    other = "rest" if part == "front" else "front"
    marked, sliced = slice_hot(cuts, named, keys, other, limit)
    return marked.join(sliced, [*keys, "_slice"]).drop("_slice")


def collocations(docs: DataFrame, best: int = BEST, least: int = LEAST) -> DataFrame:
    """The ``best`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    A phrase is scored at each place it can be cut, by a * a / (l * r) in millionths, rounded down; the
    lowest counts, the first of equal ones. A phrase goes if a longer candidate that holds it has half
    its count or more.
    """
    counts = phrase_counts(docs, least)
    found = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    words = _words("phrase")
    cuts = found.select(
        "lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("front"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " ").alias("rest"),
    )
    cuts = _with_count(_with_count(cuts, counts, "front", "l"), counts, "rest", "r")
    # 38 digits hold a * a * 1,000,000 for counts up to 10 ** 16.
    wide = {c: F.col(c).cast("decimal(16,0)") for c in "alr"}
    million = F.lit(1_000_000).cast("decimal(7,0)")
    score = F.call_function("div", wide["a"] * wide["a"] * million, wide["l"] * wide["r"])
    scored = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    scored = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))

    inner = found.where("size > 2").select(
        "lang",
        F.col("a").alias("longer"),
        F.explode(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        F.sequence(F.lit(2), F.col("size") - 1),
                        lambda n: F.transform(
                            F.sequence(F.lit(1), F.col("size") - n + 1),
                            lambda i: F.array_join(F.slice(words, i, n), " "),
                        ),
                    )
                )
            )
        ).alias("phrase"),
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        "longer IS NULL OR 100 * longer < 50 * a"
    )
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    bucket = F.struct((-F.col("a")).alias("a"), F.substring("phrase", 1, 6).alias("start"))
    ranked = best_rows(
        materialize(kept, "collocations"), "lang", F.col("score"), [F.desc("a"), F.asc("phrase")], bucket, best
    )
    totals = counts.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
