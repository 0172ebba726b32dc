"""Near-duplicate documents by min-max hashing.

Each permutation of the shingles gives two values, its minimum and its maximum, so a signature of
160 values takes 80 hash evaluations for each shingle. Bands of the signature put similar documents into
common buckets. Equal sets are one node from the start. Candidates come in three steps, each over
every bucket, and each candidate is confirmed on the full shingle sets:

1. every member of a bucket with its smallest one,
2. every member with its largest one, where they are not yet connected,
3. in buckets that still hold several components, all pairs of members of different components,
   in blocks of bounded size; sets are compared inside the block, and only pairs that meet the
   threshold leave it.

So a large group of copies costs a row for each member, and no pair of a bucket is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairstats.llm.common import map_texts, small, texts_of
from pairstats.llm.graph import blocks, components
from pairstats.sinks.stage import materialize

WIDTH = 4
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
PERMUTATIONS = 80
#: Values in a band. With 32 bands of 5, a pair at 0.8 is missed with probability 3e-6, one at
#: 0.85 with 5e-9.
ROWS = 5
#: Pairs whose signatures agree in a smaller share are not confirmed: at a similarity of 0.8 the
#: share is below that with probability 1e-8 (160 values, standard deviation 0.032).
LIKELY = 0.62
#: Members of a bucket that one task compares with as many others.
BLOCK = 512

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 400_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[1]
    return x ^ (x >> np.uint64(29))


def shingles(text: str, width: int, known: dict) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles.

    Words are cut at ASCII white space and lower-cased in A-Z only, as ``bytes`` methods do.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - width + 1, 1)
    width = min(width, len(words))
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = _mixed(out * _MIX[0] + h[k : k + n])
    return np.unique(out)


def _signatures(texts: list[str], width: int) -> list[list]:
    """For each text: number of shingles, digest of the set, signature, bands."""
    import xxhash

    rng = np.random.default_rng(20_240_117)
    factor = rng.integers(1, 2**63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 2**63, PERMUTATIONS, np.uint64)
    known = _Hashes()
    sizes, digests, signatures, bands = [], [], [], []
    empty = [0, None, None, None]
    at = 0
    while at < len(texts):
        sets, total = [], 0
        while at < len(texts) and total < 200_000:  # shingles at a time
            sets.append(shingles(texts[at], width, known))
            total += len(sets[-1])
            at += 1
        full = [s for s in sets if len(s)]
        if full:
            flat = np.concatenate(full)
            starts = np.cumsum([0] + [len(s) for s in full[:-1]])
            values = np.empty((len(full), 2 * PERMUTATIONS), np.uint64)
            for k in range(PERMUTATIONS):
                x = (flat ^ shift[k]) * factor[k]
                values[:, 2 * k] = np.minimum.reduceat(x, starts)
                values[:, 2 * k + 1] = np.maximum.reduceat(x, starts)
            # The high bits of a minimum or maximum say little; mixed, any of them do.
            values = _mixed(values)
            # A band takes values of different permutations.
            order = np.arange(2 * PERMUTATIONS).reshape(-1, 2).T.ravel()
            parts = values[:, order].reshape(len(full), -1, ROWS)
            keys = np.broadcast_to(
                np.arange(parts.shape[1], dtype=np.uint64) + np.uint64(1), parts.shape[:2]
            ).copy()
            for k in range(ROWS):
                keys = _mixed(keys * _MIX[2] + parts[:, :, k])
            short = values.astype(np.uint16)
            keys = keys.view(np.int64)
        row = 0
        for s in sets:
            if not len(s):
                rest = empty
            else:
                rest = [len(s), xxhash.xxh128_digest(s.tobytes()), short[row].tobytes(), keys[row]]
                row += 1
            for column, value in zip((sizes, digests, signatures, bands), rest, strict=True):
                column.append(value)
    return [sizes, digests, signatures, bands]


def _likely_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree often enough and whose sizes allow a link."""
    side = lambda x: nodes.select(
        F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}")
    )
    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    rows = rows.where(
        (F.lit(100) * F.least("n_a", "n_b") >= F.lit(PERCENT) * F.greatest("n_a", "n_b"))
    ).select("a", "b", "s_a", "s_b")

    def run(batches):
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(
                    batch.num_rows, -1
                )
                for c in ("s_a", "s_b")
            )
            keep = pa.array((a == b).mean(1) >= LIKELY)
            yield batch.select(["a", "b"]).filter(keep)

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets meet the threshold.

    ``texts`` holds those of documents in a bucket alone; each pair is one row, wherever it is
    computed.
    """
    pairs = materialize(pairs, "candidates")
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "t_a", "t_b")

    def run(batches):
        known, last, left = _Hashes(), None, None
        for batch in batches:
            keep = []
            columns = (batch.column(c) for c in ("t_a", "t_b"))
            for x, y in zip(*columns, strict=True):
                x, y = x.as_py(), y.as_py()
                if x != last:
                    last, left = x, shingles(x, width, known)
                right = shingles(y, width, known)
                both = len(np.intersect1d(left, right, assume_unique=True))
                union = len(left) + len(right) - both
                keep.append(union > 0 and 100 * both >= PERCENT * union)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return materialize(rows.mapInArrow(run, "a bigint, b bigint").distinct(), "confirmed")


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` (band, node) with the component of each node."""
    found = components(links).withColumnRenamed("id", "node")
    return members.join(found, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("component")
    )


def _star(members: DataFrame, largest: bool) -> DataFrame:
    """Each member of a bucket with one end of it, where their components differ."""
    end = (F.max if largest else F.min)(F.struct("node", "component"))
    ends = members.groupBy("band").agg(end.alias("end"))
    pairs = members.join(ends, "band").where("component <> end.component")
    return pairs.select(
        F.least("node", "end.node").alias("a"), F.greatest("node", "end.node").alias("b")
    ).distinct()


def _block_pairs(members: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Pairs of members of a bucket whose components differ, block against block.

    Blocks hold the sets, shortened to 32 bits a shingle, so that only pairs that meet the
    threshold leave them: equal low bits of different shingles can add a pair, never lose one.
    """
    several = members.groupBy("band").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    )
    rows = members.join(several.where("least < most").select("band"), "band")
    rows = materialize(rows, "block_members")
    ids = materialize(rows.select(F.col("node").alias("doc_id")).distinct(), "block_ids")

    def shortened():
        known = _Hashes()
        return lambda texts: [
            [shingles(t, width, known).astype(np.uint32).tobytes() for t in texts]
        ]

    held = texts.join(small(ids), "doc_id", "left_semi").withColumnRenamed("doc_id", "node")
    sets = materialize(map_texts(held, "shingles binary", shortened, per_task=True), "block_sets")
    dealt = blocks(rows.join(sets, "node"), "band", "node", BLOCK)

    def compare(key, table):
        node, component, own = (table.column(c).to_numpy() for c in ("node", "component", "own"))
        raw = table.column("shingles").to_pylist()
        size = np.array([len(x) // 4 for x in raw])
        _, flat = np.unique(np.frombuffer(b"".join(raw), np.uint32), return_inverse=True)
        ends = np.cumsum(size)
        one = np.flatnonzero(own == key[1].as_py())
        two = np.flatnonzero(own == key[2].as_py())
        right = np.concatenate([flat[ends[j] - size[j] : ends[j]] for j in two])
        starts = np.cumsum(size[two]) - size[two]
        marked = np.zeros(flat.max() + 1, np.int32)
        found = [np.empty((0, 2), np.int64)]
        for i in one:
            low, high = np.minimum(size[i], size[two]), np.maximum(size[i], size[two])
            ok = (component[two] != component[i]) & (100 * low >= PERCENT * high)
            if not ok.any():
                continue
            mine = flat[ends[i] - size[i] : ends[i]]
            marked[mine] = 1
            both = np.add.reduceat(marked[right], starts)
            marked[mine] = 0
            ok &= 100 * both >= PERCENT * (size[i] + size[two] - both)
            found += [np.array([[node[i], node[j]]]) for j in two[ok]]
        pairs = np.unique(np.sort(np.concatenate(found), 1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    compared = dealt.groupBy("band", "left", "right").applyInArrow(compare, "a bigint, b bigint")
    return compared.distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``.

    A text with fewer words than ``width`` has one shingle, the whole sequence; a null or empty
    text has none and is linked with nothing. Rows of the same id count as one document: with
    differing texts they are linked. A row without id is linked with nothing, has a null
    component and is kept. An empty table gives an empty result.
    """
    texts = texts_of(docs)
    made = map_texts(
        texts,
        "n int, digest binary, signature binary, bands array<bigint>",
        lambda t: _signatures(t, width),
    )
    made = materialize(made, "signatures")
    full = made.where("n > 0 AND doc_id IS NOT NULL")
    sets = full.groupBy("digest").agg(F.min("doc_id").alias("node"))
    of = materialize(full.select("doc_id", "digest").join(sets, "digest").distinct(), "sets")
    own = of.where("doc_id = node").select("doc_id", "digest")
    # Rows of one id with several texts: all their nodes meet the smallest.
    again = of.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    again = materialize(again.where("a < b").select("doc_id", "a"), "repeated")
    links = of.join(again, "doc_id").where("node <> a").select("a", F.col("node").alias("b"))
    links = materialize(links, "links")
    rows = full.select("doc_id", "digest", "bands").join(own, ["doc_id", "digest"], "left_semi")
    rows = rows.select(F.col("doc_id").alias("node"), F.explode("bands").alias("band"))
    rows = materialize(rows, "bands")
    ends = rows.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    common = ends.where("least < most").select("band")
    members = materialize(rows.join(common, "band").distinct(), "members")
    # From here on, only documents in a bucket with others take part.
    ids = materialize(members.select(F.col("node").alias("doc_id")).distinct(), "bucket_ids")
    ids = small(ids)
    nodes = full.join(ids, "doc_id", "left_semi").select(
        F.col("doc_id").alias("node"), "digest", "n", "signature"
    )
    nodes = materialize(nodes.dropDuplicates(["node", "digest"]), "nodes")
    plain = materialize(texts.join(ids, "doc_id", "left_semi"), "bucket_texts")
    marked = members.withColumn("component", F.col("node"))
    for step in ("smallest", "largest", "blocks"):
        if step == "blocks":
            pairs = _block_pairs(marked, plain, width)
        else:
            pairs = _likely_pairs(_star(marked, step == "largest"), nodes)
        links = materialize(links.union(_confirmed(pairs, plain, width)), "links")
        if step != "blocks":
            marked = materialize(_labelled(members, links), "members")
    found = components(links).withColumnRenamed("id", "node")
    ids = of.groupBy("doc_id").agg(F.min("node").alias("node"))
    ids = ids.join(found, "node", "left").select(
        "doc_id", F.coalesce("component", "node").alias("component")
    )
    out = made.select("doc_id", F.col("n").cast("bigint").alias("n_shingles")).join(
        ids, "doc_id", "left"
    )
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
