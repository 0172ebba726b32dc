"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes where its inner product with it exceeds a threshold. The
directions are a random product code: the rotated space is cut into blocks with a few random
code words each, and every combination of code words is a direction. The inner product is a sum over
blocks, so all exceeding directions of a vector are found by merging sorted block sums instead of trying
each (list decoding). Vectors that share a filter are compared, block against block, by bytes, and verified
in double precision. Each carries the angle that its rounding to bytes turned it by, and two are
verified if the angle of their bytes is within the threshold's and both of these: so, whatever the length and
the components, rounding loses no pair. The number of directions grows with the number of vectors, so that a filter holds
about ``SHARED`` unrelated ones at any size, and so does the number of independent codes, so that a pair at
exactly ``COSINE`` is missed with probability ``MISS`` at most at any size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairstats.llm.graph import blocks, components
from pairstats.sinks.stage import materialize

COSINE = 0.9
#: Filters of a vector in each code (on average), blocks of a code: with more blocks the directions of
#: a code hang together more, and a vector passes many of them or none.
FILTERS, PARTS = 16, 2
SHARED = 64
#: Probability that no code has a filter for a pair at exactly COSINE, and pairs it is measured on.
MISS, TRIALS = 0.001, 1000
#: Members of a filter that one task compares with as many others.
BLOCK = 1024
#: An angle above what single precision adds to that of two rounded vectors, at any length.
SLACK = 0.002


def _cap_shares(dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Angles up to a right one, and the share of all directions within each of a unit vector."""
    # The angle has density sin^(dimensions - 2); half of it lies below a right angle.
    angle = np.linspace(0, np.pi / 2, 200_001)
    density = np.sin(angle) ** (dimensions - 2)
    below = np.concatenate([[0.0], np.cumsum(density[1:] + density[:-1])])
    return angle, below / (2 * below[-1])


def cap_threshold(dimensions: int, share: float) -> float:
    """The inner product that a share of all directions exceeds with a unit vector."""
    if dimensions == 1:
        return np.inf  # two directions: each vector keeps its own
    angle, shares = _cap_shares(dimensions)
    return float(np.cos(np.interp(share, shares, angle)))


def cap_share(dimensions: int, cosine: float) -> float:
    """The share of all directions whose inner product with a unit vector exceeds the cosine."""
    if dimensions == 1:
        return 0.5
    angle, shares = _cap_shares(dimensions)
    return float(np.interp(np.arccos(cosine), angle, shares))


class ProductCode:
    def __init__(self, dimensions: int, words: int, filters: float, seed: int) -> None:
        rng = np.random.default_rng([seed, dimensions])
        self.parts = min(PARTS, dimensions)
        width = -(-dimensions // self.parts)
        self.padded = width * self.parts
        turn, _ = np.linalg.qr(rng.standard_normal((self.padded, self.padded)))
        self.turn = turn[:dimensions]
        codes = rng.standard_normal((self.parts, words, width))
        codes /= np.linalg.norm(codes, axis=2, keepdims=True)
        self.codes = codes / np.sqrt(self.parts)
        self.words = words
        self.threshold = cap_threshold(self.padded, min(0.5, filters / words**self.parts))

    def passed(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the numbers of all directions it exceeds the threshold with."""
        blocks = (unit @ self.turn).reshape(len(unit), self.parts, -1)
        sums = np.einsum("npw,pkw->npk", blocks, self.codes)
        half = max(1, self.parts // 2)
        return [self._listed(s[:half], s[half:]) for s in sums]

    def _combined(self, sums: np.ndarray) -> np.ndarray:
        total = np.zeros(1)
        for s in sums:
            total = (total[:, None] + s[None, :]).ravel()
        return total

    def _listed(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Pairs of the two halves' combinations whose sum exceeds, by merging sorted sums."""
        a, b = self._combined(left), self._combined(right)
        a_order, b_order = np.argsort(-a), np.argsort(-b)
        a_sorted, b_sorted = a[a_order], b[b_order]
        a_sorted = a_sorted[a_sorted + b_sorted[0] >= self.threshold]
        counts = np.searchsorted(-b_sorted, -(self.threshold - a_sorted), side="right")
        first = np.repeat(a_order[: len(a_sorted)], counts)
        second = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        found = first * len(b) + b_order[second]
        # A vector that passes no filter keeps its best one.
        return found if len(found) else np.array([a_order[0] * len(b) + b_order[0]])


def shared_filter(code: ProductCode, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether each pair of unit vectors has a filter in common."""
    both = zip(code.passed(left), code.passed(right), strict=True)
    return np.array([len(np.intersect1d(a, b)) > 0 for a, b in both])


def random_pairs(dimensions: int, pairs: int, cosine: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and others at exactly the cosine with them."""
    rng = np.random.default_rng([seed, dimensions, 1])
    x, y = rng.standard_normal((2, pairs, dimensions))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if dimensions == 1:
        return x, x
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    return x, cosine * x + np.sqrt(1 - cosine**2) * y


def codes_for(dimensions: int, n: int) -> tuple[int, int]:
    """(code words of a block, number of codes) for ``n`` vectors.

    Codes are added until a pair at exactly ``COSINE`` is missed by all with probability ``MISS`` at
    most. Each code is turned at random, so the misses of a pair are independent and their
    probabilities multiply; each is measured on random pairs, two standard errors put on top. So few
    vectors that one block holds them need no code: 0.
    """
    if n <= BLOCK:
        return 1, 0
    # In few dimensions a vector is close to more than SHARED others: filters no narrower than that.
    share = max(SHARED / n, cap_share(dimensions, COSINE))
    words = max(2, round((FILTERS / share) ** (1 / min(PARTS, dimensions)) + 0.5))
    missed, codes = 1.0, 0
    while missed > MISS:
        left, right = random_pairs(dimensions, TRIALS, COSINE, codes)
        code = ProductCode(dimensions, words, FILTERS, codes)
        share = 1 - shared_filter(code, left, right).mean()
        missed *= min(1 - 1 / TRIALS, share + 2 * np.sqrt((share * (1 - share) + 1 / TRIALS) / TRIALS))
        codes += 1
    return words, codes


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def rounded(unit: np.ndarray) -> list[bytes]:
    """Each unit vector in bytes, the largest component as 127; before them the angle to it, in four bytes."""
    low = np.round(unit * (127 / np.abs(unit).max(1, keepdims=True)))
    length = np.linalg.norm(low, axis=1, keepdims=True)
    # Of the distance, as an arc cosine is not exact near 1.
    angle = 2 * np.arcsin(np.minimum(np.linalg.norm(unit - low / length, axis=1) / 2, 1))
    angle = (angle + 1e-6).astype(np.float32)
    return [a.tobytes() + b.tobytes() for a, b in zip(angle, low.astype(np.int8), strict=True)]


def close(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (of left, of right) of pairs that may reach COSINE; rows are what ``rounded`` gives, as bytes."""
    (turn, x), (other, y) = _opened(left), _opened(right)
    most = np.arccos(COSINE) + turn[:, None] + other.max(initial=0) + SLACK
    # One bound for a row of the left; then the pair's own, for the few that pass.
    cosine = x @ y.T
    i, j = np.nonzero(cosine >= np.cos(np.minimum(most, np.pi)))
    angle = np.arccos(np.clip(cosine[i, j], -1, 1))
    fits = angle <= np.arccos(COSINE) + turn[i] + other[j] + SLACK
    return i[fits], j[fits]


def _opened(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    turn = np.ascontiguousarray(rows[:, :4]).view(np.float32).ravel()
    x = rows[:, 4:].astype(np.float32)
    return turn, x / np.linalg.norm(x, axis=1, keepdims=True)


def _filtered(nodes: DataFrame, plan: dict[int, tuple[int, int]]) -> DataFrame:
    """(filter, node, bytes): each vector under every filter it passes, as rounded bytes.

    ``plan`` has the code words and the number of codes for each length of vectors.
    """

    def run(batches):
        codes: dict[int, list[ProductCode]] = {}
        for batch in batches:
            by: dict[int, list[int]] = {}
            vectors = batch.column("embedding").to_pylist()
            ids = batch.column("node").to_pylist()
            for k, v in enumerate(vectors):
                by.setdefault(len(v), []).append(k)
            for dimensions, rows in by.items():
                words, number = plan[dimensions]
                if dimensions not in codes:
                    codes[dimensions] = [
                        ProductCode(dimensions, words, FILTERS, s) for s in range(number)
                    ]
                step = max(1, min(1000, 2_000_000 // words))
                for at in range(0, len(rows), step):
                    part = rows[at : at + step]
                    unit = _units(np.array([vectors[k] for k in part], float))
                    low = rounded(unit)
                    keys, nodes_, bytes_ = [], [], []
                    if not number:  # one filter for all
                        keys.append(np.full(len(part), dimensions % 4096))
                        nodes_.append(np.array([ids[k] for k in part]))
                        bytes_ = low
                    for s, code in enumerate(codes[dimensions]):
                        for k, found, b in zip(part, code.passed(unit), low, strict=True):
                            # Vectors of other lengths have filters of their own.
                            keys.append((found * number + s) * 4096 + dimensions % 4096)
                            nodes_.append(np.full(len(found), ids[k]))
                            bytes_.extend([b] * len(found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys), pa.int64()),
                         pa.array(np.concatenate(nodes_), pa.int64()),
                         pa.array(bytes_, pa.binary())],
                        names=["filter", "node", "bytes"],
                    )

    return nodes.mapInArrow(run, "filter bigint, node bigint, bytes binary")


def _compared(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of a filter that are close by their bytes; each pair once."""
    dealt = blocks(rows, "filter", "node", BLOCK)

    def compare(key, table):
        node, own = (table.column(c).to_numpy() for c in ("node", "own"))
        bits = table.column("bytes").to_numpy().tolist()
        found = [np.empty((0, 2), np.int64)]
        for length in {len(b) for b in bits}:
            same = np.array([len(b) == length for b in bits])
            x = np.frombuffer(b"".join(b for b in bits if len(b) == length), np.int8)
            x = x.reshape(-1, length)
            ids, of = node[same], own[same]
            one, two = np.flatnonzero(of == key[1].as_py()), np.flatnonzero(of == key[2].as_py())
            for at in range(0, len(one), 256):
                part = one[at : at + 256]
                i, j = close(x[part], x[two])
                pairs = np.stack([ids[part][i], ids[two][j]], 1)
                found.append(pairs[pairs[:, 0] != pairs[:, 1]])
        pairs = np.unique(np.sort(np.concatenate(found), 1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    pairs = dealt.groupBy("filter", "left", "right").applyInArrow(compare, "a bigint, b bigint")
    return pairs.distinct()


def _flat(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All components of a column of vectors, where each vector starts, and its length."""
    ends = vectors.offsets.to_numpy()
    return vectors.values.to_numpy(), ends[:-1].astype(np.int64), np.diff(ends)


def _linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the cosine of each row of ``x`` with that of ``y`` reaches COSINE."""
    x, y = (v / np.abs(v).max(1, keepdims=True) for v in (x, y))
    dot = lambda a, b: np.einsum("nd,nd->n", a, b)
    return dot(x, y) / np.sqrt(dot(x, x) * dot(y, y)) >= COSINE


def _verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose cosine reaches the threshold in double precision."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("embedding").alias(f"v_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "v_a", "v_b")

    def run(batches):
        for batch in batches:
            (x, starts, lengths), (y, others, sizes) = (_flat(batch.column(c)) for c in ("v_a", "v_b"))
            keep = np.zeros(batch.num_rows, bool)
            for length in np.unique(lengths[lengths == sizes]):
                same = np.flatnonzero((lengths == length) & (sizes == length))
                for at in range(0, len(same), step := max(1, 1_000_000 // int(length))):
                    part, place = same[at : at + step], np.arange(length)
                    keep[part] = _linked(x[starts[part, None] + place], y[others[part, None] + place])
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, "a bigint, b bigint")


def near_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of ``vectors``.

    Vectors that are null, empty or zero, or hold a null, infinite or not-a-number component, link
    with nothing; vectors of different lengths do not link. Equal vectors are one node from the
    start, whose number of links counts every copy. Rows of one id count as one vector; with
    several vectors it has the links of all. A row without id links with nothing, has a null
    component and is kept. An empty table gives an empty result.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    sound = F.col("vec_id").isNotNull() & F.coalesce(
        F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )
    # -0.0 and 0.0 are the same component.
    valid = rows.where(sound).withColumn(
        "embedding", F.transform("embedding", lambda x: x + F.lit(0.0))
    )
    valid = materialize(valid.distinct(), "vectors")
    digest = F.sha2(F.concat_ws(",", F.col("embedding").cast("array<string>")), 256)
    keyed = valid.select("vec_id", digest.alias("digest"))
    sets = keyed.groupBy("digest").agg(F.min("vec_id").alias("node"), F.count("*").alias("size"))
    of = materialize(keyed.join(sets, "digest").select("vec_id", "node", "size"), "classes")
    reps = of.where("vec_id = node").select("node", "size").distinct()
    nodes = valid.withColumnRenamed("vec_id", "node").join(reps.select("node").distinct(), "node")
    nodes = materialize(nodes, "nodes")
    # One row for each length of vectors.
    sizes = nodes.groupBy(F.size("embedding").alias("dimensions")).count().collect()
    plan = {r["dimensions"]: codes_for(r["dimensions"], r["count"]) for r in sizes}
    pairs = materialize(_compared(_filtered(nodes, plan)), "near_pairs")
    links = materialize(_verified(pairs, nodes), "near_links")
    both = links.union(links.select("b", "a")).distinct()
    counted = (
        both.join(reps.withColumnRenamed("node", "b"), "b")
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("size").alias("others"))
    )
    found = components(links).withColumnRenamed("id", "node")
    again = of.groupBy("vec_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    # Ids with several vectors join what these belong to.
    again = materialize(again.where("a < b").select("vec_id", "a"), "repeated")
    if not again.isEmpty():
        again = of.join(again, "vec_id").where("node <> a").select("a", F.col("node").alias("b"))
        found = components(links.union(again)).withColumnRenamed("id", "node")
    ids = (
        of.join(counted, "node", "left")
        .join(found, "node", "left")
        .groupBy("vec_id")
        .agg(
            F.sum(F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.min(F.coalesce("component", "node")).alias("component"),
        )
    )
    component = F.coalesce("component", "vec_id")
    return rows.select("vec_id").join(ids, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
