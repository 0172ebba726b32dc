"""Prefix trie of rebuilt conversations, by collapsing whole sequences.

A conversation is rebuilt with the opening of another one (``rebuilt``), so that many share their first
turns. Identical rebuilt conversations become one weighted sequence, with the list of those that end
there; only one of them, the representative, is expanded into prefixes. Sequences that are proper
prefixes of others fall out by anti-join; what is left are the leaves. Sums over weighted prefixes give
each node's members, and sums over leaves what its subtree holds.

A prefix is named by a chained SHA-256: the key of the prefix before it, then the turn's digest. A sort in
each task brings the turns of a conversation in order, and one pass over the rows chains them, so a
task holds one batch of rows whatever the length of a conversation. No join meets a shared prefix more
than once per child, and the children of one parent are sliced where they are many.

Defined cases: a null role or text is empty; null turns come first; rows of one turn are ordered by role
and text (by the digest of both, so that any order of input rows gives the same result); rows without
conv_id belong to no conversation; an empty table gives no nodes, not even a root; further columns are
ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairstats.operators.counts import slice_hot
from pairstats.sinks.stage import materialize

#: A conversation takes its opening from the last one whose id is a multiple of this.
STRIDE = 5
#: Openings have fewer turns than this.
LONGEST = 9
#: Key of the empty prefix.
ROOT = hashlib.sha256(b"").digest()
#: Ids of a list that are spelled out together.
CHUNK = 50_000
#: A parent with more children than this share of all nodes, and than this number, is sliced.
HOT_SHARE, HOT_CHILDREN = 1_000, 1_000

_CHAINED = "conv_id bigint, depth bigint, key binary, parent binary, before bigint, upto bigint"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, digest, bytes): the turns of each conversation, counted from 1.

    ``digest`` stands for role and text, the length of the role in front keeps the two apart.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    length = F.octet_length(role).cast("string")
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(F.sha2(F.concat(length, F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    place = F.row_number().over(order).cast("bigint").alias("place")
    return rows.select("conv_id", place, "digest", "bytes")


def opening_length(conv_id: Column) -> Column:
    """How many turns a conversation takes from another one."""
    return F.crc32(conv_id.cast("string")) % LONGEST


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id) and their rebuilt turns (conv_id, depth, digest, bytes), depth from 1.

    The first turns of the conversation with id c - c % 5, as many as ``opening_length`` says, then
    c's own turns after as many of its own. ``turns`` is a written table of ``turn_rows``.
    """
    base = F.col("conv_id") - F.col("conv_id") % STRIDE
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n_turns"))
    convs = convs.select(
        "conv_id", base.alias("base"), opening_length(F.col("conv_id")).alias("h"), "n_turns"
    )
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0))).cast("bigint").alias("taken")
    convs = materialize(
        convs.join(lengths, "base", "left").select("conv_id", "base", "h", taken), "conversations"
    )
    first = turns.where((F.col("place") < LONGEST) & (F.col("conv_id") % STRIDE == 0))
    first = first.withColumnRenamed("conv_id", "base")
    opening = convs.join(first, "base").where("place <= taken").select(
        "conv_id", F.col("place").alias("depth"), "digest", "bytes"
    )
    own = turns.join(convs, "conv_id").where("place > h").select(
        "conv_id", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "digest", "bytes"
    )
    return convs.select("conv_id"), opening.unionByName(own)


def _chain(batches):
    """Keys of the prefixes of each conversation; rows come in order of (conv_id, depth)."""
    import pyarrow as pa

    current, key, upto = None, ROOT, 0
    for batch in batches:
        keys, parents, befores, uptos = [], [], [], []
        rows = zip(
            batch.column("conv_id").to_pylist(),
            batch.column("digest").to_pylist(),
            batch.column("bytes").to_pylist(),
            strict=True,
        )
        for conv, digest, size in rows:
            if conv != current:
                current, key, upto = conv, ROOT, 0
            parents.append(key)
            befores.append(upto)
            key = hashlib.sha256(key + digest).digest()
            upto += size
            keys.append(key)
            uptos.append(upto)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("depth"),
                pa.array(keys, pa.binary()),
                pa.array(parents, pa.binary()),
                pa.array(befores, pa.int64()),
                pa.array(uptos, pa.int64()),
            ],
            names=["conv_id", "depth", "key", "parent", "before", "upto"],
        )


def _id_chunks(batches):
    """(key, first, ids): decimal ids joined by commas; rows come in order of (key, conv_id)."""
    import pyarrow as pa

    def out(rows):
        columns = zip(*[(key, ids[0], b",".join(b"%d" % i for i in ids)) for key, ids in rows], strict=True)
        kinds = (pa.binary(), pa.int64(), pa.binary())
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["key", "first", "ids"])

    current, held, done = None, [], []
    for batch in batches:
        keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
        for key, conv in zip(keys, ids, strict=True):
            if held and (key != current or len(held) == CHUNK):
                done.append((current, held))
                held = []
            current = key
            held.append(conv)
        if done:
            yield out(done)
            done = []
    if held:
        yield out([(current, held)])


def _end_lists(batches):
    """SHA-256 of the ids that end at each key; chunks come in order of (key, first)."""
    import pyarrow as pa

    def out(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], pa.binary()), pa.array([s for _, s in rows], pa.string())],
            names=["key", "ends_sha256"],
        )

    current, state, done = None, None, []
    for batch in batches:
        keys, ids = batch.column("key").to_pylist(), batch.column("ids").to_pylist()
        for key, chunk in zip(keys, ids, strict=True):
            if key == current:
                state.update(b"," + chunk)
                continue
            if current is not None:
                done.append((current, state.hexdigest()))
            current, state = key, hashlib.sha256(chunk)
        if done:
            yield out(done)
            done = []
    if current is not None:
        yield out([(current, state.hexdigest())])


def end_lists(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): the ids in order, joined by commas.

    Ranges of (key, conv_id) are sorted and spelled out in many tasks, whatever ends at one key. A
    digest of a list cannot be cut, so the chunks of a key then pass one task, which only hashes them.
    """
    ordered = ends.select("key", "conv_id").repartitionByRange("key", "conv_id")
    chunks = ordered.sortWithinPartitions("key", "conv_id").mapInArrow(
        _id_chunks, "key binary, first bigint, ids binary"
    )
    ordered = chunks.repartition("key").sortWithinPartitions("key", "first")
    return ordered.mapInArrow(_end_lists, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations; see the module's text.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), and
    n_ends, the conversations that end at the node.
    """
    turns = materialize(turn_rows(conversations), "turns")
    convs, rows = rebuilt(turns)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    chained = materialize(ordered.mapInArrow(_chain, _CHAINED), "prefixes")

    # Whole sequences: the last key of a conversation names it; identical ones are counted together.
    last = chained.groupBy("conv_id").agg(F.max(F.struct("depth", "key", "upto")).alias("last"))
    ends = convs.join(last, "conv_id", "left").select(
        "conv_id",
        F.coalesce("last.key", F.lit(ROOT)).alias("key"),
        F.coalesce("last.upto", F.lit(0).cast("bigint")).alias("total"),
    )
    ends = materialize(ends, "ends")
    sequences = ends.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.first("total").alias("total")
    )
    sequences = materialize(sequences, "sequences")

    # Prefixes of the representatives alone, the empty one too.
    weights = sequences.select("conv_id", "weight", "total")
    prefixes = chained.join(weights, "conv_id")
    root = weights.select(
        "conv_id",
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(ROOT).alias("key"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("bigint").alias("before"),
        F.lit(0).cast("bigint").alias("upto"),
        "weight",
        "total",
    )
    inner = prefixes.select(F.col("parent").alias("key")).distinct()
    leaves = sequences.join(inner, "key", "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    prefixes = prefixes.unionByName(root).join(leaves, "conv_id", "left")
    prefixes = materialize(prefixes, "weighted_prefixes")

    # What all members of a node spend from its text on, and which leaf names its node.
    nodes = prefixes.groupBy("key").agg(
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.first("before").alias("before"),
        F.min("conv_id").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.count("leaf").alias("n_leaves"),
        F.min(F.when(F.col("leaf") == 1, F.col("conv_id"))).alias("owner"),
        F.sum(F.col("weight") * (F.col("total") - F.col("before"))).alias("spent"),
    )
    nodes = materialize(nodes, "nodes")

    # A leaf owns the last nodes of its path, each node has one owner: texts counted once.
    owned = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.min("before").alias("own"))
    texts = (
        prefixes.where("leaf = 1")
        .join(owned, "conv_id")
        .groupBy("key")
        .agg(F.sum(F.col("total") - F.greatest("before", "own")).alias("once"))
    )
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    counts = sequences.select("key", F.col("weight").alias("n_ends"))
    found = (
        nodes.join(texts, "key")
        .join(children, "key", "left")
        .join(counts, "key", "left")
        .join(end_lists(ends), "key", "left")
    )
    found = materialize(
        found.select(
            "conv_id",
            "depth",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            F.col("n_leaves").cast("bigint").alias("n_leaves"),
            (F.col("spent") - F.col("once")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(ROOT.hex())).alias("ends_sha256"),
            F.coalesce("n_ends", F.lit(0)).cast("bigint").alias("n_ends"),
            "key",
            "parent",
        ),
        "nodes",
    )
    return _with_parents(found)


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Attach the conv_id of each node's parent; the children of a parent with many are sliced."""
    parents = nodes.where("n_children > 0").select(
        F.col("key").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
        F.col("n_children").alias("n_pairs"),
    )
    rows, most = nodes.agg(F.count(F.lit(1)), F.max("n_children")).first()
    limit = max(rows // HOT_SHARE, HOT_CHILDREN)
    if (most or 0) > limit:
        marked, sliced = slice_hot(nodes, parents, ["parent"], "key", limit)
        joined = marked.join(sliced, ["parent", "_slice"], "left")
    else:
        joined = nodes.join(parents.drop("n_pairs"), "parent", "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256", "n_ends",
    )
