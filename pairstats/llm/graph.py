"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairstats.sinks.stage import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, component): for each id in ``links`` (a, b), the smallest id reachable from it.

    Each round takes the smallest label among neighbours, then the label of the label, so that
    long chains halve. Only labels move, each pre-aggregated before the shuffle; every round is
    written, so a lost executor repeats one round at most. Links with a null end are ignored.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "links")
    labels = materialize(
        both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")), "labels"
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        stepped = labels.join(near, "id").select(
            "id", "label", F.least("label", "near").alias("next")
        )
        stepped = materialize(stepped, "labels")
        up = stepped.select(F.col("id").alias("next"), F.col("next").alias("further"))
        jumped = stepped.join(up, "next").select(
            "id", "label", F.least("next", "further").alias("new")
        )
        jumped = materialize(jumped, "labels")
        if jumped.where("new <> label").isEmpty():
            return jumped.select("id", F.col("new").alias("component"))
        labels = jumped.select("id", F.col("new").alias("label"))


def blocks(members: DataFrame, key: str, node: str, block: int) -> DataFrame:
    """``members`` dealt so that any two of a ``key`` meet in one group (key, left, right).

    A key with more than ``block`` members is cut into parts by a hash of the node, and each part
    meets each other part in a group of its own, so no group holds more than about two parts.
    ``own`` is the part of a row. Keys with one member alone are left out.
    """
    sizes = members.groupBy(key).agg(F.count("*").alias("size")).where("size > 1")
    rows = members.join(sizes, key)
    parts = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64(node), parts).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return rows.select(
        *members.columns,
        "own",
        F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"),
    )
