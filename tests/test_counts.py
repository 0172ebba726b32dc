from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pairstats.operators import clean, counts, scoring
from pairstats.sinks.stage import materialize
from worked_example import EXPECTED


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture
def pairs(lines):
    return counts.pair_counts(clean.clean_pairs(lines, "english"))


def test_counts_by_hand(pairs):
    want = sorted((r[:7] for r in EXPECTED), key=repr)
    assert rows_of(counts.with_all_counts(materialize(pairs, "pairs"))) == want
    assert rows_of(pairs) == sorted((r[:4] for r in EXPECTED), key=repr)


def test_one_at_a_time_equals_all_at_once(pairs):
    pairs = materialize(pairs, "pairs")
    steps = counts.with_period_total(counts.with_right_count(counts.with_left_count(pairs)))
    assert steps.columns == ["period", "w1", "w2", "c12", "c1", "c2", "n"]
    assert rows_of(steps) == rows_of(counts.with_all_counts(pairs))


def test_windows_give_the_same_counts(pairs):
    def total(*keys):
        return F.sum("c12").over(Window.partitionBy(*keys))

    windows = pairs.select(
        "*",
        total("period", "w1").alias("c1"),
        total("period", "w2").alias("c2"),
        total("period").alias("n"),
    )
    assert rows_of(windows) == rows_of(counts.with_all_counts(materialize(pairs, "pairs")))


def test_levels_hold_every_total(pairs):
    levels = counts.count_levels(pairs)
    for level, single in {
        0: pairs,
        1: counts.left_counts(pairs),
        2: counts.right_counts(pairs),
        3: counts.period_totals(pairs),
    }.items():
        part = levels.where(F.col("level") == level).drop("level")
        names = [c for c in single.columns if c in part.columns]
        assert rows_of(part.select(*names, "total")) == rows_of(single)
    assert set(counts.LEVELS) == {row.level for row in levels.select("level").distinct().collect()}


def test_sums_add_up(pairs):
    out = counts.with_all_counts(materialize(pairs, "pairs"))
    for keys, name in ((["period", "w1"], "c1"), (["period", "w2"], "c2"), (["period"], "n")):
        off = out.groupBy(*keys).agg(F.sum("c12").alias("s"), F.max(name).alias("t"))
        assert off.where("s <> t").count() == 0


def test_partitioning_does_not_matter(lines):
    def run(df):
        pairs = counts.pair_counts(clean.clean_pairs(df, "english"))
        return rows_of(counts.with_all_counts(materialize(pairs, "pairs")))

    assert run(lines) == run(lines.repartition(5, "year")) == run(lines.orderBy(F.desc("ngram")))


def test_no_rows(spark):
    empty = spark.createDataFrame([], "period int, w1 string, w2 string, c12 bigint")
    assert counts.with_all_counts(empty).collect() == []


def test_reverse_twice_is_the_same(pairs):
    once = counts.reverse_pairs(pairs)
    assert once.columns == pairs.columns
    assert rows_of(counts.reverse_pairs(once)) == rows_of(pairs)
    assert Counter(r[2] for r in rows_of(once)) == Counter(r[1] for r in rows_of(pairs))


# --- hot words -----------------------------------------------------------------------------


def hot_pairs(spark, rows=120_000):
    """A third of all pairs share their first word, another third their second one."""
    i = F.col("id")
    w1 = F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), (i % 997).cast("string")))
    w2 = F.when(i % 3 == 1, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.md5(i.cast("string"))))
    return spark.range(0, rows, 1, 8).select(
        F.lit(1990).alias("period"), w1.alias("w1"), w2.alias("w2"), (i % 5 + 1).alias("c12")
    )


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


ATTACH = [(counts.with_left_count, "w1"), (counts.with_right_count, "w2")]


def no_broadcast(settings, **more):
    settings(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", **more
    )


@pytest.mark.parametrize("attach, key", ATTACH)
def test_hot_words_are_sliced(spark, settings, monkeypatch, attach, key):
    """Without any help of adaptive execution, no task gets the hot word whole."""
    no_broadcast(settings, adaptive__enabled="false", shuffle__partitions="32")
    pairs = materialize(hot_pairs(spark), "pairs")
    rows, want = pairs.count(), dict(pairs.groupBy(key).agg(F.sum("c12")).collect())

    def largest_share(df):
        sizes = df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        return sizes / rows

    assert largest_share(attach(pairs)) > 1 / 3
    monkeypatch.setattr(counts, "HOT_PAIRS", 500)
    out = attach(pairs)
    assert largest_share(out) < 1 / 10
    got = out.collect()
    assert len(got) == rows and {row[key]: row[-1] for row in got} == want


@pytest.mark.parametrize("hot", [1, 7, 1000])
def test_slices_do_not_change_the_counts(lines, settings, monkeypatch, hot):
    pairs = materialize(counts.pair_counts(clean.clean_pairs(lines, "english")), "pairs")
    want = rows_of(counts.with_all_counts(pairs))
    monkeypatch.setattr(counts, "HOT_PAIRS", hot)
    monkeypatch.setattr(counts, "HOT_WORDS", 10)
    assert rows_of(counts.with_all_counts(pairs)) == want
    no_broadcast(settings)
    assert rows_of(counts.with_all_counts(pairs)) == want


@pytest.mark.parametrize("local_map, join", [("0", "SortMergeJoin"), ("128m", "ShuffledHashJoin")])
def test_adaptive_execution_splits_too(spark, settings, local_map, join):
    """Both sides of the join are plain shuffles, which adaptive execution can split."""
    no_broadcast(
        settings,
        adaptive__maxShuffledHashJoinLocalMapThreshold=local_map,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__advisoryPartitionSizeInBytes="10k",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="64",
    )
    pairs = materialize(hot_pairs(spark), "pairs")
    for attach, key in ATTACH:
        out = attach(pairs)
        got = {row[key]: row[-1] for row in out.collect()}
        assert got == dict(pairs.groupBy(key).agg(F.sum("c12")).collect())
        assert f"{join}(skew=true)" in executed(out)


def test_nothing_is_shuffled_by_period_alone(lines, settings):
    """Not even in a session that never broadcasts by itself."""
    no_broadcast(settings)
    pairs = materialize(counts.pair_counts(clean.clean_pairs(lines, "english")), "pairs")
    out = scoring.with_relative_npmi(scoring.with_npmi(counts.with_all_counts(pairs)))
    plan = executed(out)
    assert "hashpartitioning(period#" in plan
    assert not re.search(r"hashpartitioning\(period#\d+, \d+\)", plan)


def test_small_totals_are_broadcast_by_size(spark, settings):
    pairs = materialize(hot_pairs(spark, 6000), "pairs")
    settings(autoBroadcastJoinThreshold="10m")
    plan = counts.with_all_counts(pairs)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3
    assert "hashpartitioning" not in plan
    assert "Exchange" not in plan.replace("BroadcastExchange", "")


def test_plan_of_the_counting_stage(spark, lines):
    """One shuffle on the whole pair key, no Python, and nothing shuffled by period alone."""
    plan = executed(counts.pair_counts(clean.clean_pairs(lines, "english")))
    assert "Python" not in plan
    assert plan.count("Exchange hashpartitioning(period") == 1
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")


def test_only_columns_in_use_are_read(spark, tmp_path):
    from pairstats.sources.ngrams import read_ngrams_table

    rows = [("new york", 1991, 3, 1, 1)]
    schema = "ngram string, year int, match_count bigint, page_count bigint, volume_count bigint"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "facts"))
    facts = read_ngrams_table(spark, str(tmp_path / "facts"))
    plan = executed(counts.pair_counts(clean.clean_pairs(facts, "english")))
    assert "ReadSchema: struct<ngram:string,year:int,match_count:bigint>" in plan
    assert "GreaterThan(match_count,0)" in plan


def test_levels_copy_no_pair(spark, settings, pairs):
    """No grouping sets over pairs; periods are summed from totals of words."""
    pairs = materialize(pairs, "pairs")
    plan = counts.count_levels(pairs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    attached = counts.with_all_counts(pairs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in attached


def pair_exchanges(df) -> int:
    """Shuffles of rows that carry the count of a pair."""
    df.collect()
    lines = executed(df).split("Initial Plan")[0].split("\n")
    found = 0
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(period" in line:
            below = "\n".join(lines[i + 1 : i + 4])
            found += "c12" in below
    return found


def test_buckets_spare_a_shuffle_of_the_pairs(spark, settings):
    """Pairs in buckets of (period, w1) join the totals of first words where they lie."""
    no_broadcast(settings, adaptive__enabled="false")
    pairs = hot_pairs(spark, 3000)
    plain, dealt = materialize(pairs, "pairs"), counts.bucketed_pairs(pairs, "w1", 8)
    assert rows_of(counts.with_left_count(dealt)) == rows_of(counts.with_left_count(plain))
    assert pair_exchanges(counts.with_left_count(plain)) == 1
    assert pair_exchanges(counts.with_left_count(dealt)) == 0
    assert rows_of(counts.with_all_counts(dealt)) == rows_of(counts.with_all_counts(plain))
    both = pair_exchanges(counts.with_all_counts(plain)), pair_exchanges(counts.with_all_counts(dealt))
    assert both[1] == both[0] - 1
    totals = dealt.groupBy("period", "w1").agg(F.sum("c12"))
    assert "Exchange" not in executed(totals)


def test_hot_words_in_buckets_are_sliced(spark, settings, monkeypatch):
    no_broadcast(settings, adaptive__enabled="false", shuffle__partitions="32")
    pairs = counts.bucketed_pairs(hot_pairs(spark), "w1", 32)
    want = rows_of(counts.with_left_count(pairs))
    monkeypatch.setattr(counts, "HOT_PAIRS", 500)
    out = counts.with_left_count(pairs)
    sizes = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < out.count() / 10 and rows_of(out) == want
