from __future__ import annotations

import math

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import Window
from pyspark.sql import functions as F

from pairstats.operators import scoring, select
from pairstats.plans.collocations import association_counts, association_scores
from pairstats.sinks.stage import materialize
from worked_example import EXPECTED, rounded


@pytest.fixture
def scores(lines):
    return association_scores(association_counts(lines, "english"))


def keyed(df):
    return {(r.period, r.w1, r.w2): r for r in df.collect()}


def test_scores_by_hand(scores):
    got = keyed(scores)
    assert len(got) == len(EXPECTED)
    for period, w1, w2, c12, c1, c2, n, npmi, rel, _ in EXPECTED:
        row = got[period, w1, w2]
        assert (row.c12, row.c1, row.c2, row.n) == (c12, c1, c2, n)
        assert rounded(row.npmi) == npmi and rounded(row.rel_npmi) == rel
        if npmi is not None:
            p = math.log(c12) + math.log(n) - math.log(c1) - math.log(c2)
            assert row.npmi == pytest.approx(p / -(math.log(c12) - math.log(n)), abs=1e-12)


def test_pmi(scores):
    for row in scoring.with_pmi(scores).collect():
        assert row.pmi == pytest.approx(math.log(row.c12 * row.n / (row.c1 * row.c2)), abs=1e-12)


def test_shares_sum_to_one(scores):
    sums = scores.groupBy("period").agg(F.sum("rel_npmi").alias("s")).collect()
    for row in sums:
        assert row.s is None or row.s == pytest.approx(1.0)


def test_scores_stay_in_range(scores):
    assert scores.where("abs(npmi) > 1 + 1e-9").count() == 0


def test_missing_total_is_added(lines):
    counts = association_counts(lines, "english").drop("n")
    assert keyed(association_scores(counts)).keys() == {r[:3] for r in EXPECTED}


def test_either_threshold(scores):
    got = set(keyed(select.either_threshold(scores, 0.7, 0.3)))
    assert got == {r[:3] for r in EXPECTED if r[-1]}


def test_threshold_is_inclusive_and_skips_nan(spark):
    rows = [
        (1, "a", "b", 0.7, 0.0),
        (1, "a", "c", 0.0, 0.3),
        (1, "a", "d", float("nan"), float("nan")),
        (1, "a", "e", None, None),
        (1, "a", "f", 0.69, 0.29),
        (1, "a", "g", float("nan"), 0.5),
        (1, "a", "h", None, float("inf")),
    ]
    schema = "period int, w1 string, w2 string, npmi double, rel_npmi double"
    df = spark.createDataFrame(rows, schema)
    kept = {r.w2 for r in select.either_threshold(df, 0.7, 0.3).collect()}
    assert kept == {"b", "c", "g", "h"}


def test_one_per_score(scores):
    chosen = select.either_threshold(scores, 0.7, 0.3)
    one = select.one_per_score(chosen, 9)
    assert one.columns == chosen.columns
    got = keyed(one)
    assert (1970, "blue", "fox") in got and (1970, "red", "dog") not in got
    assert (1980, "alpha", "beta") in got and (1980, "gamma", "delta") not in got
    assert len(got) == len({(r.period, round(r.npmi, 9)) for r in chosen.collect()})
    for key, row in got.items():
        assert row == keyed(chosen)[key]


def many(spark, rows=3000):
    i = F.col("id")
    return spark.range(0, rows, 1, 6).select(
        F.when(i % 3 == 0, 1990).otherwise(1900 + (i % 5) * 10).cast("int").alias("period"),
        F.concat(F.lit("w"), (i % 13).cast("string")).alias("w1"),
        F.concat(F.lit("v"), i.cast("string")).alias("w2"),
        ((i * 7919 % 40) / 40).alias("npmi"),
    )


def test_rank_order(spark):
    got = [(r.period, -r.npmi, r.w1, r.w2) for r in select.rank_order(many(spark)).collect()]
    assert got == sorted(got) and len(got) == 3000


@pytest.mark.parametrize("limit", ["1000", "3"])
def test_top_k(spark, settings, limit):
    """The same rows whether Spark cuts each period early or ranges are ranked one by one."""
    settings(
        optimizer__windowGroupLimitThreshold=limit,
        adaptive__coalescePartitions__enabled="false",
    )
    df = many(spark)
    want = []
    by_period: dict[int, list] = {}
    for r in df.collect():
        by_period.setdefault(r.period, []).append((-r.npmi, r.w1, r.w2))
    for period, rows in by_period.items():
        for rank, (score, w1, w2) in enumerate(sorted(rows)[:10], start=1):
            want.append((period, w1, w2, -score, rank))
    best = select.top_k(df, 10)
    assert sorted(tuple(r) for r in best.collect()) == sorted(want)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert ("WindowGroupLimit" in plan) == (limit == "1000")


def test_top_k_beyond_the_limit_ranks_all_rows(spark, settings):
    settings(
        optimizer__windowGroupLimitThreshold="3",
        shuffle__partitions="7",
        adaptive__coalescePartitions__enabled="false",
    )
    best = select.top_k(many(spark), 5000).orderBy("period", "rank").collect()
    assert [tuple(r)[:4] for r in best] == [
        tuple(r) for r in select.rank_order(many(spark)).collect()
    ]
    ranks: dict[int, list] = {}
    for row in best:
        ranks.setdefault(row.period, []).append(row.rank)
    assert all(r == list(range(1, len(r) + 1)) for r in ranks.values())


def test_one_per_score_reduces_before_the_shuffle(spark):
    df = select.one_per_score(many(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert plan.count("Aggregate") >= 2


def test_top_k_keeps_null_periods_and_scores_at_any_k(spark, settings):
    """One result on both sides of the limit: rows without period are ranked like a period."""
    settings(optimizer__windowGroupLimitThreshold="1000")
    nulls = spark.range(0, 40).select(
        F.lit(None).cast("int").alias("period"),
        F.lit("w").alias("w1"),
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("w2"),
        F.when(F.col("id") % 4 > 0, F.col("id") / 40).alias("npmi"),
    )
    df = many(spark, 300).union(nulls)
    small, large = (
        sorted(map(tuple, select.top_k(df, k).collect()), key=repr) for k in (1000, 2000)
    )
    assert small == large and len(small) == 340
    assert [r[-1] for r in small if r[0] is None and r[3] is None] != []


def test_top_k_drops_rows_before_they_are_ranked(spark, monkeypatch):
    """Few rows beyond k reach the sort, whatever the scores: distinct, one score for most, NULL."""
    monkeypatch.setattr(select, "FEW_ROWS", 1)
    i = F.col("id")
    made = spark.range(0, 60_000, 1, 8).select(
        (i % 2).cast("int").alias("period"),
        F.md5(i.cast("string")).alias("w1"),
        F.lit("w").alias("w2"),
        F.when(i % 7 > 0, F.when(i % 3 > 0, F.lit(0.5)).otherwise((i % 1000) / 1000)).alias("npmi"),
    )
    df = materialize(made, "scores")
    for k in (5, 400, 9000):
        rows = df.withColumn("_score", F.col("npmi"))
        kept = select._within_bounds(rows, "period", F.substring("w1", 1, 4), k)
        sizes = {r.period: r["count"] for r in kept.groupBy("period").count().collect()}
        assert set(sizes) == {0, 1} and all(k <= n <= k + 500 for n in sizes.values())
        whole = df.withColumn(
            "rank",
            F.row_number().over(
                Window.partitionBy("period").orderBy(F.desc_nulls_last("npmi"), "w1", "w2")
            ),
        ).where(F.col("rank") <= k)
        assert sorted(map(tuple, select.top_k(df, k).collect())) == sorted(map(tuple, whole.collect()))


def test_a_bound_that_misses_ranks_the_group_whole(spark, monkeypatch):
    """A sketch may promise too much; the counts show it, and no row is lost."""
    df = materialize(many(spark), "scores")
    want = sorted(map(tuple, select.top_k(df, 90).collect()), key=repr)
    monkeypatch.setattr(select, "FEW_ROWS", 1)
    monkeypatch.setattr(select, "SLACK", 1e-9)
    high = F.lit(1e9)
    monkeypatch.setattr(F, "kll_sketch_get_quantile_double", lambda s, r: F.transform(r, lambda _: high))
    assert sorted(map(tuple, select.top_k(df, 90).collect()), key=repr) == want


def test_top_k_starts_no_job_when_built(spark):
    """Neither for few rows nor for many; the input is grouped, so that planning it would run a shuffle."""
    context, group = spark.sparkContext, "top-k-built"
    context.setJobGroup(group, group)
    try:
        grouped = many(spark).groupBy("period", "w1", "w2").agg(F.max("npmi").alias("npmi"))
        best = [select.top_k(grouped, k) for k in (10, 5000)]
        assert list(context.statusTracker().getJobIdsForGroup(group)) == []
        assert all(df.count() for df in best)
        assert list(context.statusTracker().getJobIdsForGroup(group)) != []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


# --- sums ----------------------------------------------------------------------------------


def test_sums_do_not_depend_on_order(spark):
    """Bit-equal sums and shares under three partitionings; plain sums of these rows differ."""
    i = F.col("id")
    rows = spark.range(0, 40_000, 1, 8).select(
        (i % 3).cast("int").alias("period"),
        i.cast("string").alias("w1"),
        F.lit("w").alias("w2"),
        F.when(i % 11 > 0, F.sin(i * 1.7) / (i % 97 + 1)).alias("npmi"),
    )
    orders = [rows.coalesce(1), rows.repartition(7, "w1"), rows.orderBy(F.xxhash64("w1")).repartition(13)]
    sums, shares, plain = set(), set(), set()
    for df in orders:
        df = materialize(df, "scores")
        sums.add(tuple(sorted(map(tuple, scoring.npmi_totals(df).collect()))))
        shared = scoring.with_relative_npmi(df).select("w1", "rel_npmi").collect()
        shares.add(tuple(sorted(map(tuple, shared))))
        plain.add(tuple(sorted(map(tuple, df.groupBy("period").agg(F.sum("npmi")).collect()))))
    assert len(sums) == len(shares) == 1 and len(plain) > 1
    exact = {}
    for row in rows.collect():
        if row.npmi is not None:
            exact.setdefault(row.period, []).append(row.npmi)
    for period, total in next(iter(sums)):
        assert total == pytest.approx(math.fsum(exact[period]), rel=1e-11)


def test_sums_of_odd_values(spark):
    def total(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.agg(scoring.exact_sum(F.col("x"))).first()[0]

    assert total() is None and total(None) is None
    assert total(0.1, None, 0.2) == pytest.approx(0.3, rel=1e-15)
    assert total(-1.0, 1.0, 2.0**-52) == 2.0**-52
    assert math.isnan(total(float("nan"), 1.0)) and total(float("inf"), 1.0) == float("inf")
    assert total(1e300, 1.0) == 1e300


def test_a_sum_that_does_not_fit_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(scoring, "LOWER", 0)
    df = spark.range(4096).select(F.lit(1000.0).alias("x"))
    with pytest.raises(ArithmeticException):
        df.agg(scoring.exact_sum(F.col("x"))).collect()
