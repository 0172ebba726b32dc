"""The run from 2-gram facts to ranked collocations, whole and in parts.

A run writes three tables to the shared folder (see ``pairstats.sinks.stage``): the pair counts,
the word and period totals, and the scores. The corpus is scanned once. What is left to the
caller's action is the choice and the order of the result.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairstats.operators.clean import clean_pairs, drop_stop_pairs, pair_outcomes, stop_table
from pairstats.operators.counts import bucketed_pairs, pair_counts, with_all_counts, with_period_total
from pairstats.operators.scoring import with_npmi, with_relative_npmi
from pairstats.operators.select import either_threshold, one_per_score, rank_order
from pairstats.plans.counters import RunCounters, watched
from pairstats.sinks.stage import materialize

TIES = ("keep", "one_per_score")


def association_counts(
    ngrams: DataFrame,
    language: str,
    width: int = 10,
    fold_case: bool = False,
    stop_words: Iterable[str] | DataFrame | None = None,
    counters: RunCounters | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Clean and count: (period, w1, w2, c12, c1, c2, n).

    With ``buckets`` the pair table is written in so many buckets of (period, w1), which then join their
    totals without a shuffle; see ``bucketed_pairs``.
    """
    stop_words = stop_table(ngrams.sparkSession, stop_words)
    table = isinstance(stop_words, DataFrame)
    facts = watched(ngrams, counters, "input")
    pairs = clean_pairs(facts, language, width, fold_case, [] if table else stop_words)
    pairs = pair_counts(watched(pairs, counters, "kept"))
    if table:
        # Stop words are a matter of the words alone, so they can go after counting.
        pairs = drop_stop_pairs(materialize(pairs, "pair_counts"), stop_words, language)
    pairs = watched(pairs, counters, "pairs")
    written = materialize(pairs, "pair_counts") if buckets is None else bucketed_pairs(pairs, "w1", buckets)
    return with_all_counts(written)


def association_scores(
    counts: DataFrame, keep_counts: bool = True, counters: RunCounters | None = None
) -> DataFrame:
    """Score counted pairs: adds ``npmi`` and ``rel_npmi`` (and ``n`` where it is missing).

    The scores are written, because each is needed for its period's sum and again after it.
    Without ``keep_counts`` the counts are not written along.
    """
    if "n" not in counts.columns:
        counts = with_period_total(counts)
    scores = with_npmi(counts)
    if not keep_counts:
        scores = scores.select("period", "w1", "w2", "npmi")
    return with_relative_npmi(materialize(watched(scores, counters, "scored"), "scores"))


def select_collocations(
    scores: DataFrame,
    min_npmi: float,
    rel_min_npmi: float,
    ties: str = "keep",
    keep_scores: bool = False,
    digits: int | None = None,
    counters: RunCounters | None = None,
) -> DataFrame:
    """Pairs that reach either threshold, best first.

    ``ties="one_per_score"`` keeps one pair for each score of a period; ``digits`` rounds the
    score for that and for the order. ``keep_scores`` keeps all columns next to ``npmi``.
    """
    if ties not in TIES:
        raise ValueError(f"ties must be one of {TIES}, not {ties!r}")
    chosen = either_threshold(scores, min_npmi, rel_min_npmi)
    if not keep_scores:
        chosen = chosen.select("period", "w1", "w2", "npmi")
    if ties == "one_per_score":
        chosen = one_per_score(watched(chosen, counters, "selected"), digits)
        return watched(rank_order(chosen, digits), counters, "distinct_scores")
    # Counted behind the range sort, which reads its input twice: once for its ranges.
    return watched(rank_order(chosen, digits), counters, "selected")


def extract_collocations(
    ngrams: DataFrame,
    language: str,
    min_npmi: float,
    rel_min_npmi: float,
    width: int = 10,
    ties: str = "keep",
    keep_scores: bool = False,
    fold_case: bool = False,
    stop_words: Iterable[str] | DataFrame | None = None,
    digits: int | None = None,
    counters: RunCounters | None = None,
) -> DataFrame:
    """The whole run: clean, count, score, choose and order.

    ``counters`` (new for each run) counts the rows that leave each stage, without reading any twice.
    """
    counts = association_counts(ngrams, language, width, fold_case, stop_words, counters)
    scores = association_scores(counts, keep_scores, counters)
    return select_collocations(scores, min_npmi, rel_min_npmi, ties, keep_scores, digits, counters)


def stage_counts(
    ngrams: DataFrame,
    language: str,
    min_npmi: float,
    rel_min_npmi: float,
    width: int = 10,
    stop_words: Iterable[str] | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Rows that leave each stage of a run: (stage, n_rows).

    One scan: facts are counted by pair, the rejected ones under no pair with their reason. Plain
    counts of written tables, so a task that runs twice counts once.
    """
    outcomes = materialize(pair_outcomes(ngrams, language, width, stop_words), "outcomes")
    pairs = outcomes.where(F.col("reason").isNull()).select("period", "w1", "w2", "c12")
    scores = association_scores(with_all_counts(pairs), keep_counts=False)
    chosen = either_threshold(scores, min_npmi, rel_min_npmi)
    score = F.col("npmi") if digits is None else F.round("npmi", digits)
    per_score = chosen.groupBy("period", score.alias("score")).agg(F.count(F.lit(1)).alias("rows"))
    good = F.col("reason").isNull()
    rows = F.count(F.lit(1))
    parts = [
        _stage_rows(
            outcomes,
            input=F.sum("n_facts"),
            kept=F.sum(F.when(good, F.col("n_facts"))),
            pairs=F.count(F.when(good, F.lit(1))),
        ),
        _stage_rows(scores, scored=rows),
        _stage_rows(per_score, selected=F.sum("rows"), distinct_scores=rows),
    ]
    return reduce(DataFrame.unionByName, parts)


def _stage_rows(rows: DataFrame, **totals: Column) -> DataFrame:
    """One row (stage, n_rows) for each total over ``rows``."""
    one = rows.agg(*[F.coalesce(t, F.lit(0)).alias(stage) for stage, t in totals.items()])
    named = [F.struct(F.lit(s).alias("stage"), F.col(s).alias("n_rows")) for s in totals]
    return one.select(F.inline(F.array(*named)))
