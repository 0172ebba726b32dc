"""Rows of a run's stages, counted as they pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class RunCounters:
    """Counters of one run of ``extract_collocations``, filled by its own writes and the caller's action.

    ``input`` facts, ``kept`` facts, ``pairs``, ``scored`` and ``selected`` pairs, and with one pair per
    score ``distinct_scores``. No table is read for them. Tasks that fail and run again count once; where a lost executor makes Spark repeat a stage
    whose tasks had ended, they may count twice: ``plans.collocations.stage_counts`` reads written tables
    and is exact whatever happens. With stop words given as a table, facts are not followed past
    the letters, and ``kept`` counts those before the stop words.
    """

    def __init__(self) -> None:
        self._watched: dict[str, Observation] = {}

    def watch(self, df: DataFrame, stage: str, rows: Column | None = None) -> DataFrame:
        """``df`` with its rows (or the sum of ``rows``) counted under ``stage`` by its first action."""
        if stage in self._watched:
            raise ValueError("counters belong to one run")
        self._watched[stage] = Observation(f"pairstats {stage}")
        total = F.count(F.lit(1)) if rows is None else F.coalesce(F.sum(rows), F.lit(0))
        return df.observe(self._watched[stage], total.cast("bigint").alias("n_rows"))

    def rows(self, *stages: str) -> dict[str, int]:
        """Stage -> rows, of all stages unless some are named.

        Waits for the action that fills them: ask for ``selected`` after the result was taken.
        """
        return {stage: self._watched[stage].get["n_rows"] for stage in stages or self._watched}


def watched(df: DataFrame, counters: RunCounters | None, stage: str) -> DataFrame:
    return df if counters is None else counters.watch(df, stage)
