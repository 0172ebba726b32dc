"""Word-pair association over large n-gram tables, on Spark."""

from pairstats.plans.collocations import (
    association_counts,
    association_scores,
    extract_collocations,
    select_collocations,
    stage_counts,
)
from pairstats.plans.counters import RunCounters

__all__ = [
    "RunCounters",
    "association_counts",
    "association_scores",
    "extract_collocations",
    "select_collocations",
    "stage_counts",
]
