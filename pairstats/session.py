"""Session settings for runs on large corpora; all can be set on a running session."""

SETTINGS = {
    # Splits the shuffle partition of a hot word or period at run time, in the joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Where totals are too large to broadcast, hash each shuffled partition of them instead of
    # sorting both sides, if every partition turns out to be no larger than this.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
}
