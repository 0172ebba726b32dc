"""Secrets in texts, judged by how many owners hold the same value.

Fixed patterns find candidates in every whole text: assignments, access keys and hexadecimal runs, which
are always reported, and long mixed runs (``run``), which are not secrets by their form alone. Each
candidate's value is hashed and counted over the whole corpus: in how many repositories it stands, and
of how many owners. A value that many owners hold is an example that was copied; one that
a single owner or two hold looks live. Live-looking runs that overlap no fixed span are added to the spans.

All of it is DataFrame functions: texts never leave their row, only hashes and places are shuffled. A value
is first counted for each of its repositories, then for its owners, so that a value in a third of all
rows is reduced before each shuffle; verdicts of such values are joined in slices.

Defined cases: a null text is empty; a row without owner belongs to the owner '' and one without
repository to the repository ''; repeated rows are judged apart and counted as one repository; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairstats.llm.common import let
from pairstats.operators.counts import slice_hot
from pairstats.sinks.stage import materialize

# Kinds in the order of the result, and the patterns of the first three.
KINDS = ("assign", "access", "hex", "run")
ASSIGN = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: A run: this many characters, of which so many digits and so many different ones.
RUN = "[A-Za-z0-9_-]{20,}"
RUN_MOST, RUN_DIGITS, RUN_DISTINCT = 512, 3, 10
#: A value with fewer different characters, or without a digit, is plain: no live secret.
PLAIN_DISTINCT = 6
#: A value of more owners than this is a copied example.
MOST_OWNERS = 2
#: A value with more places than this share of all, and than this number, is joined in slices.
HOT_SHARE, HOT_PLACES = 1_000, 1_000
#: Sums of lengths are made by blocks of this size.
BLOCK = 256

_FOUND = "array<struct<start:bigint,end:bigint,value:string>>"


def _sum(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, b: a + b)


def sums_before(lengths: Column) -> Column:
    """For each place of an array the sum of all values before it.

    By blocks, so that n values take n * (BLOCK + n / BLOCK**2) additions, not n * n.
    """
    block = F.lit(BLOCK)

    def within(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / block).cast("int")
        sums = F.transform(
            F.sequence(F.lit(0), last), lambda b: _sum(F.slice(values, b * block + 1, block))
        )

        def placed(sums: Column) -> Column:
            firsts = F.transform(sums, lambda _, b: _sum(F.slice(sums, F.lit(1), b)))

            def all_of(firsts: Column) -> Column:
                return F.transform(
                    values,
                    lambda _, i: F.get(firsts, F.floor(i / block).cast("int"))
                    + _sum(F.slice(values, F.floor(i / block).cast("int") * block + 1, i % block)),
                )

            return let(firsts, all_of)

        return let(sums, placed)

    return F.when(F.size(lengths) == 0, F.array().cast("array<bigint>")).otherwise(let(lengths, within))


def spans_of(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern as (start, end, value): places in code points, ``group`` as the value.

    Splitting gives what lies between the matches, so that lengths alone tell the places.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def placed(both: Column) -> Column:
        ends = sums_before(both["steps"])

        def spans(ends: Column) -> Column:
            # The sum before step i holds the matches before it; the text between is added here.
            return F.transform(
                both["whole"],
                lambda m, i: F.struct(
                    (F.get(ends, i) + F.get(both["gaps"], i)).alias("start"),
                    (F.get(ends, i) + F.get(both["steps"], i)).alias("end"),
                    F.get(both["value"], i).alias("value"),
                ),
            )

        return let(ends, spans)

    def measured(found: Column) -> Column:
        gaps = F.transform(found["between"], lambda s: F.char_length(s).cast("bigint"))
        steps = F.transform(
            found["whole"],
            lambda m, i: F.char_length(m).cast("bigint")
            + F.char_length(F.get(found["between"], i)).cast("bigint"),
        )
        return let(
            F.struct(
                found["whole"].alias("whole"),
                found["value"].alias("value"),
                gaps.alias("gaps"),
                steps.alias("steps"),
            ),
            placed,
        )

    found = F.struct(
        whole.alias("whole"), value.alias("value"), F.split(text, pattern, -1).alias("between")
    )
    # Most texts hold no match: one search settles them.
    none = F.array().cast(_FOUND)
    return F.when(text.rlike(pattern), let(found, measured)).otherwise(none)


def _distinct(value: Column) -> Column:
    return F.size(F.array_distinct(F.array_remove(F.split(value, ""), "")))


def _digits(value: Column) -> Column:
    return F.char_length(F.regexp_replace(value, "[^0-9]", ""))


def candidates(text: Column) -> Column:
    """All candidates of a text: (kind, start, end, hash, plain), kind by its place in ``KINDS``."""

    def of(kind: int, found: Column) -> Column:
        return F.transform(
            found,
            lambda s: F.struct(
                F.lit(kind).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.unhex(F.sha2(s["value"], 256)).alias("hash"),
                ((_distinct(s["value"]) < PLAIN_DISTINCT) | (_digits(s["value"]) == 0)).alias("plain"),
            ),
        )

    def long_enough(found: Column, least: int) -> Column:
        return F.filter(found, lambda s: F.char_length(s["value"]) >= least)

    # A run of fewer characters cannot hold a longer one, so the patterns carry the lengths; but an
    # assignment that fails is passed over whole.
    access = ACCESS[:-1] + "{%d,}" % (LEAST["access"] - 4)
    hexadecimal = HEX[:-1] + "{%d,}" % LEAST["hex"]
    runs = F.filter(
        spans_of(text, RUN),
        lambda s: (F.char_length(s["value"]) <= RUN_MOST)
        & (_digits(s["value"]) >= RUN_DIGITS)
        & (_digits(s["value"]) < F.char_length(s["value"]))
        & (_distinct(s["value"]) >= RUN_DISTINCT),
    )
    return F.concat(
        of(0, long_enough(spans_of(text, ASSIGN, 1), LEAST["assign"])),
        of(1, spans_of(text, access)),
        of(2, spans_of(text, hexadecimal)),
        of(3, runs),
    )


def ownership(places: DataFrame) -> DataFrame:
    """(hash, n_places, n_repositories, n_owners) of (hash, owner, repository)."""
    repositories = places.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = repositories.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("r"))
    return owners.groupBy("hash").agg(
        F.sum("n").alias("n_places"),
        F.sum("r").alias("n_repositories"),
        F.count(F.lit(1)).alias("n_owners"),
    )


def _with_owners(places: DataFrame, owners: DataFrame) -> DataFrame:
    """``places`` with n_owners of their value, the places of a frequent value in slices."""
    rows, most = owners.agg(F.sum("n_places"), F.max("n_places")).first()
    limit = max((rows or 0) // HOT_SHARE, HOT_PLACES)
    wanted = owners.select("hash", "n_owners", F.col("n_places").alias("n_pairs"))
    if (most or 0) <= limit:
        return places.join(wanted.drop("n_pairs"), "hash")
    marked, sliced = slice_hot(places, wanted, ["hash"], "row", limit)
    return marked.join(sliced, ["hash", "_slice"]).drop("_slice")


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat(
                F.get(names, s["kind"]),
                F.lit(":"),
                s["start"].cast("string"),
                F.lit(":"),
                s["end"].cast("string"),
            ),
        ),
        ",",
    )


def find_secrets(
    docs: DataFrame, owner: str = "source", repository: str = "doc_id", most_owners: int = MOST_OWNERS
) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, owner and repository columns).

    (doc_id, n_assign, n_access, n_hex, base_sha256, spans, verdicts, n_live, n_copied): the fixed spans
    are counted and hashed, ``spans`` also holds the added ones, ``verdicts`` says of each whether its
    value is ``live``, ``copied`` or ``plain``, in the order of ``spans``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        candidates(text).alias("found"),
    )
    # Written, so that the number of a row stays the same whatever is lost later.
    rows = materialize(rows, "candidates")
    places = rows.where(F.size("found") > 0).select("row", "owner", "repository", F.inline("found"))
    owners = materialize(ownership(places.select("hash", "owner", "repository")), "owners")
    judged = _with_owners(places.drop("owner", "repository"), owners)

    fixed = F.col("kind") < 3
    earlier = Window.partitionBy("row").orderBy("start", "kind")
    behind = earlier.rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind"))
    ahead = ahead.rowsBetween(Window.unboundedPreceding, -1)
    overlaps = (F.coalesce(F.max(F.when(fixed, F.col("end"))).over(behind), F.lit(0)) > F.col("start")) | (
        F.coalesce(F.min(F.when(fixed, F.col("start"))).over(ahead), F.col("end")) < F.col("end")
    )
    verdict = (
        F.when(F.col("plain"), "plain").when(F.col("n_owners") > most_owners, "copied").otherwise("live")
    )
    judged = judged.select("row", "kind", "start", "end", verdict.alias("verdict"), overlaps.alias("over"))
    judged = judged.where(fixed | (~F.col("over") & (F.col("verdict") == "live")))
    spans = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "verdict"))).alias("all")
    )
    whole = rows.select("row", "doc_id").join(spans, "row", "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,verdict:string>>")
    whole = whole.select("doc_id", F.coalesce("all", none).alias("all"))

    def count(test) -> Column:
        return F.size(F.filter("all", test)).cast("bigint")

    def of_kind(kind: int) -> Column:
        return count(lambda s: s["kind"] == kind).alias(f"n_{KINDS[kind]}")

    base = F.filter("all", lambda s: s["kind"] < 3)
    return whole.select(
        "doc_id",
        *[of_kind(kind) for kind in range(3)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("all")).alias("spans"),
        F.array_join(F.transform("all", lambda s: s["verdict"]), ",").alias("verdicts"),
        count(lambda s: s["verdict"] == "live").alias("n_live"),
        count(lambda s: s["verdict"] == "copied").alias("n_copied"),
    )
