"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule is a ratio of a text; it rejects a text whose ratio is above a cutoff. Labelled documents
are the holdout that certifies cutoffs: for each stratum (texts of similar length) and rule, the
cutoffs are tested from the loosest to the tightest. A cutoff is certified while the exact
binomial test refutes "more than ``risk / rules`` of the good documents are rejected" at level
``delta / (strata * rules)``. Testing in a fixed order and stopping at the first failure needs no
correction among cutoffs, and Bonferroni's corrects among strata and rules, so that with
probability ``1 - delta`` no stratum loses more than ``risk`` of its good documents. Of the certified
cutoffs the one with the best trade of rejected bad documents against rejected good ones holds; a
rule with no certified cutoff, as with few labels, rejects nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairstats.llm.common import SPACES, labelled, let, wrapped
from pairstats.sinks.stage import materialize

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

RISK = 0.02
DELTA = 0.05
#: A rejected good document weighs as much as so many rejected bad ones.
GOOD_WEIGHT = 20.0
#: Texts of at least so many words form the next stratum.
STRATA = (0, 150)
#: Each rule with its step; its cutoffs are 1 to CUTOFFS times that.
RULES = {
    "symbols_per_word": 0.05,
    "upper_share": 0.025,
    "dup_line_share": 0.025,
    "repeat_word_share": 0.025,
    "bar_share": 0.02,
    "bang_share": 0.025,
}
CUTOFFS = 40


def _replaced(text: Column, characters: str, by: str) -> Column:
    """Each of a few characters replaced; far faster than ``translate`` over long texts."""
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(by))
    return text


def _removed(text: Column, characters: str) -> Column:
    return _replaced(text, characters, "")


def _words(text: Column) -> Column:
    """Words: runs of characters other than ASCII white space."""
    return F.array_remove(F.split(_replaced(text, SPACES[1:], " "), " "), "")


def _repeat_words(words: Column, n: Column) -> Column:
    """Words that lie in a window of three words which the text holds twice or more.

    Equal hashes are only a reason to look: the windows of such a text are sorted by their words.
    """

    def exact(windows: Column) -> Column:
        same = lambda i, k: (
            (windows[i]["a"] == windows[k]["a"])
            & (windows[i]["b"] == windows[k]["b"])
            & (windows[i]["c"] == windows[k]["c"])
        )
        last = F.size(windows) - 1
        found = F.filter(
            F.sequence(F.lit(0), last),
            lambda i: ((i > 0) & same(i, F.greatest(i - 1, F.lit(0))))
            | ((i < last) & same(i, F.least(i + 1, last))),
        )
        places = F.transform(
            found, lambda i: F.array(*[windows[i]["at"] + F.lit(k) for k in range(3)])
        )
        return F.size(F.array_distinct(F.flatten(places)))

    starts = F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    windows = F.sort_array(
        F.transform(
            starts,
            lambda i: F.struct(
                words[i].alias("a"), words[i + 1].alias("b"), words[i + 2].alias("c"), i.alias("at")
            ),
        )
    )
    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(n < 4, F.lit(0)).when(repeats, let(windows, exact)).otherwise(F.lit(0))


def rule_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of each whole ``text``: a null text has no words.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_bars and
    n_bangs; columns of these names in ``docs`` are replaced. Keeps every row and no other order.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counts += ["n_lines", "n_upper", "n_bars", "n_bangs"]
    docs = docs.drop(*counts)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(
        F.split(text, "\n"),
        lambda x: F.length(_removed(x, SPACES)) > 0,
    )
    length = F.char_length
    facts = F.struct(
        let(_words(text), lambda w: F.struct(
            F.size(w).alias("n_words"), _repeat_words(w, F.size(w)).alias("n_repeat_words")
        )).alias("w"),
        let(lines, lambda x: F.struct(
            F.size(x).alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        )).alias("x"),
        length(_removed(text, SPACES)).alias("word_chars"),
        (length(text) - length(_removed(text, SYMBOLS))).alias("n_symbols"),
        (length(text) - length(F.regexp_replace(text, "[A-Z]{2,}", ""))).alias("n_upper"),
        (length(text) - length(_removed(text, "|"))).alias("n_bars"),
        (length(text) - length(_removed(text, "!"))).alias("n_bangs"),
    )
    found = docs.withColumn("_facts", facts)
    source = {"n_words": "w.", "n_repeat_words": "w.", "n_lines": "x.", "n_dup_lines": "x."}
    values = [F.col(f"_facts.{source.get(c, '')}{c}").cast("bigint").alias(c) for c in counts]
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], *values)


def base_failed() -> Column:
    """The fixed rules: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")
    )


def rule_values() -> Column:
    """The ratio of each rule, in the order of ``RULES``."""
    ratio = lambda x, of: F.when(F.col(of) > 0, F.col(x) / F.col(of)).otherwise(0.0)
    return F.array(
        ratio("n_symbols", "n_words"),
        ratio("n_upper", "word_chars"),
        ratio("n_dup_lines", "n_lines"),
        ratio("n_repeat_words", "n_words"),
        ratio("n_bars", "n_words"),
        ratio("n_bangs", "n_words"),
    )


def stratum() -> Column:
    found = F.lit(0)
    for k, least in enumerate(STRATA):
        found = F.when(F.col("n_words") >= least, F.lit(k)).otherwise(found)
    return found


def _step(rule: Column) -> Column:
    return F.array(*[F.lit(x) for x in RULES.values()])[rule]


def binomial_tail(n: Column, x: Column, rate: float) -> Column:
    """P(X <= x) for X binomial of n and ``rate``, exactly; 1 where x is not below ``n * rate``.

    The last term comes from its logarithm, those before it from ratios below 1, so that no size
    of n leaves the range of doubles.
    """
    n, x = n.cast("double"), x.cast("int")
    odds = F.lit(rate / (1 - rate))
    log_last = F.aggregate(
        F.when(x > 0, F.sequence(F.lit(1), x)).otherwise(F.array().cast("array<int>")),
        n * F.log(F.lit(1 - rate)),
        lambda total, j: total + F.log((n - j + 1) / j * odds),
    )
    parts = F.aggregate(
        F.when(x > 0, F.sequence(x, F.lit(1))).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda s, j: let(
            s["term"] * j / ((n - j + 1) * odds),
            lambda term: F.struct(term.alias("term"), (s["total"] + term).alias("total")),
        ),
        lambda s: s["total"],
    )
    return F.when(x < n * rate, F.exp(log_last) * parts).otherwise(1.0)


def certified_cutoffs(labelled_counts: DataFrame, risk: float, delta: float) -> DataFrame:
    """(stratum, rule, cutoff): at most one row for each pair of them.

    ``labelled_counts`` has the counts of texts and ``label`` (1 good, 0 bad), one row for each
    labelled document. Documents that fail the fixed rules take no part: they go anyway.
    """
    rules = len(RULES)
    rows = labelled_counts.where(~base_failed()).select(
        stratum().alias("stratum"), "label", F.posexplode(rule_values()).alias("rule", "value")
    )
    # A text is rejected by the cutoffs 1 to ``above``.
    above = F.least(F.ceil(F.col("value") / _step(F.col("rule"))).cast("int") - 1, F.lit(CUTOFFS))
    counted = rows.groupBy("stratum", "rule", F.greatest(above, F.lit(0)).alias("above")).agg(
        F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")
    )
    # From here on, at most strata * rules * (CUTOFFS + 1) rows.
    grid = F.explode(F.sequence(F.lit(1), F.lit(CUTOFFS))).alias("cutoff")
    whole = counted.groupBy("stratum", "rule").agg(
        F.sum("good").alias("all_good"),
        F.sum("bad").alias("all_bad"),
        F.collect_list(F.struct("above", "good", "bad")).alias("counts"),
    )
    rejected = lambda name: F.aggregate(
        F.filter("counts", lambda x: x["above"] >= F.col("cutoff")),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x[name],
    )
    tested = whole.select("*", grid).select(
        "stratum",
        "rule",
        "cutoff",
        "all_good",
        "all_bad",
        rejected("good").alias("good"),
        rejected("bad").alias("bad"),
    )
    level = delta / (len(STRATA) * rules)
    passed = binomial_tail(F.col("all_good"), F.col("good"), risk / rules) <= level
    by = Window.partitionBy("stratum", "rule")
    ordered = by.orderBy(F.desc("cutoff")).rowsBetween(Window.unboundedPreceding, 0)
    share = lambda x, of: F.when(F.col(of) > 0, F.col(x) / F.col(of)).otherwise(0.0)
    trade = F.round(share("bad", "all_bad") - GOOD_WEIGHT * share("good", "all_good"), 9)
    return (
        tested.withColumn("certified", F.min(passed).over(ordered))
        .where("certified")
        .withColumn("trade", trade)
        .where("trade > 0")
        .withColumn("best", F.row_number().over(by.orderBy(F.desc("trade"), F.desc("cutoff"))))
        .where("best = 1")
        .select("stratum", "rule", (F.col("cutoff") * _step(F.col("rule"))).alias("cutoff"))
    )


def judge(counts: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``counts`` (doc_id, the counts of ``rule_counts``, others) with base_failed, kept and failed.

    ``failed`` lists the certified rules that reject the text.
    """
    good = labelled(labels, "quality")
    once = counts.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    cutoffs = certified_cutoffs(once.join(good, "doc_id"), risk, delta)
    # At most one row for each stratum, of at most one entry for each rule.
    cutoffs = materialize(
        cutoffs.groupBy("stratum").agg(F.collect_list(F.struct("rule", "cutoff")).alias("cutoffs")),
        "rule_cutoffs",
    )
    names = F.array(*[F.lit(x) for x in RULES])
    marked = counts.withColumn("stratum", stratum()).withColumn("values", rule_values())
    marked = marked.join(F.broadcast(cutoffs), "stratum", "left")
    failed = F.coalesce(
        F.transform(
            F.filter("cutoffs", lambda x: F.col("values")[x["rule"]] > x["cutoff"]),
            lambda x: names[x["rule"]],
        ),
        F.array().cast("array<string>"),
    )
    return marked.select(
        *counts.columns,
        base_failed().alias("base_failed"),
        (~base_failed() & (F.size(failed) == 0)).alias("kept"),
        F.array_sort(failed).alias("failed"),
    )


def apply_quality_rules(
    docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed).

    One row for each row of ``docs``, repeated ones and ones without id included. A null text has
    no words and fails the fixed rules. Labels other than 0 and 1 or without id count for nothing;
    without labels the fixed rules alone decide. An empty table gives an empty result.
    """
    counts = rule_counts(docs.select(F.col("doc_id").cast("bigint"), "text")).drop("text")
    judged = judge(materialize(counts, "rule_counts"), labels, risk, delta)
    return judged.drop("n_lines", "n_upper", "n_bars", "n_bangs")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that fail neither the fixed rules nor a certified one, all columns."""
    counts = materialize(rule_counts(wrapped(docs)).drop("text"), "rule_counts")
    return judge(counts, labels).where("kept").select("_doc.*")
