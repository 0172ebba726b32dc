from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from worked_example import REJECTED, kept_lines
from pairstats.functions.keys import nth_field, parsed as number_of, period_bucket, split_pair_key
from pairstats.functions.words import HEBREW_STOP_WORDS, stop_word_list
from pairstats.operators import clean
from pairstats.sources.stop_words import stop_words


def parsed(spark, rows):
    return clean.parse_ngram_lines(spark.createDataFrame([(r,) for r in rows], "line string"))


def pairs_of(df):
    return sorted(tuple(row) for row in df.collect())


def test_reject_reasons(lines):
    valid, rejects = clean.split_valid(lines, "english")
    assert {row.line: row.reason for row in rejects.collect()} == REJECTED
    assert sorted(row.line for row in valid.collect()) == sorted(kept_lines())


def test_reject_report_counts_every_line(lines):
    report = {row.reason: row.n_rows for row in clean.reject_report(lines, "english").collect()}
    assert report == {**Counter(REJECTED.values()), "kept": len(kept_lines())}


def test_trailing_blank_and_sign_are_accepted(spark):
    rows = ["new york \t+1991\t3\t1\t1", "new york   \t1991\t+3\t1", "new york\t1991\t3\t\t1"]
    found = pairs_of(clean.clean_pairs(parsed(spark, rows), "english"))
    assert found == [(1990, "new", "york", 3)] * 3


def test_kelvin_sign_is_a_letter_by_its_lower_case(spark):
    rows = ["King arthur\t1991\t3\t1\t1", "İstan bul\t1991\t3\t1\t1"]
    found = pairs_of(clean.clean_pairs(parsed(spark, rows), "english"))
    assert found == [(1990, "King", "arthur", 3)]


def test_parsed_columns(spark):
    row = parsed(spark, ["new york\t1991\t3\t4\t5\tmore", "york\t1991"]).collect()
    assert tuple(row[0])[1:] == (True, True, "new york", 1991, 3, 4, 5)
    assert tuple(row[1])[1:] == (False, False, "york", 1991, None, None, None)


def test_typed_facts_with_nulls(spark):
    schema = "ngram string, year int, match_count bigint"
    rows = [("new york", 1991, 2), (None, 1991, 2), ("new york", None, 2), ("new york", 1991, None)]
    ngrams = spark.createDataFrame(rows, schema)
    valid, rejects = clean.split_valid(ngrams, "english")
    assert valid.count() == 1
    assert sorted(r.reason for r in rejects.collect()) == [
        "bad_number",
        "bad_number",
        "not_two_words",
    ]


def test_hebrew_rules(spark):
    stop = HEBREW_STOP_WORDS[2]
    rows = {
        "שלום חברים": None,
        f"{stop} חברים": "stop_word",
        f"חברים {stop}": "stop_word",
        "שלוםa חברים": "non_letter",
        'צה"ל חברים': "non_letter",
        '" חברים': "stop_word",
        "new york": "non_letter",
        "שלום": "not_two_words",
    }
    ngrams = parsed(spark, [f"{ngram}\t1991\t2\t1\t1" for ngram in rows])
    _, rejects = clean.split_valid(ngrams, "hebrew")
    found = {row.ngram: row.reason for row in rejects.collect()}
    assert found == {ngram: reason for ngram, reason in rows.items() if reason}
    assert pairs_of(clean.clean_pairs(ngrams, "hebrew")) == [(1990, "שלום", "חברים", 2)]


def test_case_is_kept_unless_folded(spark):
    ngrams = parsed(spark, ["New York\t1991\t2\t1\t1", "new york\t1992\t3\t1\t1"])
    assert len({r[:3] for r in pairs_of(clean.clean_pairs(ngrams, "english"))}) == 2
    folded = pairs_of(clean.clean_pairs(ngrams, "english", fold_case=True))
    assert {r[:3] for r in folded} == {(1990, "new", "york")}


def test_stop_lists(spark, tmp_path):
    assert len(set(stop_word_list("english"))) == 319
    assert len(set(stop_word_list("hebrew"))) == 150
    assert {"the", "amoungst", "fify", "computer", "yourselves"} <= set(stop_word_list("english"))
    assert not {"did", "don", "just"} & set(stop_word_list("english"))
    assert stop_words(spark, "hebrew").count() == 150
    path = tmp_path / "words.txt"
    path.write_bytes("alpha\r\nbeta\r\n\r\nalpha\r\n".encode())
    assert pairs_of(stop_words(spark, "english", str(path))) == [("alpha",), ("beta",)]
    with pytest.raises(ValueError):
        stop_word_list("latin")


@pytest.mark.parametrize("hot", [1, 10**6])
def test_anti_join_equals_literal_list(spark, lines, monkeypatch, hot):
    monkeypatch.setattr(clean, "HOT_PAIRS", hot)
    words = stop_words(spark, "english")
    joined = clean.clean_pairs(lines, "english", stop_words=words)
    assert pairs_of(joined) == pairs_of(clean.clean_pairs(lines, "english"))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (hot == 1)  # the few hot words alone


def test_frequent_stop_word_is_spread(spark, settings, monkeypatch):
    """A word that starts a third of all pairs is dropped by many tasks, not by one."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", shuffle__partitions="32")
    i = F.col("id")
    w1 = F.when(i % 3 == 0, "The").otherwise(F.concat(F.lit("w"), i.cast("string")))
    pairs = spark.range(0, 30000, 1, 4).select(
        w1.alias("w1"), F.concat(F.lit("v"), i.cast("string")).alias("w2")
    )
    monkeypatch.setattr(clean, "HOT_PAIRS", 500)
    out = clean.drop_stop_pairs(pairs, stop_words(spark, "english"), "english")
    assert out.count() == 20000 and out.columns == ["w1", "w2"]
    found = pairs.where("w1 = 'The'").groupBy("w1").agg(F.count("*").alias("n_pairs"))
    marked, sliced = clean.slice_hot(pairs, found, ["w1"], "w2", 500)
    assert sliced.count() == 20
    sizes = marked.groupBy("w1", "_slice").count().agg(F.max("count")).first()[0]
    assert sizes < 800


def test_stop_words_in_any_case(spark, lines):
    """Lists match in any case, whether literal, table, or a list so long that it becomes one."""
    listed = ["York", "THE"]
    table = spark.createDataFrame([(w,) for w in listed], "word string")
    long = listed + [f"x{i}" for i in range(clean.LONG_LIST)]
    want = pairs_of(clean.clean_pairs(lines, "english", stop_words=["york", "the"]))
    assert want and not {w.lower() for r in want for w in r[1:3]} & {"york", "the"}
    for stop in (listed, table, long):
        assert pairs_of(clean.clean_pairs(lines, "english", stop_words=stop)) == want
    assert isinstance(clean.stop_table(spark, long), type(table))


def test_pair_outcomes_count_every_line(lines):
    found = clean.pair_outcomes(lines, "english").collect()
    rejected = Counter()
    for row in found:
        if row.reason is not None:
            rejected[row.reason] += row.n_facts
            assert row.w1 is None and row.period is None
    assert rejected == Counter(REJECTED.values())
    assert sum(r.n_facts for r in found if r.reason is None) == len(kept_lines())


def test_own_stop_words(lines):
    found = clean.clean_pairs(lines, "english", stop_words=["york", "it's", "back\\slash"])
    words = {w for row in found.collect() for w in (row.w1, row.w2)}
    assert "york" not in words and "York" not in words and "the" not in words
    assert "idea" in words


def test_period_bucket(spark):
    years = spark.createDataFrame([(1999,), (2000,), (-7,)], "year int")
    got = years.select(period_bucket(F.col("year")), period_bucket(F.col("year"), 25)).collect()
    assert [tuple(r) for r in got] == [(1990, 1975), (2000, 2000), (0, 0)]


def test_split_pair_key(spark):
    keys = spark.createDataFrame([("1990 new york",), ("x y",)], "key string")
    got = keys.select(*split_pair_key(F.col("key"))).collect()
    assert [tuple(r) for r in got] == [(1990, "new", "york"), (None, "y", "")]


@hypothesis_settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text("ab\t ", max_size=8), min_size=1, max_size=20))
def test_nth_field_is_split(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(*[nth_field(F.col("t"), "\t", n) for n in (1, 2, 3)]).collect()
    for text, row in zip(texts, got):
        fields = text.split("\t") + ["", ""]
        assert list(row) == fields[:3]


def _java_split(text: str, sep: str) -> list[str]:
    parts = text.split(sep)
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    return parts


def _reason(line: str, words: set[str]) -> str | None:
    """The checks in plain Python, one line at a time."""
    fields = _java_split(line, "\t")
    if len(fields) < 4:
        return "few_fields"
    tokens = _java_split(fields[0], " ")
    if len(tokens) != 2 or not all(tokens):
        return "not_two_words"
    low = [t.lower() for t in tokens]
    if words & set(low):
        return "stop_word"
    if not all(c in "abcdefghijklmnopqrstuvwxyz" for t in low for c in t):
        return "non_letter"
    for number in fields[1:3]:
        digits = number[1:] if number[:1] in ("+", "-") and number else number
        if not digits or not all(c in "0123456789" for c in digits):
            return "bad_number"
    return None if int(fields[2]) > 0 else "bad_number"


@hypothesis_settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.lists(
            st.sampled_from(
                "a|New|york|9|The|the| |  |\t|\t|1990|-3|0|x7".split("|")
            ),
            max_size=12,
        ).map("".join),
        min_size=1,
        max_size=30,
    )
)
def test_reasons_match_plain_python(spark, texts):
    words = ["the", "a"]
    ngrams = parsed(spark, texts)
    valid, rejects = clean.split_valid(ngrams, "english", words)
    want = [(t, _reason(t, set(words))) for t in texts]
    got = [(r.line, None) for r in valid.collect()]
    got += [(r.line, r.reason) for r in rejects.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_samples(spark):
    df = spark.range(20000).select("id", F.col("id").cast("string").alias("name"))
    half = clean.sample_by_hash(df, ["name"], 0.5)
    again = clean.sample_by_hash(df.repartition(7), ["name"], 0.5)
    assert pairs_of(half) == pairs_of(again)
    assert 9500 < half.count() < 10500
    assert clean.sample_by_hash(df, ["name"], 1.0).count() == 20000
    assert clean.sample_by_hash(df, ["name"], 0.0).count() == 0
    assert 9500 < clean.sample_rows(df, 0.5, seed=3).count() < 10500


def test_facts_and_rejects_out_of_one_scan(spark):
    """Both tables hold what two scans would give; each line is parsed and judged once."""
    rows = kept_lines() + list(REJECTED)
    seen = spark.sparkContext.accumulator(0)

    def count(line):
        seen.add(1)
        return (line,)

    rdd = spark.sparkContext.parallelize(rows, 5).map(count)
    lines = clean.parse_ngram_lines(spark.createDataFrame(rdd, "line string"))
    good, rejects = clean.split_valid_written(lines, "english")
    assert {r.line: r.reason for r in rejects.collect()} == REJECTED
    assert sorted(r.line for r in good.collect()) == sorted(kept_lines())
    assert seen.value == len(rows)
    plain_good, plain_rejects = clean.split_valid(lines, "english")
    assert good.schema == plain_good.schema and rejects.dtypes == plain_rejects.dtypes
    assert sorted(map(tuple, rejects.collect()), key=repr) == sorted(
        map(tuple, plain_rejects.collect()), key=repr
    )


def test_each_side_reads_its_own_folders(spark, lines):
    good, rejects = clean.split_valid_written(lines, "english")
    for df in (good, rejects):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(reason" in plan


def test_rejects_are_judged_above_the_parsing(spark):
    """No filter is moved below the parsing, where it would spell every field out for each mention."""
    made = spark.range(3).select(F.concat_ws("\t", "id", F.lit("1991"), F.lit("3")).alias("line"))
    _, rejects = clean.split_valid(clean.parse_ngram_lines(made), "english")
    plan = rejects._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Generate explode(array(CASE WHEN") :]
    assert "Filter" not in below and plan.count("split(") == 1
    assert sorted(tuple(r) for r in rejects.select("line", "reason").collect()) == [
        (f"{k}\t1991\t3", "few_fields") for k in range(3)
    ]


def test_failing_casts_are_told_beforehand(spark):
    """What a guarded cast gives is what the plain one gives."""
    texts = ["", "x", "1", "+1", "-1", "1.5", " 7 ", "\x1f8\x7f", "1 2", "--1", "+", "١", "\\N", None]
    texts += ["2147483647", "2147483648", "-9223372036854775808", "9223372036854775808", "1e3", "NaN", "007", " 5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in ("int", "bigint", "double"):
        got = df.select(number_of(F.col("t"), kind).alias("a"), F.col("t").try_cast(kind).alias("b")).collect()
        assert [repr(r["a"]) for r in got] == [repr(r["b"]) for r in got]
