from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from pairstats import (
    RunCounters,
    association_counts,
    association_scores,
    extract_collocations,
    select_collocations,
    stage_counts,
)
from pairstats.__main__ import main
from pairstats.operators.clean import clean_pairs, parse_ngram_lines
from pairstats.operators.counts import pair_counts, with_all_counts
from pairstats.sinks.stage import read_stage, write_stage
from pairstats.sinks.text import write_scored_text
from pairstats.sources.scored import read_scored_text
from worked_example import EXPECTED, REJECTED, kept_lines, rounded


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def test_whole_run_by_hand(lines):
    got = rows_of(extract_collocations(lines, "english", 0.7, 0.3))
    want = [r for r in EXPECTED if r[-1]]
    want = sorted(want, key=lambda r: (r[0], -r[7], r[1], r[2]))
    assert [(p, w1, w2, rounded(s)) for p, w1, w2, s in got] == [(*r[:3], r[7]) for r in want]


def test_ties(lines):
    keep = rows_of(extract_collocations(lines, "english", 0.7, 0.3))
    one = rows_of(
        extract_collocations(lines, "english", 0.7, 0.3, ties="one_per_score", digits=9)
    )
    assert set(one) < set(keep)
    assert (1970, "blue", "fox") in {r[:3] for r in one}
    with pytest.raises(ValueError):
        extract_collocations(lines, "english", 0.7, 0.3, ties="drop")


def test_kept_scores(lines):
    out = extract_collocations(lines, "english", 0.7, 0.3, keep_scores=True)
    assert out.columns == ["period", "w1", "w2", "c12", "c1", "c2", "n", "npmi", "rel_npmi"]


def test_thresholds_outside_the_usual_range(lines):
    assert len(rows_of(extract_collocations(lines, "english", -2, 99))) == 18
    assert rows_of(extract_collocations(lines, "english", 2, 99)) == []


def test_stage_by_stage_equals_one_run(spark, lines, tmp_path):
    """Each step from the files of the step before, in Parquet and in text."""
    paths = [str(tmp_path / name) for name in ("pairs", "counts", "scores", "text")]
    write_stage(pair_counts(clean_pairs(lines, "english")), paths[0])
    write_stage(with_all_counts(read_stage(spark, paths[0])), paths[1])
    scores = association_scores(read_stage(spark, paths[1]))
    write_stage(scores, paths[2])
    want = rows_of(extract_collocations(lines, "english", 0.7, 0.3))
    assert rows_of(select_collocations(read_stage(spark, paths[2]), 0.7, 0.3)) == want
    write_scored_text(scores, paths[3], ["npmi", "rel_npmi"])
    text = read_scored_text(spark, paths[3], {"npmi": "double", "rel_npmi": "double"})
    assert rows_of(select_collocations(text, 0.7, 0.3)) == want


def test_stage_counts(lines):
    got = {r.stage: r.n_rows for r in stage_counts(lines, "english", 0.7, 0.3, digits=9).collect()}
    chosen = [r for r in EXPECTED if r[-1]]
    assert got == {
        "input": len(kept_lines()) + len(REJECTED),
        "kept": len(kept_lines()),
        "pairs": len(EXPECTED),
        "scored": len(EXPECTED),
        "selected": len(chosen),
        "distinct_scores": len({(r[0], r[7]) for r in chosen}),
    }


def brute_force(rows, low, rel_low):
    """The whole run in plain Python: {(period, w1, w2): score}."""
    pair, left, right, total = Counter(), Counter(), Counter(), Counter()
    for w1, w2, year, count in rows:
        period = year - year % 10
        pair[period, w1, w2] += count
        left[period, w1] += count
        right[period, w2] += count
        total[period] += count
    scores, sums = {}, defaultdict(float)
    for (period, w1, w2), c in pair.items():
        n = total[period]
        if c == n:
            continue
        pmi = math.log(c) + math.log(n) - math.log(left[period, w1]) - math.log(right[period, w2])
        scores[period, w1, w2] = pmi / -(math.log(c) - math.log(n))
        sums[period] += scores[period, w1, w2]
    return {
        key: score
        for key, score in scores.items()
        if score >= low or (sums[key[0]] and score / sums[key[0]] >= rel_low)
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force_with_hot_words(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("bcdfgh", k=3)) + "q" for _ in range(60)]
    rows = []
    for _ in range(4000):
        w1 = "hotq" if rng.random() < 0.35 else rng.choice(words)
        w2 = "hotq" if rng.random() < 0.35 else rng.choice(words)
        year = 1990 if rng.random() < 0.35 else rng.randint(1950, 2009)
        rows.append((w1, w2, year, rng.randint(1, 9)))
    lines = [(f"{a} {b}\t{y}\t{c}\t1\t1",) for a, b, y, c in rows]
    ngrams = parse_ngram_lines(spark.createDataFrame(lines, "line string").repartition(7))
    got = {r[:3]: r[3] for r in rows_of(extract_collocations(ngrams, "english", 0.3, 0.01))}
    want = brute_force(rows, 0.3, 0.01)
    assert got.keys() == want.keys() and len(got) > 50
    for key, score in want.items():
        assert got[key] == pytest.approx(score, abs=1e-9)


def test_period_width(lines):
    counts = association_counts(lines, "english", width=100)
    assert {r[0] for r in rows_of(counts)} == {1900, 2000}


def test_command_line(spark, tmp_path):
    text = tmp_path / "in"
    text.mkdir()
    (text / "part-0").write_text("\n".join(kept_lines() + ["york\t1991\t7\t1\t1"]) + "\n")
    out, report, words = (str(tmp_path / n) for n in ("out", "report", "words.txt"))
    (tmp_path / "words.txt").write_text("the\nidea\n")
    base = ["0.7", "0.3", "english", str(text)]
    main([*base, out, "--source", "text", "--report", report, "--top", "1"])
    want = [r[:3] for r in EXPECTED if r[-1]]
    assert sorted(r[:3] for r in rows_of(read_scored_text(spark, out))) == sorted(want)
    assert read_scored_text(spark, report).count() == len({r[0] for r in want})
    main([*base, out + "2", "--source", "text", "--stop-words", words, "--ties", "one_per_score"])
    assert "idea" not in {r[2] for r in rows_of(read_scored_text(spark, out + "2"))}
    with pytest.raises(SystemExit):
        main(["0.7", "0.3", "latin", str(text), out])


def test_counters_of_a_run_equal_the_counted_stages(spark, lines):
    lines = lines.repartition(6)
    want = {r.stage: r.n_rows for r in stage_counts(lines, "english", 0.7, 0.3, digits=9).collect()}
    counters = RunCounters()
    found = extract_collocations(lines, "english", 0.7, 0.3, counters=counters)
    assert counters.rows("input", "kept", "pairs", "scored") == {
        stage: want[stage] for stage in ("input", "kept", "pairs", "scored")
    }
    assert counters.rows("scored") == {"scored": want["scored"]}
    found.collect()
    assert counters.rows() == {k: v for k, v in want.items() if k != "distinct_scores"}
    ties = RunCounters()
    one = extract_collocations(
        lines, "english", 0.7, 0.3, ties="one_per_score", digits=9, counters=ties
    )
    one.collect()
    assert ties.rows() == want


def test_counters_serve_one_run(lines):
    counters = RunCounters()
    association_counts(lines, "english", counters=counters)
    with pytest.raises(ValueError):
        association_counts(lines, "english", counters=counters)


def test_counters_change_no_row(lines):
    with_counters = extract_collocations(lines, "english", 0.7, 0.3, counters=RunCounters())
    assert rows_of(with_counters) == rows_of(extract_collocations(lines, "english", 0.7, 0.3))


def test_shell_run_with_rejects_and_counters(spark, tmp_path, capsys):
    source = tmp_path / "in"
    source.mkdir()
    bad = [line for line in REJECTED if "\n" not in line]
    (source / "part-0").write_text("\n".join([*kept_lines(), *bad]) + "\n")
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    arguments = ["0.7", "0.3", "english", str(source), out, "--source", "text"]
    main([*arguments, "--rejects", rejects, "--counters"])
    got = {r.line: r.reason for r in spark.read.parquet(rejects).collect()}
    assert got == {line: REJECTED[line] for line in bad}
    printed = dict(line.split("\t") for line in capsys.readouterr().out.splitlines() if "\t" in line)
    kept = [r for r in EXPECTED if r[-1]]
    assert printed["kept"] == str(len(kept_lines())) and printed["selected"] == str(len(kept))
    assert read_scored_text(spark, out).count() == len(kept)
