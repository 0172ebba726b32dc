"""Run from a shell: ``python -m pairstats``, or on a cluster ``spark-submit submit.py``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from pairstats.functions.words import LANGUAGES
from pairstats.operators.clean import split_valid_written
from pairstats.plans.collocations import TIES, extract_collocations
from pairstats.plans.counters import RunCounters
from pairstats.session import SETTINGS
from pairstats.sinks.text import write_scored_text, write_top_k_report
from pairstats.sources.ngrams import READERS
from pairstats.sources.stop_words import stop_words


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pairstats", description=__doc__)
    parser.add_argument("min_npmi", type=float, help="smallest score")
    parser.add_argument("rel_min_npmi", type=float, help="or smallest share of the period's sum")
    parser.add_argument("language", choices=LANGUAGES)
    parser.add_argument("input", help="path of the 2-gram facts")
    parser.add_argument("output", help="path of the ranked text, must be new")
    parser.add_argument("--source", choices=sorted(READERS), default="sequence")
    parser.add_argument("--width", type=int, default=10, help="years in a period")
    parser.add_argument("--ties", choices=TIES, default="keep")
    parser.add_argument("--fold-case", action="store_true")
    parser.add_argument("--sample", type=float, help="share of the facts to use")
    parser.add_argument("--seed", type=int, help="seed of the sample")
    parser.add_argument("--stop-words", help="path of a text file, one word per line")
    parser.add_argument("--report", help="path of a report of the best pairs, must be new")
    parser.add_argument("--top", type=int, default=10, help="pairs per period in the report")
    parser.add_argument("--rejects", help="path of the rejected facts with reasons, must be new")
    parser.add_argument("--counters", action="store_true", help="print the rows of each stage")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("pairstats").config(map=SETTINGS).getOrCreate()
    ngrams = READERS[args.source](spark, args.input, args.sample, args.seed)
    words = stop_words(spark, args.language, args.stop_words) if args.stop_words else None
    counters = RunCounters() if args.counters else None
    if args.rejects:
        # A list of one's own comes after the other checks here, as it may be a table of any size.
        ngrams, rejects = split_valid_written(ngrams, args.language, [] if args.stop_words else None)
        rejects.write.mode("errorifexists").parquet(args.rejects)
    found = extract_collocations(
        ngrams,
        args.language,
        args.min_npmi,
        args.rel_min_npmi,
        width=args.width,
        ties=args.ties,
        fold_case=args.fold_case,
        stop_words=words,
        counters=counters,
    )
    write_scored_text(found, args.output)
    if counters:
        for stage, rows in counters.rows().items():
            print(f"{stage}\t{rows}")
    if args.report:
        write_top_k_report(found, args.report, args.top)


if __name__ == "__main__":
    main()
