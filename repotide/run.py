"""Command line: start one of the stream programs, or write the report of a run.

    spark-submit repotide/run.py repos --input <folder> --out <folder> --checkpoint <folder>
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from repotide.fixed import BATCH_SECONDS, LANGUAGES, NUMBER_BATCH_SECONDS, TRACKED  # noqa: E402
from repotide.session import get_session  # noqa: E402
from repotide.sinks.report import write_report  # noqa: E402
from repotide.sources import feeds  # noqa: E402
from repotide.streaming.app import run_report_of, start_repo_analytics  # noqa: E402
from repotide.streaming.queries import start, to_table  # noqa: E402
from repotide.streaming.labels import (  # noqa: E402
    start_bucket_analytics,
    start_number_analytics,
)

FORMS = {"json": feeds.json_feed, "envelope": feeds.envelope_feed, "tsv": feeds.tsv_feed}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(
        description=__doc__, formatter_class=argparse.RawTextHelpFormatter
    )
    programs = top.add_subparsers(dest="program", required=True)
    for name, seconds in (
        ("repos", BATCH_SECONDS),
        ("buckets", BATCH_SECONDS),
        ("numbers", NUMBER_BATCH_SECONDS),
    ):
        program = programs.add_parser(name)
        program.add_argument("--input", required=True)
        program.add_argument("--out", required=True)
        program.add_argument("--checkpoint", required=True)
        program.add_argument("--every", type=int, default=seconds, help="batch interval in seconds")
        program.add_argument("--once", action="store_true", help="work off what is there and end")
        if name == "numbers":
            text = "totals at every interval, also without new numbers"
            program.add_argument("--steady", action="store_true", help=text)
        else:
            usual = "json" if name == "repos" else "tsv"
            program.add_argument("--form", choices=FORMS, default=usual)
        if name == "repos":
            program.add_argument("--languages", nargs="+", choices=LANGUAGES, default=TRACKED)
    report = programs.add_parser("report")
    report.add_argument("--out", required=True, help="the folder the repos program wrote to")
    report.add_argument("--to", required=True)
    report.add_argument("--started", type=int, required=True, help="epoch seconds")
    report.add_argument("--ended", type=int, required=True, help="epoch seconds")
    report.add_argument("--languages", nargs="+", default=TRACKED)
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = get_session(f"repotide-{args.program}")
    if args.program == "report":
        lines = run_report_of(spark, args.out, args.started, args.ended, args.languages)
        write_report(lines, args.to)
        return
    every = None if args.once else args.every
    places = (args.out, args.checkpoint, every)
    read = feeds.number_feed if args.program == "numbers" else FORMS[args.form]
    feed = read(spark, args.input)
    bad_lines = to_table(f"{args.out}/bad_lines")
    queries = [start(feed.rejects, bad_lines, f"{args.checkpoint}/bad_lines", "append", every)]
    if args.program == "numbers":
        queries += start_number_analytics(feed.rows, *places, steady=args.steady)
    elif args.program == "buckets":
        queries += start_bucket_analytics(feed.rows, *places)
    else:
        # Rows without a language stay in, so that they show up among the rejects.
        wanted = F.col("language").isNull() | F.col("language").isin(*args.languages)
        queries += start_repo_analytics(
            feed.rows.where(wanted), *places, quiet=False, languages=args.languages
        )
    for query in queries:
        query.awaitTermination()


if __name__ == "__main__":
    main()
