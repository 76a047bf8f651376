"""Command line: every flow, then the checks and the six questions.

    python -m landfall --extracts DIR --labels DIR --root DIR [--airports CSV]
                       [--format parquet|csv] [--year 2016] [--exclude INDIA "CHINA, PRC"]

Runs landing, profiling, labels, staging and the star (``plans.flows.run_all``)
against the session's cluster, prints every failed check and the answers
to Q1-Q6 for ``--year``.  Exit status 1 when a check fails.
"""

from __future__ import annotations

import argparse
import sys

from landfall.plans import analysis
from landfall.plans.flows import run_all
from landfall.schemas import EXCLUDED_COUNTRIES
from landfall.session import build_session


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="landfall", description=__doc__.split("\n\n")[0])
    p.add_argument("--extracts", required=True, help="folder of monthly extract files")
    p.add_argument("--labels", required=True, help="folder of the *.txt label files")
    p.add_argument("--root", required=True, help="folder for the lake, staging and star tables")
    p.add_argument("--airports", help="airport codes CSV with a header")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="extract file format")
    p.add_argument("--year", type=int, default=2016, help="arrival year the questions ask about")
    p.add_argument("--gender", default="F", help="gender for Q2 and Q4")
    p.add_argument("--exclude", nargs="*", default=list(EXCLUDED_COUNTRIES),
                   help="country names Q4 leaves out (compared upper-cased)")
    p.add_argument("--exclude-mode", default="Air", help="mode of entry Q5 leaves out")
    p.add_argument("--master", default=None, help="Spark master (default: the session's)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parse_args(argv)
    spark = spark or build_session(args.master)
    star, checks = run_all(spark, args.extracts, args.labels, args.root, args.airports, args.format)
    failed = checks.where("NOT passed").orderBy("check_name", "table_name", "column_name")
    n_failed = failed.count()
    print(f"checks failed: {n_failed}")
    if n_failed:
        failed.show(n_failed, truncate=False)
    y = args.year
    questions = [
        ("Q1 top visa types", analysis.top_visa_types(star, y)),
        ("Q2 top visa categories", analysis.top_visa_categories(star, y, gender=args.gender)),
        ("Q3 best state per visa type", analysis.top_state_per_visa(star, y)),
        ("Q4 top countries", analysis.top_countries(star, y, gender=args.gender, exclude=args.exclude)),
        ("Q5 top mode of entry", analysis.top_mode_except(star, y, exclude=args.exclude_mode)),
        ("Q6 top ports", analysis.top_ports(star, y)),
    ]
    for title, df in questions:
        print(f"{title} ({y})")
        df.show(max(1, df.count()), truncate=False)
    return 1 if n_failed else 0


if __name__ == "__main__":
    sys.exit(main())
