"""Command line: list the registered queries, print one's plan, or run one.

    python -m inforce list
    python -m inforce explain w12_running_ratio /path/to/tables
    python -m inforce run w12_running_ratio /path/to/tables --out /path/to/result [--format parquet]

``run`` writes the whole result with the DataFrame writer (nothing is
collected to the driver); without ``--out`` it prints the first 20 rows.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m inforce")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("explain", "run"):
        p = sub.add_parser(name)
        p.add_argument("query")
        p.add_argument("tables", help="folder holding the input tables as <name>.parquet")
        if name == "run":
            p.add_argument("--out")
            p.add_argument("--format", default="parquet")
    args = ap.parse_args(argv)

    from inforce.plans import ORACLES, QUERIES

    if args.cmd == "list":
        for n in sorted(QUERIES):
            print(n + ("" if n in ORACLES else "  (no SQL twin)"))
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"inforce-{args.query}").getOrCreate()
    df = QUERIES[args.query](spark, args.tables)
    if args.cmd == "explain":
        df.explain("formatted")
    elif args.out:
        df.write.mode("overwrite").format(args.format).save(args.out)
    else:
        df.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
