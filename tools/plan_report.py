"""Physical-plan summary of every registered query of the reference's operators.

For each query: number of shuffles (Exchange), Parquet scans, sort-based
aggregates, broadcast joins and sort-merge joins in the executed plans, those of
tables it writes while it is built included ("writes": their number), plus a flag for anything that should never appear (cartesian products, nested-loop
joins, Python UDFs). Run with broadcasts disabled to see the plan a large
input gets: ``python tools/plan_report.py [sf_dir] [--no-broadcast] [name-prefix ...]``.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def main(argv: list[str]) -> None:
    sf_dir = next((a for a in argv[1:] if os.path.isdir(a)), "/root/testdata/sf0.01")
    from inforce.session import local_session

    spark = local_session(4)
    if "--no-broadcast" in argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    from inforce.plans import QUERIES

    # plans of the tables that a query writes while it is built
    from pyspark.sql.readwriter import DataFrameWriter

    written, write = [], DataFrameWriter.parquet

    def noted(self, *args, **kwargs):
        written.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kwargs)

    DataFrameWriter.parquet = noted
    print("| query | writes | shuffles | scans | columns read / table width | sort aggs | broadcast joins | sort-merge joins | flags |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    widths = {}
    prefixes = tuple(a for a in argv[1:] if not a.startswith("--") and not os.path.isdir(a))
    for name, fn in sorted(QUERIES.items()):
        if prefixes and not name.startswith(prefixes):
            continue
        written.clear()
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        plan = "\n".join([plan, *written])
        reads = {}
        for cols, loc in re.findall(r"FileScan parquet \[([^\]]*)\].*?Location: [^\[]*\[[^\]]*/(\w+)\.parquet\]", plan):
            reads[loc] = max(reads.get(loc, 0), len([c for c in cols.split(",") if c.strip()]))
        for t in reads:
            if t not in widths:
                widths[t] = len(spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet")).columns)
        pruning = ", ".join(f"{t} {n}/{widths[t]}" for t, n in sorted(reads.items()))
        row = [
            len(written),
            len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
            len(re.findall(r"FileScan parquet", plan)),
            pruning,
            len(re.findall(r"SortAggregate", plan)),
            len(re.findall(r"BroadcastHashJoin", plan)),
            len(re.findall(r"SortMergeJoin", plan)),
        ]
        flags = [b for b in BAD if b in plan]
        print(f"| {name} | " + " | ".join(map(str, row)) + f" | {' '.join(flags) or '-'} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
