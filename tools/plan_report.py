"""Physical-plan report for every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

For each query: number of shuffles (Exchange), broadcast exchanges, join
operators, whether any Cartesian / nested-loop join or Python UDF appears,
and the columns each parquet scan reads versus the table width.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOINS = ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct")
BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
       "FlatMapGroupsInPandas", "MapInPandas")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tidemark import plans
    from tidemark.session import local_session

    spark = local_session(8, 8)
    widths = {}
    for t in ("lineitem", "orders", "customer", "part", "supplier", "nation", "events", "embeddings"):
        widths[t] = len(spark.read.parquet(f"{sf_dir}/{t}.parquet").columns)
    print(f"# Physical plans ({sf_dir}, initial AQE plans)\n")
    print("| query | shuffles | broadcasts | joins | flagged | scans: columns read / width |")
    print("|---|---|---|---|---|---|")
    for name, q in plans.load_all().items():
        try:
            df = q.fn(spark, sf_dir)
            plan = df._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {type(e).__name__} | | | | |")
            continue
        ex = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        bx = plan.count("BroadcastExchange")
        joins = Counter(j for j in JOINS for _ in re.findall(rf"\b{j}\b", plan))
        flagged = [b for b in BAD if b in plan]
        scans = []
        for m in re.finditer(r"FileScan parquet \[([^\]]*)\][^\n]*?Location: InMemoryFileIndex[^\n]*?/([a-z]+)\.parquet", plan):
            cols, tbl = m.group(1), m.group(2)
            n = len([c for c in cols.split(",") if c.strip()])
            scans.append(f"{tbl} {n}/{widths.get(tbl, '?')}")
        js = ", ".join(f"{k} x{v}" for k, v in joins.items()) or "-"
        print(f"| {name} | {ex} | {bx} | {js} | {', '.join(flagged) or 'none'} | {'; '.join(scans) or '(checkpointed input)'} |")
    spark.stop()


if __name__ == "__main__":
    main()
