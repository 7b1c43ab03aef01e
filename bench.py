"""Benchmark the headline queries.

Runs each query to completion with the ``noop`` sink (full execution, nothing
collected to the driver) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and
prints ONE JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rec3_cell_diff",
    "rec1_missing_keys",
    "rec4_full_diff",
    "rec5_total_diff",
    "rec6_multiset_diff",
    "nrm_units",
    "met3_percent_cover",
    "met6_size_stats",
    "met14_renumber",
    "met16_assemble_margin",
    "site45_resolve_latest",
    "qc9_box_stats",
    "com2_centroid_distance",
    "com3_permanova",
    "geo1_transect_rectangle",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    only = sys.argv[1:]
    from tidemark import plans
    from tidemark.session import local_session

    n = int(cpus) if cpus.isdigit() else os.cpu_count() or 4
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(4 * n, 16))))
    spark = local_session(cpus, shuffle_partitions=parts, app="tidemark-bench")
    qs = plans.queries()
    times: dict[str, float] = {}
    # warm-up, not timed: run every headline query once on the smallest
    # tables so class loading and code generation are not charged to sf0.1
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in HEADLINE:
            if not only or name in only:
                qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
