"""Summarise the physical plan of every registered query (writes PLANS.md).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Counts come from the planned (pre-AQE) physical plan of each query over the
warehouse built from ``sf_dir``.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FEATURES = [
    ("shuffles", r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)"),
    ("single-partition", r"Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("bhj", r"BroadcastHashJoin"),
    ("smj", r"SortMergeJoin"),
    ("expand", r"Expand \["),
    ("window-group-limit", r"WindowGroupLimit"),
    ("take-ordered", r"TakeOrderedAndProject"),
    ("scans", r"FileScan parquet"),
]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from encore.plans.catalog import QUERIES
    from encore.session import build_session
    from encore.sources.warehouse import warehouse_for
    spark = build_session("local[8]", shuffle_partitions=16)
    wh = warehouse_for(spark, sf_dir)
    print("# Physical plan summary\n")
    print(f"Generated by `tools/plan_report.py` over `{sf_dir}` (planned physical plan, before AQE).")
    print("Scans list the columns each parquet scan reads and the filters pushed into it.\n")
    print("| query | " + " | ".join(n for n, _ in FEATURES) + " | scan columns / pushed filters |")
    print("|---" * (len(FEATURES) + 2) + "|")
    for key, fn in QUERIES.items():
        plan = fn(wh)._jdf.queryExecution().executedPlan().toString()
        counts = [str(len(re.findall(rx, plan))) for _, rx in FEATURES]
        scans = []
        for m in re.finditer(r"FileScan parquet \[([^\]\n]*)\][^\n]*?PushedFilters: \[([^\n]*?)\], ReadSchema", plan):
            cols = ",".join(c.split("#")[0] for c in m.group(1).split(","))
            pushed = m.group(2)
            scans.append(f"`{cols}`" + (f" ⟂ `{pushed}`" if pushed else ""))
        print(f"| {key} | " + " | ".join(counts) + " | " + "<br>".join(scans) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
