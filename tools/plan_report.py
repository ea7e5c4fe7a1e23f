"""Summarise the physical plan of every catalogue query (for review at scale).

usage: python tools/plan_report.py [SF_DIR] > PLANS.md
Counts shuffles, broadcasts, join kinds, windows, scans with pushed filters,
and flags nested-loop / cartesian joins and Python UDF nodes.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from punctua.session import get_spark  # noqa: E402

PATTERNS = {
    "shuffles": r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition|\bExchange RoundRobin",
    "single_partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "shj": r"ShuffledHashJoin",
    "nested_loop": r"BroadcastNestedLoopJoin|CartesianProduct",
    "windows": r"^\s*[:+\- ]*Window \[",
    "group_limit_partial": r"WindowGroupLimit .*Partial",
    "hash_aggs": r"HashAggregate",
    "scans": r"FileScan parquet",
    "pushed": r"PushedFilters: \[[^\]]+\]",
    "python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsIn|MapInPandas|MapInArrow",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from punctua.plans import registry
    registry.load_all()
    spark = get_spark(shuffle_partitions=8)
    qs = registry.QUERIES  # the training-data operators run in stages of their own
    cols = list(PATTERNS)
    print(f"# Physical plans of the query catalogue ({os.path.basename(sf_dir)}, initial AQE plans)\n")
    print("Generated by `tools/plan_report.py`. `single_partition` and `nested_loop` must stay 0 for")
    print("queries whose inputs grow with the data; `pushed` counts scans with filters pushed into parquet. What a query writes")
    print("and reads back before it returns (`materialize`, streams) is not in its plan here.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for name in sorted(qs):
        df = qs[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(PATTERNS[c], plan, flags=re.M)) for c in cols]
        print(f"| {name} | " + " | ".join(str(n) for n in counts) + " |")


if __name__ == "__main__":
    main()
