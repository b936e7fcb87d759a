"""Summarise the executed (final adaptive) physical plan of every driver query.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
For each query: shuffles, join strategies, group limits, generators, Python
evaluation, pushed filters, and the columns each Parquet scan reads.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?Location: \w+\(\d+ paths?\)\[[^\]]*/(\w+)\.parquet\]", plan)
    pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", plan))
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan)),
        "reused": plan.count("ReusedExchange"),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "shj": plan.count("ShuffledHashJoin"),
        "bnlj": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "wgl": plan.count("WindowGroupLimit"),
        "generate": plan.count("Generate "),
        "python": plan.count("BatchEvalPython") + plan.count("ArrowEvalPython") + plan.count("FlatMapGroupsInPandas") + plan.count("MapInArrow"),
        "pushed": pushed,
        "scans": sorted({f"{t}({len([c for c in cols.split(',') if c.strip()])})" for cols, t in scans}),
    }


def main() -> None:
    from hirelens.session import build_session
    from hirelens.plans.registry import QUERIES
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    print("| query | shuffles | reused | BHJ | SMJ | SHJ | NLJ/cartesian | WindowGroupLimit | Generate | Python | scans with pushed filters | scans (columns read) |")
    print("|---|---|---|---|---|---|---|---|---|---|---|---|")
    for name, q in sorted(QUERIES.items()):
        df = q(spark, sf)
        df._jdf.queryExecution().toRdd().count()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        s = summarize(plan)
        print(f"| {name} | {s['shuffles']} | {s['reused']} | {s['bhj']} | {s['smj']} | {s['shj']} | {s['bnlj']} | "
              f"{s['wgl']} | {s['generate']} | {s['python']} | {s['pushed']} | {', '.join(s['scans'])} |")
    spark.stop()


if __name__ == "__main__":
    main()
