"""Summarise the physical plan of each registered query: exchanges, joins,
window limits, Python nodes, scan columns. Usage: python tools/plan_summary.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KINDS = ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "Exchange RoundRobinPartitioning", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
         "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "WindowGroupLimit",
         "Window ", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Generate",
         "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "TakeOrderedAndProject")


def main():
    args = [a for a in sys.argv[1:] if a != "--markdown"]
    markdown = "--markdown" in sys.argv
    sf = args[0] if args else "/root/testdata/sf0.01"
    only = set(args[1:])
    if markdown:
        print("| query | physical operators (static plan, AQE off) | columns read | pushed filters |")
        print("| --- | --- | --- | --- |")
    from newsarc.plans.queries import QUERIES
    from newsarc.session import build_session
    spark = build_session("local[8]", 8, "plans")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # the static plan, before AQE rewrites
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = {k.strip(): len(re.findall(re.escape(k), plan)) for k in KINDS}
        counts = {k: v for k, v in counts.items() if v}
        scans = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
        pushed = sorted(set(x for x in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if x))
        if markdown:
            short = {k.replace("Exchange ", "").replace("partitioning", "").replace("Partitioning", ""): v
                     for k, v in counts.items()}
            cell = ", ".join(f"{k} {v}" for k, v in short.items()) or "—"
            cols = "; ".join(s[len("struct<"):-1] for s in scans)
            print(f"| `{name}` | {cell} | {cols} | {'; '.join(pushed) or '—'} |")
        else:
            print(name, counts, "scan:", scans, "pushed:", pushed)
    spark.stop()


if __name__ == "__main__":
    main()
