"""Summarise the physical plan of every registered batch query (PLANS.md).

For each query: shuffle exchanges, single-partition exchanges (and what
feeds them), broadcast exchanges, partial top-N (WindowGroupLimit), sort
aggregates, and the columns each parquet scan reads.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    lines = plan.splitlines()
    single = []
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            child = next((l for l in lines[i + 1:i + 4] if l.strip()), "")
            child = re.sub(r"^[\s:+\-]*(\*\(\d+\)\s*)?", "", child)
            single.append(re.split(r"[ \[(]", child)[0])
    scans = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange RoundRobinPartitioning", plan)),
        "single": single,
        "broadcasts": plan.count("BroadcastExchange"),
        "group_limit": plan.count("WindowGroupLimit"),
        "sort_agg": plan.count("SortAggregate"),
        "python": bool(re.search(r"FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython", plan)),
        "scans": scans,
    }


def main() -> None:
    from rivulet.plans.registry import all_queries
    from rivulet.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan, before runtime re-planning
    print("# Physical plan summary of the registered batch queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}` with adaptive execution off (static plans; at run time")
    print("AQE may turn small joins into broadcasts and coalesce partitions).  `single` lists the operator")
    print("feeding each single-partition exchange: only bounded inputs (top-N merges, per-bucket tables,")
    print("one-row scalars) may appear there; here every one is a `HashAggregate` producing either the")
    print("per-bucket carry table of an ungrouped running sum (one row per time bucket) or the one-row")
    print("`max(timestamp)` of retention.  Streaming queries (`stream_*`) run eagerly and are covered by")
    print("their tests instead.\n")
    print("| query | shuffles | single-partition inputs | broadcasts | partial top-N | sort agg | Python | scans read |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, q in sorted(all_queries().items()):
        if name.startswith("stream_"):
            continue
        df = q.fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        scans = "<br>".join(s["scans"])
        single = ", ".join(s["single"]) or "-"
        print(f"| {name} | {s['shuffles']} | {single} | {s['broadcasts']} | {s['group_limit']} | "
              f"{s['sort_agg']} | {'yes' if s['python'] else 'no'} | {scans} |")
    spark.stop()


if __name__ == "__main__":
    main()
