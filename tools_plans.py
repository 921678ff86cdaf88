"""Summarise the final (post-AQE) physical plan of every market query.

Runs each query once, then counts operators in the executed
plan.  Writes a markdown table to stdout; PLANS.md holds a copy.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

KEYS = [("scans", "FileScan parquet"), ("shuffles", "Exchange hashpartitioning"),
        ("range/single", "Exchange rangepartitioning"), ("broadcasts", "BroadcastExchange"),
        ("SMJ", "SortMergeJoin"), ("BHJ", "BroadcastHashJoin"), ("reused", "Reused"),
        ("windows", "Window ["), ("hash aggs", "HashAggregate"), ("sort aggs", "SortAggregate"),
        ("python", "FlatMapGroupsInPandas"), ("codegen stages", "WholeStageCodegen")]


def _finals(text: str) -> str:
    """Drop every '== Initial Plan ==' block (subqueries print both plans)."""
    out, skip, depth = [], False, 0
    for line in text.splitlines():
        if "== Initial Plan ==" in line:
            skip, depth = True, len(line) - len(line.lstrip(" :|+-"))
            continue
        if skip:
            d = len(line) - len(line.lstrip(" :|+-"))
            if "== Final Plan ==" in line or d < depth:
                skip = False
            else:
                continue
        out.append(line)
    return "\n".join(out)


def main(sf_dir: str) -> None:
    from marketlens.plans.queries import QUERIES
    from marketlens.session import local_session

    spark = local_session(8, app="marketlens-plans")
    print("| query | " + " | ".join(k for k, _ in KEYS) + " |")
    print("| --- " * (len(KEYS) + 1) + "|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan()
        plan.execute().count()  # runs it, and leaves the rows on the executors
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.executedPlan()  # the final plan after AQE re-planning
        text = "\n".join(line for line in plan.toString().splitlines()
                         if "Initial Plan" not in line)
        if "== Initial Plan ==" in plan.toString():
            text = _finals(plan.toString())
        # codegen stages appear as "*(n)" prefixes in the tree string
        counts = []
        for k, pat in KEYS:
            if k == "codegen stages":
                import re
                counts.append(str(len(set(re.findall(r"\*\((\d+)\)", text)))))
            else:
                counts.append(str(text.count(pat)))
        print(f"| {name} | " + " | ".join(counts) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
