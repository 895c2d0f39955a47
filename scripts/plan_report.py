"""Physical-plan summary per registered query (after execution, so the
adaptive plan is final): shuffles, join strategies, windows, Python nodes.

usage: python scripts/plan_report.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from encore.plans.queries import QUERIES  # noqa: E402
from encore.session import local_session  # noqa: E402

NODES = ["Exchange", "ReusedExchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
         "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window",
         "WindowGroupLimit", "FlatMapGroupsInPandas", "ArrowEvalPython", "BatchEvalPython",
         "Generate"]


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()          # run this very execution, so its adaptive plan is final
    p = qe.executedPlan().toString()
    # keep the final adaptive plan only
    if "== Final Plan ==" in p:
        p = p.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    return p


def main():
    args = sys.argv[1:]
    d = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or [
        n for n in QUERIES if not n.startswith("als_grid")]
    spark = local_session()
    print(f"| query | {' | '.join(NODES)} |")
    print("|---|" + "---|" * len(NODES))
    for n in names:
        p = final_plan(QUERIES[n](spark, d))
        counts = [len(re.findall(r"(?<![A-Za-z])" + k + r"(?![A-Za-z])", p)) for k in NODES]
        # "Exchange" also matches inside BroadcastExchange/ReusedExchange names
        print(f"| {n} | " + " | ".join(str(c) if c else "" for c in counts) + " |")


if __name__ == "__main__":
    main()
