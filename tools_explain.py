"""Physical-plan summary of every registered query (markdown table).

python tools_explain.py [sf_dir]  - counts shuffles, broadcasts, join kinds,
partial group limits, pushed scan filters; flags cartesian/nested-loop joins.
"""

import re
import sys

from carelake.queries import REGISTRY
from carelake.session import build_session

SIDE_EFFECT = {"ingest_profile", "gated_run", "dq_history", "two_nights", "row_constraints", "table_properties"}


def summarize(plan: str) -> dict:
    lines = plan.split("\n")
    reused = sum(1 for ln in lines if "ReusedExchange" in ln)
    return {
        "shuffles": sum(1 for ln in lines if re.search(
            r"(?<!Reused)Exchange (hashpartitioning|rangepartitioning|SinglePartition|"
            r"RoundRobin)", ln) and "ReusedExchange" not in ln),
        "reused": reused,
        "broadcasts": sum(1 for ln in lines if "BroadcastExchange" in ln
                          and "ReusedExchange" not in ln),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "group_limit_partial": len(re.findall(r"WindowGroupLimit.*Partial", plan)),
        "scans": plan.count("FileScan parquet"),
        "pushed_filter_scans": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
        "cartesian_or_nlj": plan.count("CartesianProduct") + plan.count("NestedLoopJoin"),
    }


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan: what Catalyst chose
    if "--scale" in sys.argv:
        # as at cluster scale: no size-based broadcast of data tables; only the
        # explicitly size-checked lookups stay broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cols = ["shuffles", "reused", "broadcasts", "smj", "bhj", "group_limit_partial", "scans",
            "pushed_filter_scans", "cartesian_or_nlj"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in REGISTRY.items():
        if name in SIDE_EFFECT:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
