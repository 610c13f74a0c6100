"""Write PLANS.md: for each headline (bench) query, the final physical plan
facts after AQE — scans with their pushed filters and read schema, join
strategies, exchanges, windows — taken from ``explain('formatted')``.

usage: python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oreflow.plans.registry import all_queries  # noqa: E402
from oreflow.session import build_session  # noqa: E402

OPS = ["Exchange", "BroadcastExchange", "ReusedExchange", "SortMergeJoin", "BroadcastHashJoin",
       "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "HashAggregate",
       "ObjectHashAggregate", "SortAggregate", "MapInPandas", "FlatMapGroupsInPandasWithState"]


def facts(plan: str) -> dict:
    head = plan.split("\n\n(1)")[0]
    counts = {op: len(re.findall(rf"\b{op}\b", head)) for op in OPS}
    scans = []
    for block in re.split(r"\n\(\d+\) ", plan):
        if block.startswith("Scan parquet"):
            loc = re.search(r"Location: [^\[]*\[([^\]]*)\]", block)
            pf = re.search(r"PushedFilters: (\[.*?\])", block)
            rs = re.search(r"ReadSchema: (struct<.*?>)", block)
            scans.append((os.path.basename(loc.group(1)) if loc else "?", pf.group(1) if pf else "[]",
                          rs.group(1) if rs else "?"))
    return {"counts": counts, "scans": scans}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    lines = ["# PLANS", "", f"Final physical plans (after AQE) of the headline queries at `{sf}`,",
             "generated by `scripts/plan_report.py` from `explain('formatted')`.", ""]
    for name, q in all_queries().items():
        if not q.bench:
            continue
        df = q.fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        f = facts(plan)
        c = {k: v for k, v in f["counts"].items() if v}
        lines += [f"## {name}", "", "operators: " + ", ".join(f"{k} x{v}" for k, v in c.items()), "",
                  "| table | pushed filters | read schema |", "| --- | --- | --- |"]
        for t, pf, rs in f["scans"]:
            lines.append(f"| {t} | `{pf}` | `{rs}` |")
        lines.append("")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main()
