"""Write PLANS.md: the physical-plan shape of every registered query with a SQL twin.

For each query: the jobs that run while it is built (fits, checkpoints, brackets of a quantile,
streams; invisible in the final plan), exchanges (shuffles), partial/final aggregates, broadcast exchanges,
sort-merge joins, window group limits, Python evaluation nodes, and the columns and filters each parquet scan reads. Broadcast choices made from table
sizes are scale-dependent (small test tables fall under the broadcast threshold); the
other properties hold at any scale.

usage: python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tessera.plans.catalog import oracle_sql, queries  # noqa: E402
from tessera.session import local_session  # noqa: E402

COUNTED = {
    "Exchange": r"\bExchange\b(?!.*SinglePartition)",
    "HashAggregate": r"\bHashAggregate\b",
    "BroadcastExchange": r"\bBroadcastExchange\b",
    "SortMergeJoin": r"\bSortMergeJoin\b",
    "WindowGroupLimit": r"\bWindowGroupLimit\b",
    "Python": r"\b(ArrowEvalPython|BatchEvalPython|MapInPandas|PythonMapInArrow)\b",
}


def shape(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    counts = {k: len(re.findall(p, plan)) for k, p in COUNTED.items()}
    scans = re.findall(r"FileScan parquet \[[^\]]*\].*?PushedFilters: \[([^\]]*)\], ReadSchema: (struct<[^>]*>)", plan)
    return {**counts, "scans": [(f or "-", s) for f, s in scans]}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    qs, sqls = queries(), oracle_sql()
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `scripts/plan_report.py` on `{sf_dir}` (local[8]). Counts are operators in the",
        "initial physical plan (subqueries included). `Exchange` counts shuffles (single-partition",
        "gathers of one-row aggregates excluded); every `HashAggregate` pair is a partial (map-side)",
        "plus final aggregate. Broadcasts chosen from table size depend on the scale: the small test",
        "tables fall below the broadcast threshold, a 100 TB table does not, and AQE re-plans at run",
        "time. Explicit broadcasts are bounded by a parameter.",
        "",
        "`jobs first` are the Spark jobs that run while the query is built, before its final plan.",
        "",
        "| query | jobs first | shuffles | hash aggs | broadcasts | SMJ | group limit | python | scans: pushed filters / read schema |",
        "| --- | --- | --- | --- | --- | --- | --- | --- | --- |",
    ]
    for name in sorted(sqls):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        s = shape(qs[name](spark, sf_dir))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}"))
        scans = "<br>".join(f"`{f}` / `{r}`" for f, r in s["scans"])
        lines.append(
            f"| {name} | {jobs} | {s['Exchange']} | {s['HashAggregate']} | {s['BroadcastExchange']} | {s['SortMergeJoin']} | "
            f"{s['WindowGroupLimit']} | {s['Python']} | {scans} |"
        )
        print(name, {k: v for k, v in s.items() if k != "scans"}, flush=True)
    Path(__file__).resolve().parents[1].joinpath("PLANS.md").write_text("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
