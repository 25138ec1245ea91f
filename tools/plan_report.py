"""Summarise the physical plan of every registered query as a markdown table.

    python tools/plan_report.py [sf_dir] > PLANS.md

Counts come from the final adaptive plan of a run: exchanges read a second time count as reused, joins that
Spark broadcast from measured sizes as broadcasts. Streams have a plan per micro-batch and are left out.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerflow import workloads  # noqa: E402
from ledgerflow.session import get_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", app="ledgerflow-plans", shuffle_partitions=16)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    print("# Plan shapes\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}`. *Shuffles* counts hash, range, "
          "round-robin and single-partition exchanges of the final plan; *reused* those read again; *bcast* "
          "broadcast exchanges; *scans* parquet scans.\n")
    print("| Query | Shuffles | Reused | Single-partition | Bcast | Scans | Python | Pushed filters | Columns read |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for n, fn in workloads.REGISTRY.items():
        if n.startswith("stream_"):
            continue
        df = fn(spark, sf)
        df.collect()
        qe = df._jdf.queryExecution()
        plan = qe.executedPlan().toString().split("+- == Initial Plan ==")[0]
        text = qe.explainString(mode)
        kinds = "hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition"
        shuffles = len(re.findall(rf"(?<!Reused)Exchange ({kinds})", plan))
        reused = plan.count("ReusedExchange")
        single = len(re.findall(r"Exchange SinglePartition", plan))
        bcast = len(re.findall(r"(?<!Reused)BroadcastExchange", plan))
        scans = len(re.findall(r"FileScan parquet", plan))
        py = any(k in plan for k in ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas",
                                     "MapInPandas"))
        pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", text) if p})
        reads = sorted({", ".join(f.split(":")[0] for f in r.split(","))
                        for r in re.findall(r"ReadSchema: struct<([^>]*)>", text)})
        print(f"| `{n}` | {shuffles} | {reused} | {single} | {bcast} | {scans} | {'yes' if py else 'no'} | "
              f"{'; '.join(pushed) or '-'} | {'; '.join(reads)} |")


if __name__ == "__main__":
    main()
