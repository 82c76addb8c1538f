"""Summarise the physical plans of the headline queries: shuffles, broadcasts, windows,
generators and the columns each parquet scan reads (column pruning)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"/(\w+)\.parquet\][^\n]*?ReadSchema: struct<([^>]*)>", plan)
    return {
        "exchanges": len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)",
                                    plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "windows": len(re.findall(r"\bWindow\b", plan)),
        "generates": plan.count("Generate "),
        "scans": {t: [c.split(":")[0] for c in cols.split(",")] for t, cols in scans},
    }


def main() -> None:
    import bench
    from arborlex.session import local_session

    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    for name, fn in bench.headline(spark, d).items():
        s = summary(fn(spark, d))
        scans = "; ".join(f"{t}({', '.join(c)})" for t, c in s["scans"].items())
        print(f"{name:18s} shuffles={s['exchanges']} broadcasts={s['broadcasts']} windows={s['windows']} "
              f"generators={s['generates']} | {scans}")


if __name__ == "__main__":
    main()
