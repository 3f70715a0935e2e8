"""Summarise the physical plan of every registered query.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md
For each query: shuffles (Exchange), broadcast / sort-merge / nested-loop joins,
windows, whether the lake scan has a partition filter, and the pushed filters.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pricepanel.plans import catalog
    from pricepanel.session import build_session
    spark = build_session()
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/plan_report.py {sf_dir}` (formatted explain, before AQE re-planning). "
          "Exch = shuffle exchanges in the main plan and its subqueries; BHJ / SMJ / BNLJ = broadcast hash, "
          "sort-merge, broadcast nested-loop joins; Win = window operators (WGL = with a per-key limit pushed "
          "before the shuffle); Lake pruned = the listing-lake scan carries a `dt` partition filter.\n")
    print("| query | Exch | BHJ | SMJ | BNLJ | Win | WGL | lake scans | lake pruned | pushed filters on lake |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name in sorted(catalog.QUERIES):
        try:
            txt = plan_text(catalog.QUERIES[name](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {type(e).__name__} |||||||||")
            continue
        ops = re.findall(r"^\(\d+\) (\w[\w ]*?)\s*$", txt, re.M)
        count = lambda k: sum(1 for o in ops if o.strip() == k)
        scans = re.split(r"^\(\d+\) Scan parquet", txt, flags=re.M)[1:]
        lake = [s for s in scans if "/prices" in s.split("\n(")[0] or "/mixed" in s.split("\n(")[0]]
        pruned = sum(1 for s in lake if re.search(r"PartitionFilters: \[.+\]", s.split("\n(")[0]))
        pushed = sorted({m for s in lake for m in re.findall(r"PushedFilters: \[(.*?)\]", s.split("\n(")[0]) if m})
        pf = "; ".join(p[:80] for p in pushed)[:160]
        wgl = txt.count("WindowGroupLimit") // 2
        print(f"| {name} | {count('Exchange')} | {count('BroadcastHashJoin')} | {count('SortMergeJoin')} | "
              f"{count('BroadcastNestedLoopJoin')} | {count('Window')} | {wgl} | {len(lake)} | {pruned} | {pf} |")


if __name__ == "__main__":
    main()
