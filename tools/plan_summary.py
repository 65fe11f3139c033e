"""Count the exchanges and key operators in each registered query's physical
plan (before AQE re-planning), as a Markdown table.

    python tools/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(text: str) -> dict[str, int]:
    ops = re.findall(r"^\(\d+\) (\S+(?: \S+)?)", text, flags=re.M)
    hashed = sum(1 for line in text.splitlines() if line.startswith("Arguments: hashpartitioning"))
    ranged = sum(1 for line in text.splitlines() if line.startswith("Arguments: rangepartitioning"))
    return {
        "scans": sum(o.startswith("Scan") for o in ops),
        "hash shuffles": hashed,
        "range shuffles": ranged,
        "broadcasts": sum(o.startswith("BroadcastExchange") for o in ops),
        "partial aggs": len(re.findall(r"functions=\[partial_|Functions \[\d+\]: \[partial_", text)),
        "windows": sum(o == "Window" for o in ops),
        "group limits": sum(o.startswith("WindowGroupLimit") for o in ops),
        "sort-merge joins": sum(o.startswith("SortMergeJoin") for o in ops),
    }


def main(argv: list[str]) -> None:
    from tillroll.plans.registry import QUERIES
    from tillroll.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    rows = []
    for name, fn in QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain("formatted")
        rows.append((name, summary(buf.getvalue())))
    cols = list(rows[0][1])
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for name, s in rows:
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
