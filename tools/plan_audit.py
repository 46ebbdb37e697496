"""Print, per registered query, the shape of its physical plan.

Usage: python tools/plan_audit.py [sf_dir] [query ...]
Counts hash exchanges, broadcasts and reused exchanges, and flags plan
nodes that should not appear (cartesian products, nested-loop joins,
row-at-a-time Python UDFs).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cvelake.queries import QUERIES  # noqa: E402
from cvelake.session import get_session  # noqa: E402

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.001"
    names = [a for a in args if not os.path.isdir(a)] or list(QUERIES)
    spark = get_session("local[4]")
    for name in names:
        p = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        print(f"{name:24s} exchanges={len(re.findall(r'Exchange hashpartitioning', p)):3d} "
              f"broadcasts={p.count('BroadcastExchange'):2d} "
              f"window_prelimit={'Partial' in p and 'WindowGroupLimit' in p!s:5s} "
              f"flags={[b for b in BAD if b in p]}")


if __name__ == "__main__":
    main()
