"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line. Each query is executed to
completion with the ``noop`` sink (full plan, no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cvelake.queries import QUERIES  # noqa: E402
from cvelake.session import get_session  # noqa: E402

HEADLINE = [
    "cve_core_latest",
    "cve_signals",
    "affected_products",
    "cve_documents",
    "vuln_enriched",
    "vendor_risk_agg",
    "kev_recent",
    "dq_metrics",
    "snapshot_diff",
    "classify_questions",
    "answer_filtered",
    "compare_cves",
    "vector_topk",
    "vector_topk_batch",
    "latest_event_per_user",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        f"local[{cpus}]",
        **{"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))},
    )
    names = [n for n in HEADLINE if n in QUERIES]
    # Warm-up (not timed): JVM JIT on the JSON/window/join paths and the
    # Python workers used by mapInPandas, so the timings are steady state.
    for w in ("cve_documents", "answer_filtered", "vector_topk_batch"):
        QUERIES[w](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
