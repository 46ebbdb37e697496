"""Per-query stage timings from Spark's event log (no UI needed).

Usage: python tools/stage_profile.py <scratch_dir> <sf_dir> query [query ...]
Runs each query to completion with the event log written under
``scratch_dir`` and prints, per query, its stages with task counts and
durations (slowest first).
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402

from cvelake.queries import QUERIES  # noqa: E402
from cvelake.session import get_session  # noqa: E402


def _events(path: str):
    for f in sorted(glob.glob(f"{path}/*/events*")):
        with open(f, "rb") as fh:
            raw = zstandard.ZstdDecompressor().stream_reader(fh) if f.endswith(".zstd") else fh
            for line in io.TextIOWrapper(raw, encoding="utf-8"):
                yield json.loads(line)


def main() -> None:
    scratch, sf_dir, *names = sys.argv[1:]
    log_dir = os.path.abspath(scratch)
    os.makedirs(log_dir, exist_ok=True)
    spark = get_session("local[8]", **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}"})
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - t0:.2f}s wall")
    spark.stop()
    group, stages = {}, {}
    for e in _events(log_dir):
        if e.get("Event") == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for s in e.get("Stage IDs", []):
                group[s] = g
        elif e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Number of Tasks"], (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000)
    by = collections.defaultdict(list)
    for sid, (tasks, secs) in stages.items():
        by[group.get(sid)].append((secs, sid, tasks))
    for g, lst in by.items():
        print(f"== {g}: {len(lst)} stages, {sum(x[0] for x in lst):.1f}s of stage time")
        for secs, sid, tasks in sorted(lst, reverse=True)[:8]:
            print(f"   stage {sid:4d}  tasks={tasks:4d}  {secs:6.2f}s")


if __name__ == "__main__":
    main()
