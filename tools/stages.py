"""Run registered plans with Spark's event log written to a fresh scratch
folder and print where the time went: the slowest stages of the last run
(tasks, duration, start offset) and how many stages ran at once.

    python tools/stages.py [sf_dir] name [name ...]

The first run of each plan warms up; the second is the one reported.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(log_dir: str):
    import zstandard
    for path in sorted(glob.glob(f"{log_dir}/**/events_*", recursive=True)):
        raw = open(path, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if path.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            yield json.loads(line)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    log_dir = tempfile.mkdtemp(prefix="tessera-events-", dir="/tmp")
    from tessera.plans import load_all
    from tessera.session import build_session
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    plans = load_all()
    windows = {}
    for n in names:
        plans[n][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        t0 = time.time() * 1000
        plans[n][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        windows[n] = (t0, time.time() * 1000)
        print(f"{n}: {(windows[n][1] - t0) / 1000:.2f}s")
    spark.stop()
    stages = [e["Stage Info"] for e in _events(log_dir) if e["Event"] == "SparkListenerStageCompleted"]
    for n, (t0, t1) in windows.items():
        mine = [s for s in stages if t0 <= s["Submission Time"] <= t1]
        if not mine:
            continue
        first = min(s["Submission Time"] for s in mine)
        print(f"== {n}: {len(mine)} stages, first stage at +{(first - t0) / 1000:.2f}s (driver-side build/plan)")
        for s in sorted(mine, key=lambda s: s["Submission Time"] - s["Completion Time"])[:8]:
            print(f"  {(s['Completion Time'] - s['Submission Time']) / 1000:6.2f}s tasks={s['Number of Tasks']:4d} "
                  f"start=+{(s['Submission Time'] - t0) / 1000:6.2f}s")
        busy = collections.Counter()
        for s in mine:
            for sec in range(int((s["Submission Time"] - t0) // 1000), int((s["Completion Time"] - t0) // 1000) + 1):
                busy[sec] += 1
        print("  stages running per second:", [busy[i] for i in range(int((t1 - t0) // 1000) + 1)])


if __name__ == "__main__":
    main()
