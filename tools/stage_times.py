"""Per-stage times of jobs with a given description, from a Spark event log folder.

usage: python tools/stage_times.py <event-log-dir> [job-description]
"""

from __future__ import annotations

import glob
import io
import json
import sys

import zstandard


def lines(path: str):
    if path.endswith(".zstd"):
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    root, desc = sys.argv[1], (sys.argv[2] if len(sys.argv) > 2 else None)
    jobs, stages = {}, []
    for f in sorted(glob.glob(f"{root}/**/events_*", recursive=True)):
        for line in lines(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                d = e.get("Properties", {}).get("spark.job.description")
                for s in e["Stage IDs"]:
                    jobs[s] = d
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if desc and jobs.get(si["Stage ID"]) != desc:
                    continue
                stages.append((si["Submission Time"], si["Stage ID"], si["Number of Tasks"],
                               (si.get("Completion Time", 0) - si["Submission Time"]) / 1000, si["Stage Name"][:60]))
    if not stages:
        print("no stages")
        return
    t0 = min(s[0] for s in stages)
    for s in sorted(stages):
        print(f"+{(s[0] - t0) / 1000:7.2f}s stage {s[1]:4d} tasks {s[2]:4d} {s[3]:7.2f}s  {s[4]}")


if __name__ == "__main__":
    main()
