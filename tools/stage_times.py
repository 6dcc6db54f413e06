"""Summarise a Spark event log: wall time of each job and its slowest stages.

    python tools/stage_times.py <event-log file or folder> [top_n]

A folder is a rolling event log (``eventlog_v2_*``): its ``events_*``
files are read in order.
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(path: str):
    files = [path]
    if os.path.isdir(path):
        inner = glob.glob(os.path.join(path, "eventlog_v2_*")) or [path]
        files = sorted(glob.glob(os.path.join(inner[0], "events_*")),
                       key=lambda f: int(os.path.basename(f).split("_")[1]))
    for f in files:
        if f.endswith(".zstd"):
            import io
            import zstandard
            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f) as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    jobs, stages = {}, {}
    for line in _lines(path):
        if line.strip():
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                jobs[ev["Job ID"]] = {"start": ev["Submission Time"], "stages": ev.get("Stage IDs", [])}
            elif kind == "SparkListenerJobEnd":
                jobs.setdefault(ev["Job ID"], {})["end"] = ev["Completion Time"]
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                if "Submission Time" in info and "Completion Time" in info:
                    stages[info["Stage ID"]] = (info["Completion Time"] - info["Submission Time"],
                                                info.get("Stage Name", ""), info.get("Number of Tasks"))
    ranked = sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]
    total = sum(j["end"] - j["start"] for j in jobs.values() if "end" in j and "start" in j)
    print(f"jobs {len(jobs)}  stages {len(stages)}  job wall time {total / 1000:.1f}s")
    for sid, (ms, name, tasks) in ranked:
        print(f"stage {sid:5d} {ms / 1000:7.2f}s tasks {tasks:4} {name[:90]}")


if __name__ == "__main__":
    main()
