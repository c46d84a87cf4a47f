"""Rank stages of a Spark event log by duration (no UI needed).

Usage: python tools/stage_times.py <event-log-file> [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Event log lines from a file or a rolling-log folder (plain or zstd-compressed parts)."""
    files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_")) \
        if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                yield from text
        else:
            with open(f) as fh:
                yield from fh


def main() -> None:
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 25
    stages, job_desc, stage_job = {}, {}, {}
    tasks = defaultdict(int)
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                desc = (ev.get("Properties") or {}).get("spark.job.description") or ""
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
                job_desc[ev["Job ID"]] = desc[:60]
            elif kind == "SparkListenerTaskEnd":
                tasks[ev["Stage ID"]] += 1
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start and end:
                    stages[info["Stage ID"]] = (end - start, info.get("Stage Name", "")[:70])
    ranked = sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]
    total = sum(d for d, _ in stages.values())
    print(f"{len(stages)} stages, {total / 1000:.1f} s stage time in total")
    for sid, (ms, name) in ranked:
        print(f"stage {sid:5d} job {stage_job.get(sid, -1):5d} {ms:7d} ms {tasks[sid]:5d} tasks  {name}")


if __name__ == "__main__":
    main()
