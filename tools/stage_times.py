"""Summarise stage durations from a Spark event log (file or rolling directory).

usage: python tools/stage_times.py <event-log path> [top-N]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(f):
    if f.endswith(".zstd"):
        import io
        import zstandard
        with open(f, "rb") as fh:
            text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            yield from text
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def events(path):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        for line in _lines(f):
            yield json.loads(line)


def main():
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for e in events(path):
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            dur = (si.get("Completion Time") or 0) - (si.get("Submission Time") or 0)
            stages.append((dur, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:70]))
    for dur, sid, n, name in sorted(stages, reverse=True)[:top]:
        print(f"{dur:7d} ms  stage {sid:4d}  tasks {n:4d}  {name}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages)} ms total")


if __name__ == "__main__":
    main()
