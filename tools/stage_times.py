"""Longest stages of a Spark event log.

Usage: PANELSMITH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) BENCH_QUERIES=panel python bench.py
       python tools/stage_times.py <event log dir or file> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def _lines(path: str):
    """Lines of a plain or zstd-compressed event log file."""
    if path.endswith(".zstd") or path.endswith(".zst"):
        import io

        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = (
        sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if not f.startswith("."))
        if os.path.isdir(path)
        else [path]
    )
    stages = []
    for f in files:
        if os.path.getsize(f) == 0 or "appstatus" in os.path.basename(f):
            continue
        for line in _lines(f):
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                if "Submission Time" in info and "Completion Time" in info:
                    ms = info["Completion Time"] - info["Submission Time"]
                    stages.append((ms, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:90]))
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f} s summed stage time")
    for ms, sid, n, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms / 1000:7.2f}s  stage {sid:4d}  tasks {n:4d}  {name}")


if __name__ == "__main__":
    main()
