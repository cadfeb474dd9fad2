"""Summarise stage times and shuffle volumes from a Spark event log folder (written with
``spark.eventLog.enabled=true`` and ``spark.eventLog.dir=<folder>``, e.g. via ``BENCH_EVENT_LOG``).

Usage: python tools/stage_times.py <event-log folder>
Reads plain or zstd-compressed JSON event files; the Spark UI is not needed.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def events(path: str):
    with open(path, "rb") as fh:
        if path.endswith(".zstd"):
            import zstandard

            stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
        else:
            stream = io.TextIOWrapper(fh, encoding="utf-8")
        for line in stream:
            yield json.loads(line)


def main() -> None:
    root = sys.argv[1]
    files = sorted(p for p in glob.glob(os.path.join(root, "**", "*"), recursive=True)
                   if os.path.isfile(p) and "appstatus" not in os.path.basename(p))
    print("| stage | tasks | ms | input rows | shuffle rows written | shuffle KB written | shuffle rows read |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for path in files:
        for e in events(path):
            if e.get("Event") != "SparkListenerStageCompleted":
                continue
            info = e["Stage Info"]
            acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
            ms = info.get("Completion Time", 0) - info.get("Submission Time", 0)
            kb = round((acc.get("internal.metrics.shuffle.write.bytesWritten") or 0) / 1024)
            print(f"| {info['Stage ID']} | {info['Number of Tasks']} | {ms} "
                  f"| {acc.get('internal.metrics.input.recordsRead') or ''} "
                  f"| {acc.get('internal.metrics.shuffle.write.recordsWritten') or ''} | {kb or ''} "
                  f"| {acc.get('internal.metrics.shuffle.read.recordsRead') or ''} |")


if __name__ == "__main__":
    main()
