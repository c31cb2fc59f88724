"""Summarise a Spark event log (stage run time, tasks, shuffle records).

Usage: python scripts/eventlog_summary.py <event-log dir or file> [top_n]
"""

import collections
import glob
import io
import json
import os
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8", errors="ignore")
    else:
        with open(path, errors="ignore") as fh:
            yield from fh


def main(path, top=30):
    files = [path] if os.path.isfile(path) else sorted(glob.glob(os.path.join(path, "events_*")))
    names, run, tasks, shuffled = {}, collections.Counter(), collections.Counter(), collections.Counter()
    for f in files:
        for line in _lines(f):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            ev = e.get("Event")
            if ev == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                sid = e["Stage ID"]
                run[sid] += m.get("Executor Run Time", 0)
                tasks[sid] += 1
                shuffled[sid] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                names[si["Stage ID"]] = si["Stage Name"][:60]
    print(f"stages {len(names)}  executor run time {sum(run.values()) / 1000:.1f}s")
    for sid, ms in run.most_common(top):
        print(f"stage {sid:5d} {ms / 1000:7.2f}s tasks {tasks[sid]:4d} shuffle-out {shuffled[sid]:9d}  {names.get(sid, '')}")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 30)
