"""Summarise stage and task times from a Spark event log folder.

Run a job with TESSERA_EVENT_LOG_DIR=<scratch folder> (see tessera.session),
then: python scripts/stage_times.py <scratch folder> [top_n]
"""

import glob
import io
import json
import os
import sys


def events(folder):
    for fn in sorted(glob.glob(os.path.join(folder, "**", "events_*"), recursive=True) + glob.glob(os.path.join(folder, "local-*"))):
        raw = open(fn, "rb")
        if fn.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(raw)
        for line in io.TextIOWrapper(raw, encoding="utf-8"):
            yield json.loads(line)


def main():
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, tasks = {}, {}
    for e in events(folder):
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages[si["Stage ID"]] = (dur, si["Number of Tasks"], si["Stage Name"][:70])
        elif e.get("Event") == "SparkListenerTaskEnd":
            ti = e["Task Info"]
            tasks.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
    print(f"{len(stages)} stages, {sum(v[0] for v in stages.values()):.1f} s in total")
    for sid in sorted(stages, key=lambda k: -stages[k][0])[:top]:
        dur, n, name = stages[sid]
        t = sorted(tasks.get(sid, [0.0]))
        print(f"stage {sid:5d} {dur:8.2f}s tasks={n:5d} median={t[len(t) // 2]:.2f}s max={t[-1]:.2f}s  {name}")


if __name__ == "__main__":
    main()
