"""Summarise a Spark event log: per SQL execution, its stages, tasks and time.

Usage: python tools/event_log_stages.py EVENT_LOG_PATH [--top N]

EVENT_LOG_PATH is a file or an ``eventlog_v2_*`` directory written with
``spark.eventLog.enabled`` (see ``BENCH_EVENT_LOG_DIR`` in bench.py).
"""

from __future__ import annotations

import json
import sys
from collections import defaultdict
from pathlib import Path


def events(path: Path):
    files = sorted(path.glob("events_*")) if path.is_dir() else [path]
    for f in files:
        if f.name.endswith(".zstd"):
            import zstandard

            with open(f, "rb") as fh, zstandard.ZstdDecompressor().stream_reader(
                fh, read_across_frames=True
            ) as reader:
                raw = reader.read()
        else:
            raw = f.read_bytes()
        for line in raw.decode("utf-8").splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    top = int(sys.argv[sys.argv.index("--top") + 1]) if "--top" in sys.argv else 20
    path = Path(args[0])
    exec_desc, exec_time, job_exec, stage_job = {}, {}, {}, {}
    per_exec = defaultdict(lambda: {"stages": 0, "tasks": 0, "stage_ms": 0})
    for e in events(path):
        kind = e.get("Event", "")
        if kind.endswith("SparkListenerSQLExecutionStart"):
            exec_desc[e["executionId"]] = e.get("description", "")[:60]
            exec_time[e["executionId"]] = -e["time"]
        elif kind.endswith("SparkListenerSQLExecutionEnd"):
            exec_time[e["executionId"]] = exec_time.get(e["executionId"], 0) + e["time"]
        elif kind == "SparkListenerJobStart":
            ex = (e.get("Properties") or {}).get("spark.sql.execution.id")
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = ex
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            ex = stage_job.get(info["Stage ID"])
            if ex is None:
                continue
            agg = per_exec[int(ex)]
            agg["stages"] += 1
            agg["tasks"] += info.get("Number of Tasks", 0)
            if "Completion Time" in info and "Submission Time" in info:
                agg["stage_ms"] += info["Completion Time"] - info["Submission Time"]
    rows = sorted(per_exec.items(), key=lambda kv: -exec_time.get(kv[0], 0))[:top]
    print(f"{'exec':>5} {'wall_ms':>8} {'stages':>6} {'tasks':>6} {'stage_ms':>8}  description")
    for ex, agg in rows:
        print(f"{ex:>5} {exec_time.get(ex, 0):>8} {agg['stages']:>6} {agg['tasks']:>6} {agg['stage_ms']:>8}  {exec_desc.get(ex, '')}")


if __name__ == "__main__":
    main()
