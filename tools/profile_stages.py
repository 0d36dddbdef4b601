"""Per-stage wall and CPU time of one registered query, from Spark's event log.

Usage: python tools/profile_stages.py <query> [sf_dir]

The event log goes to a fresh scratch folder (the Spark UI stays off).  A
warm-up run on sf0.001 precedes the measured run; only stages submitted after
it are reported.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.plans.catalog import QUERIES  # noqa: E402
from shelfcast.session import build_session  # noqa: E402


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="shelfcast-evlog-")
    spark = build_session("local[8]", shuffle_partitions=16, extra_conf={
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir,
        "spark.eventLog.rolling.enabled": "false",
        "spark.eventLog.compress": "false",
    })
    QUERIES[name](spark, os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")) \
        .write.format("noop").mode("overwrite").save()
    start_ms = time.time() * 1000
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    print(f"{name}: {time.perf_counter() - t0:.1f}s")
    spark.stop()
    for path in glob.glob(os.path.join(log_dir, "*")):
        with open(path, encoding="utf-8") as fh:
            for line in fh:
                event = json.loads(line)
                if event["Event"] != "SparkListenerStageCompleted":
                    continue
                info = event["Stage Info"]
                if info.get("Submission Time", 0) < start_ms:
                    continue
                cpu = sum(a.get("Value", 0) for a in info.get("Accumulables", [])
                          if a.get("Name") == "internal.metrics.executorRunTime")
                wall = (info["Completion Time"] - info["Submission Time"]) / 1000
                print(f"stage {info['Stage ID']:5d} +{(info['Submission Time'] - start_ms) / 1000:6.1f}s "
                      f"wall={wall:6.2f}s tasks={info['Number of Tasks']:5d} run={cpu / 1000:7.2f}s "
                      f"{info['Stage Name'][:50]}")


if __name__ == "__main__":
    main()
