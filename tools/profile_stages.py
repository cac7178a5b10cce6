"""Stage timings of registered queries from Spark's event log.

Usage: python tools/profile_stages.py sf_dir name [name ...]
The event log goes to a fresh scratch folder (mktemp style); the Spark UI
stays off. Prints wall time per query, job/stage totals and the slowest stages.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    from pyspark.sql import SparkSession
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
             .config("spark.eventLog.dir", scratch)
             .config("spark.sql.shuffle.partitions", cpus).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from martforge.plans.registry import QUERIES
    for n in names:
        t0 = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        print(f"{n}: {time.time() - t0:.2f}s")
    spark.stop()
    log = [f for f in glob.glob(scratch + "/**/*", recursive=True)
           if os.path.isfile(f) and "events" in os.path.basename(f)][0]
    stages, jobs = {}, 0
    for line in open(log):
        e = json.loads(line)
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Number of Tasks"], (si["Completion Time"] - si["Submission Time"]) / 1000)
        elif e["Event"] == "SparkListenerJobStart":
            jobs += 1
    print(f"jobs {jobs}, stages {len(stages)}, stage seconds {sum(d for _, d in stages.values()):.1f}")
    for sid, (tasks, dur) in sorted(stages.items(), key=lambda kv: -kv[1][1])[:10]:
        print(f"  stage {sid}: {tasks} tasks, {dur:.2f}s")
    print(f"event log: {log}")


if __name__ == "__main__":
    main()
