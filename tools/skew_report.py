"""Per-task shuffle-read distribution of the hot-key type-2 query vs a naive per-key window.

Usage: python tools/skew_report.py [sf_dir] [partitions]
Writes Spark's event log to a fresh scratch folder (mkdtemp) and prints, per shuffle
stage, the share of records read by the largest task. AQE partition coalescing is off so
the distribution is visible on small data.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    parts = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    ev_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    import lakeward.plans.registry as R
    from lakeward.session import build_session
    spark = build_session(master="local[8]", shuffle_partitions=parts, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": ev_dir,
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setJobGroup("segmented", "segmented")
    R.QUERIES["scd2_hot_key"](spark, sf).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("naive", "naive")
    ev = R._t(spark, sf, "events").select(
        F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("k"),
        "ts", "event_type")
    ev.withColumn("p", F.lag("event_type").over(Window.partitionBy("k").orderBy("ts"))) \
      .write.format("noop").mode("overwrite").save()
    spark.stop()

    import zstandard
    stage_group, tasks = {}, collections.defaultdict(list)
    for f in sorted(glob.glob(f"{ev_dir}/*/events_*")):
        raw = open(f, "rb").read()
        text = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
                if f.endswith(".zstd") else raw.decode())
        for line in io.StringIO(text):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for s in e["Stage IDs"]:
                    stage_group[s] = e.get("Properties", {}).get("spark.jobGroup.id")
            elif e["Event"] == "SparkListenerTaskEnd":
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics", {})
                if m.get("Total Records Read"):
                    tasks[e["Stage ID"]].append(m["Total Records Read"])
    for s, recs in sorted(tasks.items()):
        total = sum(recs)
        if total > 1000:
            print(f"{stage_group.get(s)} stage {s}: {len(recs)} tasks, {total} records, "
                  f"largest task {100 * max(recs) / total:.1f}%")


if __name__ == "__main__":
    main()
