"""Time the feature chain with both window plans on a larger derived input.

Usage: python tools/scale_probe.py [sf_dir] [copies]
The input is the demand view of ``events`` repeated ``copies`` times, each
copy shifted by 30 days (data Spark derives from the given table: same 15
series, a longer span).  Prints wall times per plan and, from the Spark
event log written to a fresh scratch folder, the stage times of the runs.
A local probe (``local[8]``), not a cluster job.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import features as ft  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources import tables  # noqa: E402


def stage_times(log_dir: str) -> list[tuple]:
    import zstandard

    out = {}
    for f in glob.glob(os.path.join(log_dir, "*", "events_*")):
        raw = open(f, "rb").read()
        text = zstandard.ZstdDecompressor().stream_reader(raw).read().decode() if f.endswith(".zstd") else raw.decode()
        for line in text.splitlines():
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                out[si["Stage ID"]] = (si["Number of Tasks"], si.get("Completion Time", 0) - si.get("Submission Time", 0))
    return sorted(out.items())


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 50
    log_dir = tempfile.mkdtemp(prefix="tidemark-events-")
    spark = build_session("tidemark-scale", master="local[8]", shuffle_partitions=32,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.driver.memory": "8g"})
    dem = tables.demand_5min(spark, sf)
    ts = F.timestamp_add("DAY", F.col("k") * 30, F.col("timestamp"))
    big = (dem.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
           .withColumn("timestamp", ts).drop("k")
           .withColumns({"date": F.col("timestamp").cast("date"), "month": F.month("timestamp"),
                         "year": F.year("timestamp"), "day_of_week": F.weekday("timestamp")})
           .repartition(32))  # spread like a multi-file table (the source file is one row group)
    for plain in (True, False, True, False):
        t0 = time.perf_counter()
        ft.demand_features(big, plain=plain).write.format("noop").mode("overwrite").save()
        print(f"{'plain' if plain else 'chunked':8s} {time.perf_counter() - t0:7.2f} s")
    print("buckets", ft.rollup_15min(big).count())
    spark.stop()
    for sid, (tasks, ms) in stage_times(log_dir):
        print(f"stage {sid:3d} tasks {tasks:4d} {ms:7d} ms")


if __name__ == "__main__":
    main()
