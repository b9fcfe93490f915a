"""Skew evidence from Spark's event log: the write stage of a keyed write
whose partition key holds a third of the rows, with the store's REBALANCE
versus a plain hash repartition (the reference's R2).

    python tools/skew_probe.py [sf_dir]

The event log goes to a fresh scratch folder. AQE's advisory partition size
is scaled down (1 MB) so that at this data size a hot bucket is "large", as
it would be at scale with the 64 MB default. The input is first written as
16 files, as a large table would be. Prints one JSON line: per
variant, the write stage's task count and the max and median shuffle rows
and run time per task.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from keyferry.operators.keys import dedupe  # noqa: E402
from keyferry.operators.layout import bucket_aligned, by_key  # noqa: E402
from keyferry.session import fresh_path  # noqa: E402

BUCKETS = 16


def write_stage_tasks(log_dir: str, job_group: str) -> list[dict]:
    """Task-end events of the last stage of the jobs tagged ``job_group``."""
    stage_of_group, tasks = {}, {}
    # Spark 4 writes a rolling log: a folder of event files per application.
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == job_group:
                        for sid in ev.get("Stage IDs", []):
                            stage_of_group[sid] = True
                elif kind == "SparkListenerTaskEnd":
                    tasks.setdefault(ev["Stage ID"], []).append(ev)
    stages = sorted(s for s in stage_of_group if s in tasks)
    return tasks[stages[-1]] if stages else []


def stage_tasks(log_dir: str, job_group: str) -> dict[int, list[dict]]:
    """All task-end events of the jobs tagged ``job_group``, by stage."""
    wanted, tasks = set(), {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    if (ev.get("Properties") or {}).get("spark.jobGroup.id") == job_group:
                        wanted.update(ev.get("Stage IDs", []))
                elif ev.get("Event") == "SparkListenerTaskEnd":
                    tasks.setdefault(ev["Stage ID"], []).append(ev)
    return {s: t for s, t in tasks.items() if s in wanted}


def summary(task_events: list[dict]) -> dict:
    rows = [t["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"] for t in task_events]
    ms = [t["Task Info"]["Finish Time"] - t["Task Info"]["Launch Time"] for t in task_events]
    return {
        "tasks": len(task_events),
        "max_rows": max(rows),
        "median_rows": int(statistics.median(rows)),
        "max_ms": max(ms),
        "median_ms": int(statistics.median(ms)),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="keyferry-eventlog-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    hot = (
        li.withColumn("l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("int"))
        .withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey")))
    )
    root = fresh_path(spark, "skew-probe")
    # Many input files, as any large table has: AQE splits a hot partition by
    # ranges of map tasks, so a single-file input could not be split at all.
    hot.repartition(16).write.parquet(f"{root}/input")
    hot = spark.read.parquet(f"{root}/input")
    variants = {
        "rebalance (store)": bucket_aligned(hot, BUCKETS, ["l_orderkey"]),
        "hash repartition (R2)": by_key(hot, BUCKETS, ["l_orderkey"]),
    }
    for i, (name, df) in enumerate(variants.items()):
        spark.sparkContext.setJobGroup(f"probe-{i}", name)
        (
            df.write.format("parquet").bucketBy(BUCKETS, "l_orderkey").sortBy("l_orderkey", "l_linenumber")
            .option("path", f"{root}/t{i}").saveAsTable(f"skew_probe_t{i}")
        )
    # Dedupe with a third of the rows copies of one full key: the partial
    # aggregate must combine them before the shuffle.
    dup = (
        li.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey")))
        .withColumn("l_linenumber", F.when(F.col("l_orderkey") == 7, F.lit(1)).otherwise(F.col("l_linenumber")))
    )
    spark.sparkContext.setJobGroup("probe-prep", "input")
    dup.repartition(16).write.parquet(f"{root}/dup")
    dup = spark.read.parquet(f"{root}/dup")
    spark.sparkContext.setJobGroup("probe-dedupe", "dedupe")
    dedupe(dup, ["l_orderkey", "l_linenumber"]).write.format("noop").mode("overwrite").save()
    spark.stop()  # flushes the event log

    out = {name: summary(write_stage_tasks(log_dir, f"probe-{i}")) for i, name in enumerate(variants)}
    stages = stage_tasks(log_dir, "probe-dedupe")
    first, last = stages[min(stages)], stages[max(stages)]
    out["dedupe, hot duplicate key"] = {
        "input_rows": sum(t["Task Metrics"]["Input Metrics"]["Records Read"] for t in first),
        "shuffle_rows_written": sum(
            t["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"] for t in first
        ),
        "after_shuffle": summary(last),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
