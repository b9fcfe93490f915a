"""Run in its own process: a keyed write whose tasks fail on their first
attempt must still produce exactly the expected table and row count."""

from __future__ import annotations

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from keyferry.operators.keys import dedupe  # noqa: E402
from keyferry.session import fresh_path  # noqa: E402
from keyferry.sinks.keyed import KeyedStore  # noqa: E402


MARKS = tempfile.mkdtemp(prefix="retry-marks-")


@F.udf(T.BooleanType())
def lose_first_attempt(_):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        # Leave a mark so the test can see that the failure really happened.
        open(os.path.join(MARKS, f"s{ctx.stageId()}-p{ctx.partitionId()}"), "w").close()
        raise RuntimeError("simulated executor loss")
    return True


def main() -> None:
    spark = (
        SparkSession.builder.master("local[4,4]")  # up to 4 attempts per task
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    li = spark.read.parquet(sys.argv[1]).repartition(4)
    # Nondeterministic, so Catalyst keeps it above the repartition (4 tasks).
    flaky = li.filter(lose_first_attempt.asNondeterministic()(F.col("l_orderkey")))
    st = KeyedStore(spark, "retry_ks", fresh_path(spark, "retry"))
    st.create_keyspace()
    r = st.write(flaky, "li", ["l_orderkey"], ["l_linenumber"], buckets=4)
    got = st.read("li")
    want = dedupe(li, ["l_orderkey", "l_linenumber"])
    lost_before_write = len(os.listdir(MARKS))

    # Second case: tasks of the write stage itself fail (after the rebalance,
    # beside the observed count and the file writes) and are retried.
    from pyspark.sql import Observation

    from keyferry.operators.layout import bucket_aligned

    obs = Observation("retry_write_stage")
    staged = bucket_aligned(want, 4, ["l_orderkey"]).filter(
        lose_first_attempt.asNondeterministic()(F.col("l_orderkey"))
    )
    st._write_version(staged.observe(obs, F.count(F.lit(1)).alias("n")), "li2", ["l_orderkey"],
                      ["l_linenumber"], 4, replace=False)
    got2 = st.read("li2")
    print(json.dumps({
        "rows_written": r.rows_written,
        "table_rows": got.count(),
        "expected_rows": want.count(),
        "diff": got.exceptAll(want).count() + want.exceptAll(got).count(),
        "lost_tasks": lost_before_write,
        "write_stage_lost_tasks": len(os.listdir(MARKS)) - lost_before_write,
        "write_stage_observed": obs.get["n"],
        "write_stage_rows": got2.count(),
        "write_stage_diff": got2.exceptAll(want).count() + want.exceptAll(got2).count(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
