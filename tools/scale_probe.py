"""Time the keyed write on variants of lineitem that stress scale and skew.

    python tools/scale_probe.py [sf_dir]

* ``base``: lineitem as given;
* ``hot_partition_key``: a third of the rows moved to one partition key
  (clustering keys kept unique), the case a bucketed write must split;
* ``hot_full_key``: a third of the rows are copies of one full key, the case
  the dedupe must collapse map-side;
* ``x10``: ten copies of the table under shifted keys (10x rows, same shape).

Each variant is written to a fresh keyed table; prints one JSON line with
seconds, rows and rows/s per variant.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from keyferry.session import fresh_path, unique_name  # noqa: E402
from keyferry.sinks.keyed import KeyedStore  # noqa: E402
from tools.session import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    third = F.col("l_orderkey") % 3 == 0
    variants = {
        "base": li,
        "hot_partition_key": li.withColumn("l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("int"))
        .withColumn("l_orderkey", F.when(third, F.lit(7)).otherwise(F.col("l_orderkey"))),
        "hot_full_key": li.withColumn("l_orderkey", F.when(third, F.lit(7)).otherwise(F.col("l_orderkey")))
        .withColumn("l_linenumber", F.when(third, F.lit(1)).otherwise(F.col("l_linenumber"))),
        "x10": li.select(F.explode(F.sequence(F.lit(0), F.lit(9))).alias("copy"), "*")
        .withColumn("l_orderkey", F.col("l_orderkey") + F.col("copy").cast("bigint") * F.lit(10**9))
        .drop("copy"),
    }
    store = KeyedStore(spark, "kf_probe", fresh_path(spark, "scale-probe"))
    store.create_keyspace()
    # Warm-up (class loading, JIT) on a small slice of work.
    store.write(li.limit(1000), unique_name("warm"), ["l_orderkey"], ["l_linenumber"], buckets=4)
    out = {}
    for name, df in variants.items():
        rows = df.count()
        t0 = time.perf_counter()
        r = store.write(df, unique_name(name), ["l_orderkey"], ["l_linenumber"], buckets=16)
        dt = time.perf_counter() - t0
        out[name] = {"seconds": round(dt, 2), "rows": rows, "rows_written": r.rows_written,
                     "rows_per_sec": round(rows / dt)}
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
