"""Print the physical plans of the main write and query shapes, compacted
(operator tree only), for PLANS.md.

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from keyferry import checks  # noqa: E402
from keyferry.operators.audit import _Sides, _RANGE  # noqa: E402
from keyferry.operators.joins import line_amount, orphans  # noqa: E402
from keyferry.operators.keys import dedupe, surviving_rows  # noqa: E402
from keyferry.operators.layout import bucket_aligned, by_key_balanced  # noqa: E402
from keyferry.session import fresh_path  # noqa: E402
from keyferry.sinks.csv import export_tables  # noqa: E402
from keyferry.sinks.keyed import KeyedStore  # noqa: E402
from keyferry.sources.csv_folder import folder_row_counts  # noqa: E402
from keyferry.sources.files import file_totals  # noqa: E402
from tools.session import local_session  # noqa: E402


def compact(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    out = []
    for line in buf.getvalue().splitlines():
        if not line.strip() or line.startswith("=="):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: ...", line)
        line = re.sub(r"FileScan parquet [^\[]*\[", "FileScan parquet [", line)
        out.append(line[:200])
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    t = lambda n: checks.table(spark, sf, n)
    li, orders, part = t("lineitem"), t("orders"), t("part")
    key = ["l_orderkey", "l_linenumber"]

    shapes = {}
    shapes["first keyed write: dedupe + bucket-aligned rebalance (U1, K2)"] = bucket_aligned(
        dedupe(li, key), 8, ["l_orderkey"]
    )
    st = KeyedStore(spark, "kf_plans", fresh_path(spark, "plans"))
    st.create_keyspace()
    st.write(orders, "o", ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=8, unique=True)
    incoming = checks._second_batch(orders)
    okey = ["o_custkey", "o_orderdate", "o_orderkey"]
    def upsert():
        return bucket_aligned(surviving_rows(st.read("o"), incoming, okey).unionByName(dedupe(incoming, okey)), 8, ["o_custkey"])

    no_bc = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    shapes["upsert into an existing table, Spark broadcasts the batch's keys (U2)"] = upsert()
    shapes["upsert into an existing table, large batch (U2): shuffled anti join on the unique key, one rebalance"] = (upsert, no_bc)
    shapes["heavy keys split, light keys whole (R2)"] = by_key_balanced(
        li.withColumn("k", F.expr(checks.SKEWED_KEY).cast("bigint")), 8, ["k"])
    shapes["sizes of a file table (R1): no column read"] = file_totals(li)
    prices = part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    shapes["price look-up (J1)"] = line_amount(
        li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), prices, "l_partkey", "l_quantity",
        "p_retailprice",
    )
    shapes["orphans (J2), Spark defaults"] = orphans(li, ["l_orderkey"], orders, ["o_orderkey"], "l->o")
    shapes["orphans (J2), no broadcast: pre-aggregate, then join"] = (
        lambda: orphans(li, ["l_orderkey"], orders, ["o_orderkey"], "l->o"), no_bc
    )
    st.write(li, "l", ["l_orderkey"], ["l_linenumber"], buckets=8)
    sides = _Sides(li, st.read("l"), key, (), unique=False)
    shapes["reconcile (A3): digests per key range, which is all that equal tables need"] = sides.digests(
        [F.pmod(sides.key_hash, F.lit(4096)).cast("int").alias(_RANGE)], [_RANGE])
    shapes["point read on the partition key (U3), Spark defaults: sorted row groups skipped by min/max"] = (
        st.lookup("o", o_custkey=42)
    )
    shapes["point read on the partition key (U3), bucketed scan on: one bucket read"] = (
        lambda: st.lookup("o", o_custkey=42),
        {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"},
    )
    folder = fresh_path(spark, "plans-csv")
    export_tables({n: t(n) for n in ("region", "nation", "supplier")}, folder)
    shapes["CSV folder counts (S4/A1), one scan"] = folder_row_counts(spark, folder)
    shapes["key profile (A1/V1), key columns only"] = __import__(
        "keyferry.operators.keys", fromlist=["profile_keys"]
    ).profile_keys(orders, okey)

    for title, shape in shapes.items():
        confs = {}
        if isinstance(shape, tuple):
            build, confs = shape
        for k, v in confs.items():
            spark.conf.set(k, v)
        try:
            df = build() if confs else shape
            text = compact(df)
        finally:
            for k in confs:
                spark.conf.unset(k)
        note = f"(with {', '.join(f'{k}={v}' for k, v in confs.items())})\n\n" if confs else ""
        print(f"### {title}\n\n{note}```\n{text}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
