"""Scale properties read from physical plans: what reaches the scan, where
exchanges are, what is broadcast."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from keyferry.operators.joins import line_amount, orphans
from keyferry.operators.keys import dedupe, profile_keys
from keyferry.operators.layout import bucket_aligned
from keyferry.sinks.csv import export_tables
from keyferry.sources.csv_folder import folder_row_counts
from tests.conftest import SF01
from tests.plans import plan_text


def _read_schemas(text: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*)", text)


def test_lookup_join_prunes_columns_at_both_scans(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    part = spark.read.parquet(f"{SF01}/part.parquet")
    prices = part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    lines = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    text = plan_text(line_amount(lines, prices, "l_partkey", "l_quantity", "p_retailprice"))
    schemas = _read_schemas(text)
    assert any(s.startswith("struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>")
               for s in schemas)
    assert any(s.startswith("struct<p_partkey:bigint,p_retailprice:double>") for s in schemas)
    assert "BroadcastHashJoin" in text


def test_profile_reads_key_columns_only(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    text = plan_text(profile_keys(orders, ["o_custkey", "o_orderkey"]))
    assert _read_schemas(text) == ["struct<o_orderkey:bigint,o_custkey:bigint>"]
    simple = plan_text(profile_keys(orders, ["o_custkey", "o_orderkey"]), "simple")
    assert "hashpartitioning" not in simple and "SinglePartition" in simple  # global aggregate only


def test_folder_counts_parse_no_column(spark, workdir):
    export_tables({"region": spark.read.parquet(f"{SF01}/region.parquet")}, workdir)
    text = plan_text(folder_row_counts(spark, workdir))
    assert "ReadSchema: struct<>" in text


def test_filters_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    text = plan_text(orphans(orders.filter("o_orderstatus = 'F'"), ["o_custkey"],
                             spark.read.parquet(f"{SF01}/customer.parquet"), ["c_custkey"], "o->c"))
    assert "EqualTo(o_orderstatus,F)" in text


def test_first_write_shuffles_twice_unique_write_once(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    key = ["l_orderkey", "l_linenumber"]
    deduped = plan_text(bucket_aligned(dedupe(li, key), 8, ["l_orderkey"]), "simple")
    unique = plan_text(bucket_aligned(li, 8, ["l_orderkey"]), "simple")
    assert deduped.count("Exchange hashpartitioning") == 2
    assert unique.count("Exchange hashpartitioning") == 1
    assert "REBALANCE_PARTITIONS_BY_COL" in unique
