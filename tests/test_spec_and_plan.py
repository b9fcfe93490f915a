"""Mapping validation and the partition plan table (2.6.1)."""

from __future__ import annotations

import pytest

from keyferry.plans.partition_plan import PartitionPlan, bucket_count, plan_columns, plan_partitions
from keyferry.spec import MappingError, PlanSettings, TableMapping


@pytest.mark.parametrize(
    "rows,current,settings,expected",
    [
        (9_999, 12, PlanSettings(), PartitionPlan("coalesce", 1)),
        (99_999, 12, PlanSettings(), PartitionPlan("coalesce", 9)),
        (99_999, 10, PlanSettings(), PartitionPlan("none", 10)),
        (100_000, 1, PlanSettings(), PartitionPlan("repartition", 2, True)),
        (600_000, 1, PlanSettings(), PartitionPlan("repartition", 12, True)),
        (100_000, 1, PlanSettings(target_partitions=40), PartitionPlan("repartition", 40, True)),
        (100_000, 1, PlanSettings(target_partitions=0), PartitionPlan("repartition", 2, True)),
        (50_000, 12, PlanSettings(enable_repartition=False), PartitionPlan("coalesce", 5)),
        (100_000, 12, PlanSettings(enable_repartition=False), PartitionPlan("none", 12)),
    ],
)
def test_plan_table(rows, current, settings, expected):
    assert plan_partitions(rows, current, settings) == expected


def test_plan_without_key_is_round_robin():
    assert plan_partitions(200_000, 1, PlanSettings(), has_key=False) == PartitionPlan("repartition", 4, False)


def test_zero_rows_per_partition_refused():
    with pytest.raises(MappingError):
        PlanSettings(rows_per_partition=0)


def test_plan_columns_match_python(spark):
    cases = [(9_999, 12), (99_999, 12), (99_999, 10), (100_000, 1), (600_000, 1), (50_000, 12), (100_000, 12)]
    for settings in (PlanSettings(), PlanSettings(enable_repartition=False), PlanSettings(target_partitions=40)):
        df = spark.createDataFrame(cases, "rows bigint, cur bigint")
        from pyspark.sql import functions as F

        action, n = plan_columns(F.col("rows"), F.col("cur"), settings)
        got = {(r.rows, r.cur): (r.a, r.n) for r in df.select("rows", "cur", action.alias("a"), n.alias("n")).collect()}
        for rows, cur in cases:
            p = plan_partitions(rows, cur, settings)
            assert got[(rows, cur)] == (p.action, p.partitions), (settings, rows, cur)


def test_bucket_count_bounds():
    s = PlanSettings(rows_per_partition=1000, max_buckets=16)
    assert bucket_count(0, s) == 1
    assert bucket_count(1, s) == 1
    assert bucket_count(1001, s) == 2
    with pytest.raises(ValueError, match="at most 16"):
        bucket_count(10**9, s)
    assert bucket_count(10**9, s, requested=3) == 3


def test_mapping_string_and_list_keys_are_equal():
    a = TableMapping.from_dict({"source_table": "dbo.orders", "target_table": "orders", "partition_key": "customer_id",
                                "clustering_keys": "order_date"})
    b = TableMapping.from_dict({"source_table": "dbo.orders", "target_table": "orders", "partition_key": ["customer_id"],
                                "clustering_keys": ["order_date"]})
    assert a == b
    assert a.key == ("customer_id", "order_date")  # not split letter by letter


def test_mapping_without_partition_key_refused():
    with pytest.raises(MappingError):
        TableMapping.from_dict({"source_table": "x", "target_table": "y"})
    with pytest.raises(MappingError):
        TableMapping.of("x", "y", [])


def test_mapping_repeated_key_refused():
    with pytest.raises(MappingError):
        TableMapping.of("x", "y", "a", ["b", "a"])


def test_mapping_checks_columns():
    m = TableMapping.of("x", "y", "a", "b")
    m.validate(["a", "b", "c"])
    with pytest.raises(MappingError):
        m.validate(["a", "c"])


def test_composite_partition_key_allowed():
    m = TableMapping.of("x", "y", ["a", "b"], ["c"])
    assert m.partition_key == ("a", "b") and m.key == ("a", "b", "c")


def test_source_key_subset_skips_dedupe():
    assert TableMapping.of("x", "y", "cust", ["date", "id"], source_key="id").key_is_unique_by_source()
    assert not TableMapping.of("x", "y", "cust", ["date"], source_key="id").key_is_unique_by_source()
    assert not TableMapping.of("x", "y", "cust").key_is_unique_by_source()


def test_requested_buckets_are_honoured_or_refused():
    assert bucket_count(10**9, PlanSettings(), requested=50_000) == 50_000
    with pytest.raises(ValueError, match="100001 buckets"):
        bucket_count(10**9, PlanSettings(), requested=100_001)
