"""The size-driven partition plan.

Rules, in order:

1. repartitioning enabled and ``rows >= repartition_threshold``: repartition to
   ``target_partitions`` when it is set (0 and None mean automatic), else to
   ``max(1, rows // rows_per_partition)``; by the partition key when there is
   one, round-robin otherwise;
2. otherwise, when ``rows < repartition_threshold`` (also with repartitioning
   disabled) and the frame has more than ``small_max_partitions`` partitions:
   coalesce to ``max(1, min(small_max_partitions, rows // small_rows_per_partition))``;
3. otherwise leave the frame alone.

The same rules exist twice: as plain Python for one table (used by the jobs)
and as Spark column expressions, so a whole inventory of tables is planned in
one distributed query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from keyferry.spec import PlanSettings


@dataclass(frozen=True)
class PartitionPlan:
    action: str  # "repartition" | "coalesce" | "none"
    partitions: int
    by_key: bool = False


def plan_partitions(
    rows: int, current_partitions: int, settings: PlanSettings, has_key: bool = True
) -> PartitionPlan:
    s = settings
    if s.enable_repartition and rows >= s.repartition_threshold:
        n = s.target_partitions or max(1, rows // s.rows_per_partition)
        return PartitionPlan("repartition", n, by_key=has_key)
    if rows < s.repartition_threshold and current_partitions > s.small_max_partitions:
        n = max(1, min(s.small_max_partitions, rows // s.small_rows_per_partition))
        return PartitionPlan("coalesce", n)
    return PartitionPlan("none", current_partitions)


def plan_columns(rows: Column, current: Column, settings: PlanSettings) -> tuple[Column, Column]:
    """(action, partitions) as column expressions of a row count column."""
    s = settings
    big = rows >= F.lit(s.repartition_threshold)
    if s.enable_repartition:
        auto = F.greatest(F.lit(1).cast("bigint"), F.floor(rows / F.lit(s.rows_per_partition)).cast("bigint"))
        rep_n = F.lit(s.target_partitions).cast("bigint") if s.target_partitions else auto
        repartition = big
    else:
        rep_n = F.lit(None).cast("bigint")
        repartition = F.lit(False)
    small_n = F.greatest(
        F.lit(1).cast("bigint"),
        F.least(
            F.lit(s.small_max_partitions).cast("bigint"),
            F.floor(rows / F.lit(s.small_rows_per_partition)).cast("bigint"),
        ),
    )
    coalesce = (~big) & (current > F.lit(s.small_max_partitions))
    action = (
        F.when(repartition, F.lit("repartition"))
        .when(coalesce, F.lit("coalesce"))
        .otherwise(F.lit("none"))
    )
    n = F.when(repartition, rep_n).when(coalesce, small_n).otherwise(current.cast("bigint"))
    return action, n


def bucket_count(rows: int, settings: PlanSettings, requested: int | None = None, data_bytes: int | None = None) -> int:
    """Bucket count for a new keyed table: requested, else one per
    ``target_bucket_bytes`` of data when that is set and measured, else one
    per ``rows_per_partition`` rows. A count above ``max_buckets`` (what Spark
    accepts for a table) is refused, never lowered silently."""
    if requested:
        n = max(1, requested)
    elif settings.target_bucket_bytes and data_bytes is not None:
        n = -(-data_bytes // settings.target_bucket_bytes) if data_bytes > 0 else 1
    else:
        n = -(-rows // settings.rows_per_partition) if rows > 0 else 1
    if n > settings.max_buckets:
        raise ValueError(
            f"{n} buckets, but at most {settings.max_buckets} are allowed: raise rows_per_partition or set "
            "target_bucket_bytes, or raise max_buckets with spark.sql.sources.bucketing.maxBuckets"
        )
    return n
