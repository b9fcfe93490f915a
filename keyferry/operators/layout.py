"""Physical layout steps chosen by the partition plan."""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyferry.operators.keys import has_map
from keyferry.plans.partition_plan import PartitionPlan


def by_key(df: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """R2: hash repartition; every key lands in exactly one partition."""
    return df.repartition(n, *[F.col(f"`{k}`") for k in key])


def round_robin(df: DataFrame, n: int) -> DataFrame:
    """Even partitions when there is no key to hash."""
    return df.repartition(n)


def shrink(df: DataFrame, n: int) -> DataFrame:
    """Merge partitions without a shuffle."""
    return df.coalesce(n)


def bucket_aligned(df: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """Hash by key into exactly the ``n`` partitions of an ``n``-bucket table.

    A REBALANCE rather than a plain repartition: partition ``i`` holds bucket
    ``i``, so each write task produces one file per bucket it holds, and
    adaptive execution may split a partition that one hot key made too large
    (several files for that bucket) or merge small neighbours. A plain
    ``repartition`` would pin a hot key's rows to one task.
    """
    return df.hint("rebalance", n, *key)


def cluster_order(df: DataFrame, partition_key: Sequence[str], clustering: Sequence[str]) -> DataFrame:
    """Rows of a partition key stored in clustering-key order."""
    return df.sortWithinPartitions(*[F.col(f"`{c}`") for c in list(partition_key) + list(clustering)])


def apply_plan(df: DataFrame, plan: PartitionPlan, key: Sequence[str] = (), balanced: bool = False) -> DataFrame:
    """``balanced`` splits heavy keys, at the price of two more scans of the key columns."""
    if plan.action == "repartition":
        if plan.by_key and key:
            return by_key_balanced(df, plan.partitions, key) if balanced else by_key(df, plan.partitions, key)
        return round_robin(df, plan.partitions)
    if plan.action == "coalesce":
        return shrink(df, plan.partitions)
    return df


def keep(df: DataFrame, enabled: bool) -> DataFrame:
    """Persist around a write; pays only when two actions follow."""
    return df.persist(StorageLevel.MEMORY_AND_DISK) if enabled else df


def release(df: DataFrame, enabled: bool) -> None:
    if enabled:
        df.unpersist()


# A key above this share of a partition's fair size is split; lighter keys, hashed
# to partitions, then differ little from partition to partition.
HEAVY_SHARE = 32


@dataclass(frozen=True)
class HeavyKeys:
    """Keys too large for one partition and where their pieces go."""

    partitions: int
    rows: int
    homes: Mapping[int, tuple[int, ...]]  # hash of a key: partitions of its pieces


def _key_hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in key])


def heavy_keys(df: DataFrame, n: int, key: Sequence[str], share: int = HEAVY_SHARE) -> HeavyKeys:
    """The keys that hold more than 1/``share`` of the mean partition, and a home for each of their pieces.

    A frequent-items sketch over the key columns names the candidates (up to some
    15,000 partitions it tracks every key above that bound); one aggregate counts them and the light
    keys of every partition exactly. At most ``n * share`` candidates and ``n``
    partitions come to the driver, however large the data. Pieces fill the
    emptiest partitions first.
    """
    if n < 1:
        raise ValueError("partitions must be >= 1")
    hashes = df.select(_key_hash(key).alias("h"))
    tracked = min(1_000_000, 2 * n * share)  # what Spark's sketch can track at most
    items = hashes.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(h, {min(n * share, tracked)}, {tracked})").alias("top")).first()
    rows = items["rows"]
    if not rows:
        return HeavyKeys(n, 0, {})
    piece = max(1, rows // (n * share))
    # The sketch may count an item too high, by rows / tracked or so, but never misses a heavy one.
    named = [r["item"] for r in items["top"] if r["count"] > piece]
    bound = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in named], "h bigint"))  # at most n * share rows
    own = hashes.join(bound.withColumn("named", F.lit(True)), "h", "left")
    loads = own.groupBy(F.when(F.col("named"), F.col("h")).alias("heavy"),
                        F.when(F.col("named").isNull(), F.pmod("h", F.lit(n))).cast("int").alias("part")).count().collect()
    load = [0] * n
    for r in loads:
        if r["part"] is not None:
            load[r["part"]] += r["count"]
    heap = [(size, p) for p, size in enumerate(load)]
    heapq.heapify(heap)
    homes: dict[int, tuple[int, ...]] = {}
    for h, count in sorted(((r["heavy"], r["count"]) for r in loads if r["heavy"] is not None), key=lambda x: (-x[1], x[0])):
        pieces = min(n, -(-count // piece))
        places = []
        for _ in range(pieces):
            size, p = heapq.heappop(heap)
            places.append(p)
            heapq.heappush(heap, (size + count / pieces, p))
        homes[h] = tuple(places)
    return HeavyKeys(n, rows, homes)


def by_key_balanced(df: DataFrame, n: int, key: Sequence[str], heavy: HeavyKeys | None = None) -> DataFrame:
    """R2 for skewed keys: every light key in exactly one partition, heavy keys cut into pieces.

    The piece of a row of a heavy key depends on its values and on the task that
    reads it, so a task that runs again sends it to the same place, and equal
    rows from many tasks spread as well. The homes of heavy keys, at most
    ``n * HEAVY_SHARE`` rows, are broadcast.
    """
    heavy = heavy or heavy_keys(df, n, key)
    own = "__kf_hash", "__kf_homes", "__kf_part"
    hashed = df.withColumn(own[0], _key_hash(key))
    if heavy.homes:
        table = df.sparkSession.createDataFrame(list(heavy.homes.items()), f"{own[0]} bigint, {own[1]} array<int>")
        hashed = hashed.join(F.broadcast(table), own[0], "left")
        values = [F.col(f"`{f.name}`") for f in df.schema.fields if not has_map(f.dataType)]
        at = F.pmod(F.xxhash64(*values, F.spark_partition_id()), F.size(own[1])).cast("int")
        part = F.coalesce(F.get(own[1], at), F.pmod(own[0], F.lit(n)).cast("int"))
    else:
        part = F.pmod(own[0], F.lit(n)).cast("int")
    # The part is a column of its own, so that the task that reads a row chooses it.
    placed = hashed.withColumn(own[2], part)
    return placed.repartitionById(n, F.col(own[2])).drop(*[c for c in own if c in placed.columns])
