"""Connected components of an edge table, without bringing edges to the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyferry.llm.common import stored


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one partition: (node, smallest node of its tree)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ru, rv = find(u), find(v)
            if ru != rv:
                parent[max(ru, rv)] = min(ru, rv)
    nodes = [x for x in parent if parent[x] != x]
    for i in range(0, len(nodes), 1 << 16):
        part = nodes[i:i + (1 << 16)]
        yield pa.record_batch([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], names=["u", "v"])


def components(edges: DataFrame, rows_per_task: int = 500_000) -> DataFrame:
    """`edges` has long columns u, v (no nulls). Returns u, v: each node that is not the
    smallest of its component, and that smallest node.

    Union-find inside partitions of about `rows_per_task` edges first, so that long
    chains shrink; then large-star and small-star rounds until the edges are stars.
    """
    edges = stored(edges.where("u <> v").select("u", "v").distinct(), "cc-edges")
    n = edges.count()
    if n == 0:
        return edges
    parts = -(-n // rows_per_task)
    dealt = edges.coalesce(1) if parts == 1 else edges.repartition(parts)  # any split gives a forest
    edges = stored(dealt.mapInArrow(_local_forest, "u bigint, v bigint"), "cc-forest")
    if parts == 1:  # one union-find has seen every edge
        return edges
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = stored(large, "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
                                                                F.struct(F.col("u"), F.col("low").alias("v")))).alias("e"))
        small = stored(small.select("e.*").where("u <> v").distinct(), "cc-small")
        same = small.count() == edges.count() and small.exceptAll(edges).isEmpty()
        edges = small
        if same:
            return edges
