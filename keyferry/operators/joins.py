"""J1 look-up join and J2 referential integrity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join a large table with a look-up table.

    No hint and no extra job: Spark broadcasts a side whose size in bytes is
    under its own threshold, at planning or from the shuffled size at run time,
    and otherwise joins by shuffle, where adaptive execution splits a skewed key.
    """
    return fact.join(dim, on, how)


def line_amount(lines: DataFrame, prices: DataFrame, key: str, qty: str, price: str) -> DataFrame:
    """``amount = round(price * quantity, 2)`` after a price look-up."""
    j = lookup_join(lines, prices.select(key, price), key)
    return j.withColumn("amount", F.round(F.col(price) * F.col(qty), 2))


def orphans(child: DataFrame, fk: Sequence[str], parent: DataFrame, pk: Sequence[str], relation: str) -> DataFrame:
    """Child rows whose foreign key has no parent row.

    The child is first reduced to (key, rows) by a map-side-combined aggregate,
    so a key held by a third of the child costs one row per map task, and those
    distinct keys meet the parent on a key that is unique on both sides. (A left
    outer join with a NULL test, because Catalyst would move an anti join below
    the aggregate.)
    """
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk])
    keys_of_child = child.filter(not_null).select(*[F.col(c).alias(p) for c, p in zip(fk, pk)])
    grouped = keys_of_child.groupBy(*pk).agg(F.count(F.lit(1)).alias("_rows"))
    marked = parent.select(*pk).distinct().withColumn("_parent", F.lit(True))
    missing = grouped.join(marked, list(pk), "left").filter(F.col("_parent").isNull())
    return missing.agg(
        F.lit(relation).alias("relation"),
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("orphan_rows"),
    )
