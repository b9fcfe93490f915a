"""A3 by digests: equal tables need no join, differences are found exactly."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyferry.operators import audit
from keyferry.operators.audit import digest, reconcile
from tests.conftest import SF01

SCHEMA = "k bigint, v string"


def plain(source, target):
    """The same numbers by dictionaries."""
    want = {}
    for k, v in source:
        want[k] = max(want.get(k, v), v)
    held: dict = {}
    for k, v in target:
        held.setdefault(k, []).append(v)
    changed = sum(max(held[k]) != want[k] for k in held if k in want)
    return (len(source), len(want), len(target), len(set(want) - set(held)), len(set(held) - set(want)),
            changed + sum(len(v) - 1 for v in held.values()))


@pytest.mark.parametrize("cut", [{}, {"ranges": 4, "rows_per_range": 8}, {"ranges": 1, "rows_per_range": 1}])
def test_differences_are_exact_at_every_level(spark, cut):
    rng = random.Random(3)
    source = [(i, f"v{i}") for i in range(600)] + [(i, f"w{i}") for i in range(0, 600, 7)]
    want = {}
    for k, v in source:
        want[k] = max(want.get(k, v), v)
    same = list(want.items())
    targets = [same, [(k, v) for k, v in same if k % 50], same + [(10_000, "new")], [(k, v + "!" if k % 100 == 1 else v) for k, v in same], []]
    for target in targets:
        rng.shuffle(target)
        got = tuple(reconcile(spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA), ["k"], **cut).first())
        assert got == plain(source, target)


def test_repeated_target_rows_count_even_when_both_sides_are_alike(spark):
    rows = [(1, "a"), (2, "b"), (2, "b"), (3, "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert tuple(reconcile(df, df, ["k"], unique=True).first()) == (4, 3, 4, 0, 0, 1)
    assert tuple(reconcile(df, df, ["k"]).first()) == (4, 3, 4, 0, 0, 1)


def test_equal_tables_are_not_joined(spark, store, monkeypatch):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    key = ["l_orderkey", "l_linenumber"]
    store.write(li, "li", key[:1], key[1:], buckets=4)
    joins = []
    whole = type(li).join
    monkeypatch.setattr(type(li), "join", lambda self, *a, **b: joins.append(a) or whole(self, *a, **b))
    r = reconcile(li, store.read("li"), key).first()
    assert (r.source_rows, r.missing_keys, r.extra_keys, r.changed_rows) == (li.count(), 0, 0, 0) and not joins
    less = store.read("li").where("l_orderkey <> 5")
    assert reconcile(li, less, key).first().missing_keys == li.where("l_orderkey = 5").select(*key).distinct().count() and joins


def test_only_differing_ranges_are_compared_by_key(spark, monkeypatch):
    source = spark.range(20_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    target = source.withColumn("v", F.when(F.col("k") == 77, F.lit("x")).otherwise(F.col("v")))
    seen = []
    compared = audit._Sides.compared

    def spy(self, within):
        seen.append(within(self.source).count())
        return compared(self, within)

    monkeypatch.setattr(audit._Sides, "compared", spy)
    assert reconcile(source, target, ["k"], unique=True, ranges=16, rows_per_range=32).first().changed_rows == 1
    assert len(seen) == 1 and seen[0] < 200


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.sampled_from(["a", "b", None])), min_size=1, max_size=40), st.integers(0, 1_000))
def test_digest_does_not_depend_on_order(spark, rows, seed):
    other = rows[:]
    random.Random(seed).shuffle(other)
    a = digest(spark.createDataFrame(rows, SCHEMA))
    assert a == digest(spark.createDataFrame(other, SCHEMA).repartition(3)) and a[0] == len(rows)
    changed = [(rows[0][0], "z"), *rows[1:]]
    assert digest(spark.createDataFrame(changed, SCHEMA)) != a


def test_digest_of_nothing(spark):
    assert digest(spark.createDataFrame([], SCHEMA)) == (0, 0, 0, 0)
    r = reconcile(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], SCHEMA), ["k"]).first()
    assert tuple(r) == (0, 0, 0, 0, 0, 0)
