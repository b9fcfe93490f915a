"""Property tests (hypothesis): plan forms agree, R2 keeps keys together,
the store's upsert equals the aggregate definition on random batches."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyferry.operators.keys import upsert
from keyferry.operators.layout import by_key
from keyferry.plans.partition_plan import plan_columns, plan_partitions
from keyferry.session import unique_name
from keyferry.spec import PlanSettings

plan_settings = st.builds(
    PlanSettings,
    enable_repartition=st.booleans(),
    repartition_threshold=st.integers(1, 10**6),
    target_partitions=st.one_of(st.none(), st.integers(0, 500)),
    rows_per_partition=st.integers(1, 10**5),
    small_max_partitions=st.integers(1, 50),
    small_rows_per_partition=st.integers(1, 10**5),
)


@settings(max_examples=10, deadline=None)
@given(plan_settings, st.lists(st.tuples(st.integers(0, 10**8), st.integers(1, 400)), min_size=1, max_size=20))
def test_plan_forms_agree(spark, s, cases):
    df = spark.createDataFrame(cases, "rows bigint, cur bigint")
    action, n = plan_columns(F.col("rows"), F.col("cur"), s)
    got = [(r.a, r.n) for r in df.select(action.alias("a"), n.alias("n")).collect()]
    want = [(p.action, p.partitions) for p in (plan_partitions(r, c, s) for r, c in cases)]
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 10**6)), min_size=1, max_size=200), st.integers(1, 9))
def test_by_key_keeps_each_key_in_one_partition(spark, rows, n):
    df = by_key(spark.createDataFrame(rows, "k int, v int"), n, ["k"])
    parts = df.select("k", F.spark_partition_id().alias("p")).groupBy("k").agg(F.count_distinct("p").alias("c"))
    assert parts.filter("c > 1").count() == 0
    assert df.count() == len(rows)


row = st.tuples(st.integers(0, 3), st.integers(0, 2), st.sampled_from(["a", "b", "c", None]))


# The store fixture is shared by the examples; each example uses its own table.
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25), st.lists(row, min_size=1, max_size=25))
def test_store_upsert_equals_definition(spark, store, a, b):
    schema = "k int, c int, v string"
    da, db = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    name = unique_name("p")
    store.write(da, name, ["k"], ["c"], buckets=2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if len(b) % 2 else "10m")  # both anti-join forms
    try:
        store.write(db, name, ["k"], ["c"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = sorted(map(tuple, store.read(name).collect()), key=repr)
    want = sorted(map(tuple, upsert(da, db, ["k", "c"]).collect()), key=repr)
    assert got == want


def _model(batches):
    """Keyed-store semantics in plain Python: per key, a later batch replaces
    the row; within a batch the greatest row wins (NULL sorts lowest)."""
    table = {}
    for rows in batches:
        best = {}
        for k, c, v, w in rows:
            cand = (v is not None, v or "", w is not None, w or 0.0)
            if (k, c) not in best or cand > best[(k, c)][0]:
                best[(k, c)] = (cand, (k, c, v, w))
        table.update({key: row for key, (_, row) in best.items()})
    return sorted(table.values(), key=repr)


batch_rows = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 2), st.one_of(st.none(), st.sampled_from(["a", "b"])),
              st.one_of(st.none(), st.integers(0, 2).map(float))),
    min_size=1, max_size=15,
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(batch_rows, min_size=1, max_size=3))
def test_migrations_match_the_keyed_store_model(spark, store, batches):
    from keyferry.plans.migrate import migrate_table
    from keyferry.spec import TableMapping

    name = unique_name("m")
    m = TableMapping.of("src", name, "k", "c")
    for rows in batches:
        df = spark.createDataFrame(rows, "k int, c int, v string, w double")
        rep = migrate_table(spark, lambda _, df=df: df, m, store)
        assert rep.status == "ok"
    got = sorted(map(tuple, store.read(name).collect()), key=repr)
    assert got == _model(batches)
