"""U1/U2 upsert semantics, K2 save modes, K4-K6 layout, S3/U3 reads."""

from __future__ import annotations

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyferry.operators.keys import dedupe, duplicate_keys, null_key_counts, upsert
from keyferry.sinks.keyed import TableExistsError, TruncateNotConfirmedError
from keyferry.session import remove_path, unique_name
from tests.conftest import SF01
from tests.plans import plan_text

SCHEMA = "k int, c int, v string, w double"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedupe_keeps_greatest_by_order_then_rest(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", 1.0), (1, 1, "b", 0.5), (1, 1, "b", 0.2), (2, 1, "z", 0.0), (2, 2, None, 9.0), (2, 2, "y", 1.0)],
        SCHEMA,
    )
    assert _rows(dedupe(df, ["k", "c"])) == [(1, 1, "b", 0.5), (2, 1, "z", 0.0), (2, 2, "y", 1.0)]
    # With an explicit version column, it decides first.
    assert _rows(dedupe(df, ["k", "c"], order_by=["w"])) == [(1, 1, "a", 1.0), (2, 1, "z", 0.0), (2, 2, None, 9.0)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 2), st.sampled_from(["a", "b", "c"]),
                          st.integers(0, 3).map(float)), min_size=1, max_size=40))
def test_dedupe_is_order_independent_and_unique(spark, rows):
    shuffled = rows[:]
    random.Random(7).shuffle(shuffled)
    a = dedupe(spark.createDataFrame(rows, SCHEMA), ["k", "c"])
    b = dedupe(spark.createDataFrame(shuffled, SCHEMA).repartition(3), ["k", "c"])
    ra, rb = _rows(a), _rows(b)
    assert ra == rb
    keys = [(r[0], r[1]) for r in ra]
    assert len(keys) == len(set(keys)) == len({(r[0], r[1]) for r in rows})
    # Brute force: the winner is the max of (v, w) per key.
    best = {}
    for k, c, v, w in rows:
        best[(k, c)] = max(best.get((k, c), (v, w)), (v, w))
    assert ra == sorted((k, c, v, w) for (k, c), (v, w) in best.items())


def test_upsert_replaces_and_keeps(spark):
    old = spark.createDataFrame([(1, 1, "old", 1.0), (2, 1, "keep", 2.0)], SCHEMA)
    new = spark.createDataFrame([(1, 1, "new", 0.0), (3, 1, "add", 3.0), (3, 1, "add2", 3.0)], SCHEMA)
    assert _rows(upsert(old, new, ["k", "c"])) == [(1, 1, "new", 0.0), (2, 1, "keep", 2.0), (3, 1, "add2", 3.0)]


def test_dedupe_collapses_hot_key_map_side(spark):
    df = spark.read.parquet(f"{SF01}/lineitem.parquet")
    text = plan_text(dedupe(df, ["l_orderkey", "l_linenumber"]), "simple")
    # A partial aggregate runs before the shuffle: duplicates are combined
    # map-side. The simple plan lists children below their parent.
    assert "partial_max" in text
    assert text.index("partial_max") > text.index("Exchange hashpartitioning")


def test_null_and_duplicate_key_checks(spark):
    df = spark.createDataFrame([(1, None, "a", 1.0), (None, 2, "b", 1.0), (1, None, "c", 1.0)], SCHEMA)
    got = {(r["column"], r["null_cells"], r["rows"]) for r in null_key_counts(df, ["k", "c"], "t").collect()}
    assert got == {("k", 1, 3), ("c", 2, 3)}
    assert [tuple(r) for r in duplicate_keys(df, ["k", "c"]).collect()] == [(1, None, 2)]


def test_store_modes(spark, store):
    a = spark.createDataFrame([(1, 1, "a", 1.0), (2, 1, "b", 2.0)], SCHEMA)
    b = spark.createDataFrame([(2, 1, "B", 2.5), (3, 1, "c", 3.0)], SCHEMA)
    r = store.write(a, "t", ["k"], ["c"], buckets=2)
    assert r.rows_written == 2 and store.exists("t")
    store.write(b, "t", ["k"], ["c"])  # append = upsert
    assert _rows(store.read("t")) == [(1, 1, "a", 1.0), (2, 1, "B", 2.5), (3, 1, "c", 3.0)]
    assert store.write(a, "t", ["k"], ["c"], mode="ignore").skipped
    assert _rows(store.read("t")) == [(1, 1, "a", 1.0), (2, 1, "B", 2.5), (3, 1, "c", 3.0)]
    with pytest.raises(TableExistsError):
        store.write(a, "t", ["k"], ["c"], mode="error")
    with pytest.raises(TruncateNotConfirmedError):
        store.write(a, "t", ["k"], ["c"], mode="overwrite", confirm_truncate=False)
    store.write(b, "t", ["k"], ["c"], mode="overwrite")
    assert _rows(store.read("t")) == [(2, 1, "B", 2.5), (3, 1, "c", 3.0)]
    # The table keeps its bucket spec across versions.
    assert store.describe("t")["buckets"] == 2 and store.describe("t")["partition_key"] == ("k",)


def test_upsert_is_idempotent(spark, store):
    a = spark.createDataFrame([(1, 1, "a", 1.0), (1, 1, "b", 1.0), (2, 1, "x", 2.0)], SCHEMA)
    store.write(a, "t", ["k"], ["c"], buckets=3)
    once = _rows(store.read("t"))
    store.write(a, "t", ["k"], ["c"])
    assert _rows(store.read("t")) == once


def test_create_table_and_exists(spark, store):
    df = spark.createDataFrame([(1, 1, "a", 1.0)], SCHEMA)
    assert not store.exists("e")
    assert store.create_table("e", df, ["k"], ["c"], buckets=4)
    assert store.exists("e") and store.read("e").count() == 0
    assert not store.create_table("e", df, ["k"], ["c"])


def test_bucket_layout_prunes_and_avoids_shuffle(spark, store):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    store.write(orders, "o", ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=4, unique=True)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        point = plan_text(store.lookup("o", o_custkey=42))
        assert "SelectedBucketsCount: 1 out of 4" in point
        assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,42)]" in point
        grouped = plan_text(store.read("o").groupBy("o_custkey").count())
        assert "Exchange" not in grouped
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    want = sorted(tuple(r) for r in orders.filter("o_custkey = 42").collect())
    assert _rows(store.lookup("o", o_custkey=42)) == want


def test_write_keeps_each_key_in_one_bucket(spark, store):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    store.write(li, "l", ["l_orderkey"], ["l_linenumber"], buckets=5)
    per_key = (
        store.read("l").select("l_orderkey", F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c\d+", 1).alias("b"))
        .groupBy("l_orderkey").agg(F.count_distinct("b").alias("n"))
    )
    assert per_key.filter("n > 1").count() == 0


def test_store_upsert_matches_aggregate_form(spark, store):
    """The store's anti-join upsert equals the single-aggregate definition."""
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    b2 = orders.filter("o_orderstatus = 'O'").withColumn("o_orderpriority", F.lit("X")).unionByName(
        orders.filter("o_orderstatus = 'P'").withColumn("o_orderkey", -F.col("o_orderkey"))
    )
    key = ["o_custkey", "o_orderdate", "o_orderkey"]
    for i, limit in enumerate(("100m", "-1")):  # broadcast and shuffled anti join
        name = f"u{i}"
        store.write(orders, name, ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=4, unique=True)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            store.write(b2, name, ["o_custkey"], ["o_orderdate", "o_orderkey"])
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert _rows(store.read(name)) == _rows(upsert(orders, b2, key))


def test_anti_join_of_a_small_batch_does_not_shuffle_existing_rows(spark, store):
    from keyferry.operators.keys import surviving_rows

    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    store.write(orders, "o", ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=4, unique=True)
    incoming = orders.filter("o_orderstatus = 'P'")
    key = ["o_custkey", "o_orderdate", "o_orderkey"]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = plan_text(surviving_rows(store.read("o"), incoming, key), "simple")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan_text(surviving_rows(store.read("o"), incoming, key), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Small batch: only the incoming keys are exchanged (made distinct, then broadcast).
    assert "BroadcastHashJoin" in small and "LeftAnti" in small
    assert "Exchange" not in small[: small.index("BroadcastExchange")]
    # Large batch: a shuffled join, so the check above can tell the two apart.
    assert "hashpartitioning" in large and "BroadcastHashJoin" not in large


def test_hot_key_write_is_split(spark, store, workdir):
    """One partition key holding a third of the rows does not pin one task."""
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey")))
    # Several input files, as any large input has: AQE splits by map ranges.
    hot.withColumn("l_linenumber", F.monotonically_increasing_id()).repartition(8).write.parquet(workdir + "/hot")
    hot = spark.read.parquet(workdir + "/hot")
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.01"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        store.write(hot, "h", ["l_orderkey"], ["l_linenumber"], buckets=4, unique=True)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files = (
        store.read("h").filter("l_orderkey = 7").select(F.input_file_name().alias("f")).distinct().count()
    )
    assert files > 1  # the hot bucket was written by several tasks
    assert store.read("h").count() == li.count()


def test_range_read_on_clustering_key(spark, store):
    import datetime as dt

    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    store.write(orders, "o", ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=4, unique=True)
    lo, hi = dt.datetime(1994, 1, 1), dt.datetime(1996, 12, 31)
    got = store.lookup("o", ranges={"o_orderdate": (lo, hi)}, o_custkey=42)
    want = orders.filter((F.col("o_custkey") == 42) & F.col("o_orderdate").between(lo, hi))
    assert _rows(got) == _rows(want)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        text = plan_text(store.lookup("o", ranges={"o_orderdate": (lo, hi)}, o_custkey=42))
        assert "SelectedBucketsCount: 1 out of 4" in text and "GreaterThanOrEqual(o_orderdate" in text
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_versions_and_rollback(spark, store):
    a = spark.createDataFrame([(1, 1, "a", 1.0)], SCHEMA)
    b = spark.createDataFrame([(1, 1, "b", 1.0)], SCHEMA)
    first = store.write(a, "t", ["k"], ["c"], buckets=2).location
    store.write(b, "t", ["k"], ["c"])
    assert _rows(store.read("t")) == [(1, 1, "b", 1.0)]
    vs = store.versions("t")
    assert len(vs) == 2 and any(first.endswith(v.split(":", 1)[-1]) for v in vs)
    store.rollback("t", first)
    assert _rows(store.read("t")) == [(1, 1, "a", 1.0)]
    store.write(spark.createDataFrame([(2, 1, "c", 1.0)], SCHEMA), "t", ["k"], ["c"])
    assert len(store.versions("t")) == 3
    emptied = store.vacuum("t", keep=1)
    assert len(emptied) == 2 and len(store.versions("t")) == 1
    assert _rows(store.read("t")) == [(1, 1, "a", 1.0), (2, 1, "c", 1.0)]


def test_existing_table_schema_is_kept(spark, store):
    from keyferry.sinks.keyed import SchemaMismatchError

    store.write(spark.createDataFrame([(1, 1, "a", 1.0)], SCHEMA), "t", ["k"], ["c"], buckets=2)
    # Wider incoming types and another column order: cast to the table's schema.
    wide = spark.createDataFrame([(2.0, "b", 1, 2)], "w double, v string, c bigint, k bigint")
    store.write(wide, "t", ["k"], ["c"])
    assert store.read("t").schema.simpleString() == "struct<k:int,c:int,v:string,w:double>"
    assert _rows(store.read("t")) == [(1, 1, "a", 1.0), (2, 1, "b", 2.0)]
    with pytest.raises(SchemaMismatchError):
        store.write(spark.createDataFrame([(3, 1, "c")], "k int, c int, v string"), "t", ["k"], ["c"])


def test_files_are_in_clustering_order(spark, store):
    """Inside every bucket file rows follow (partition key, clustering keys)."""
    from pyspark.sql import Window

    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    store.write(li, "l", ["l_orderkey"], ["l_linenumber"], buckets=3)
    files = [r.f for r in store.read("l").select(F.input_file_name().alias("f")).distinct().collect()]
    assert len(files) >= 3
    for f in files:
        df = spark.read.parquet(f).coalesce(1).withColumn("pos", F.monotonically_increasing_id())
        prev = df.select(
            "l_orderkey", "l_linenumber",
            F.lag(F.struct("l_orderkey", "l_linenumber")).over(Window.orderBy("pos")).alias("p"),
        )
        bad = prev.filter(F.struct("l_orderkey", "l_linenumber") < F.col("p"))
        assert bad.count() == 0, f


def test_unbucketed_read_spreads_a_bucket(spark, store):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    store.write(orders, "o", ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=2, unique=True)
    plain = store.read("o", bucketed=False)
    assert _rows(plain) == _rows(store.read("o"))
    text = plan_text(plain.groupBy("o_custkey").count(), "simple")
    assert "Bucketed: true" not in text and "partial_count" in text and "Exchange hashpartitioning" in text


def test_upsert_keeps_files_per_bucket_bounded(spark, store):
    """Neither upsert path lets every task write into every bucket."""
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    from keyferry import checks

    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
            "spark.sql.autoBroadcastJoinThreshold": "100m", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for bound in ("100m", "-1"):  # broadcast and shuffled anti join
            name = "f" + bound.strip("-")
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
            store.write(orders, name, ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=4, unique=True)
            store.write(checks._second_batch(orders), name, ["o_custkey"], ["o_orderdate", "o_orderkey"])
            files = store.read(name).select(F.input_file_name().alias("f")).distinct().count()
            assert files <= 4 * 3, (bound, files)  # 16 tasks x 4 buckets if scattered
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_upserts_and_compaction_leave_one_file_per_bucket(spark, store):
    a = spark.createDataFrame([(k, 1, "a", 1.0) for k in range(40)], SCHEMA)
    store.write(a, "t", ["k"], ["c"], buckets=2)
    for i in range(3):
        store.write(spark.createDataFrame([(i, 1, f"v{i}", 2.0), (100 + i, 1, "n", 0.0)], SCHEMA), "t", ["k"], ["c"])
    before = _rows(store.read("t"))
    n_files = lambda: store.read("t").select(F.input_file_name()).distinct().count()
    assert n_files() == 2  # an upsert leaves one file per bucket itself
    store.compact("t")
    assert n_files() == 2 and _rows(store.read("t")) == before


def test_null_keys_refused_by_the_store(spark, store):
    good = spark.createDataFrame([(1, 1, "a", 1.0)], SCHEMA)
    bad = spark.createDataFrame([(None, 1, "x", 1.0), (2, 1, "b", 1.0)], SCHEMA)
    store.write(good, "t", ["k"], ["c"], buckets=2)
    with pytest.raises(Exception, match="NULL key cell"):
        store.write(bad, "t", ["k"], ["c"])
    with pytest.raises(Exception, match="NULL key cell"):
        store.write(bad, "fresh", ["k"], ["c"], unique=True)
    assert _rows(store.read("t")) == [(1, 1, "a", 1.0)]  # unchanged
    assert not store.exists("fresh")


def test_orders_of_one_customer_in_date_order(spark, store):
    """SURVEY 7.2's first slice: the migrated orders of customer 42, in date order."""
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    store.write(orders, "o", ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=4, unique=True)
    got = [tuple(r) for r in store.lookup("o", ordered=True, o_custkey=42).collect()]
    want = [tuple(r) for r in orders.filter("o_custkey = 42").orderBy("o_orderdate", "o_orderkey").collect()]
    assert got == want and len(got) > 1


def test_exact_types_round_trip_through_the_store(spark, store):
    import datetime as dt
    import decimal

    from pyspark.sql import types as T

    from keyferry.operators.conform import conform

    schema = T.StructType([
        T.StructField("k", T.LongType()), T.StructField("d", T.DecimalType(12, 3)),
        T.StructField("b", T.BinaryType()), T.StructField("day", T.DateType()),
        T.StructField("ntz", T.TimestampNTZType()), T.StructField("arr", T.ArrayType(T.FloatType())),
        T.StructField("m", T.MapType(T.StringType(), T.LongType())), T.StructField("sh", T.ShortType()),
    ])
    row = (1, decimal.Decimal("12.345"), b"\x00\x01", dt.date(2024, 2, 29), dt.datetime(2024, 1, 2, 3, 4, 5, 6),
           [1.5, 2.0], {"x": 1}, 7)
    df = conform(spark.createDataFrame([row], schema), "exact")
    store.write(df, "types", ["k"], buckets=2)
    got = store.read("types").first()
    assert got.d == decimal.Decimal("12.345") and bytes(got.b) == b"\x00\x01" and got.day == dt.date(2024, 2, 29)
    assert got.arr == [1.5, 2.0] and got.m == {"x": 1} and got.sh == 7
    assert dict(store.read("types").dtypes)["ntz"] == "timestamp"


def test_map_key_refused(spark, store):
    df = spark.createDataFrame([({"a": 1}, 1)], "m map<string,int>, v int")
    with pytest.raises(TypeError, match="cannot be keys"):
        store.write(df, "mk", ["m"])


def test_upsert_snapshot_of_non_file_sources(spark, store, monkeypatch):
    from keyferry.sinks import keyed

    a = spark.createDataFrame([(1, 1, "a", 1.0), (2, 1, "b", 1.0)], SCHEMA)
    taken, removed = [], []
    monkeypatch.setattr(keyed, "fresh_path", lambda s, tag, f=keyed.fresh_path: taken.append(1) or f(s, tag))
    monkeypatch.setattr(keyed, "remove_path", lambda s, p, f=keyed.remove_path: removed.append(p) or f(s, p))
    b = spark.createDataFrame([(2, 1, "B", 1.0), (3, 1, "c", 1.0)], SCHEMA)  # in memory: no input files
    store.write(a, "t", ["k"], ["c"], buckets=2)
    assert taken == []  # first write: the batch is read once, no snapshot
    store.write(b, "t", ["k"], ["c"])
    assert taken == [1]  # upsert of a non-file batch: snapshot taken automatically
    store.write(b, "t", ["k"], ["c"], snapshot=False)
    assert taken == [1]
    assert _rows(store.read("t")) == [(1, 1, "a", 1.0), (2, 1, "B", 1.0), (3, 1, "c", 1.0)]
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    store.write(orders, "o", ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=2, unique=True)
    store.write(orders.filter("o_orderstatus = 'P'"), "o", ["o_custkey"], ["o_orderdate", "o_orderkey"])
    assert taken == [1]  # a file scan is consistent within a job: no snapshot
    mixed = orders.limit(3).unionByName(spark.createDataFrame(orders.limit(1).collect(), orders.schema))
    store.write(mixed, "o", ["o_custkey"], ["o_orderdate", "o_orderkey"])
    assert taken == [1, 1]  # one leaf that is no file scan is enough
    for path in removed:
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(path)
    assert len(removed) == 2


def test_vacuum_spares_versions_newer_than_current(spark, store):
    a = spark.createDataFrame([(1, 1, "a", 1.0)], SCHEMA)
    first = store.write(a, "t", ["k"], ["c"], buckets=2).location
    second = store.write(a.withColumn("v", F.lit("b")), "t", ["k"], ["c"]).location
    store.rollback("t", first)  # now the newer version is not current
    assert store.vacuum("t", keep=1) == []  # nothing older than the current one
    assert any(v.endswith(second.split(":", 1)[-1]) for v in store.versions("t"))


def test_rollback_refuses_an_emptied_version(spark, store):
    a = spark.createDataFrame([(1, 1, "a", 1.0)], SCHEMA)
    first = store.write(a, "t", ["k"], ["c"], buckets=2).location
    time.sleep(0.01)
    store.write(a.withColumn("v", F.lit("b")), "t", ["k"], ["c"])
    store.vacuum("t", keep=1)
    with pytest.raises(ValueError, match="not a version"):
        store.rollback("t", first)
    assert store.read("t").count() == 1


def test_another_session_attaches_the_recorded_version(spark, store):
    """What a new process sees: a catalog without the table, and data beside its record."""
    from keyferry.sinks.keyed import KeyedStore, UnrecordedDataError

    rows = [(i, 1, "a", 1.0) for i in range(100)]
    store.write(spark.createDataFrame(rows, SCHEMA), "t", ["k"], ["c"], buckets=2)
    fresh = KeyedStore(spark, unique_name("t_new"), store.root)  # same folder, another catalog entry
    fresh.create_keyspace()
    fresh.write(spark.createDataFrame([(i, 1, "b", 2.0) for i in range(98, 103)], SCHEMA), "t", ["k"], ["c"])
    assert fresh.read("t").count() == 103 and fresh.describe("t")["buckets"] == 2
    # The first session's catalog still names the old version; its next write starts from the recorded one.
    store.write(spark.createDataFrame([(200, 1, "c", 3.0)], SCHEMA), "t", ["k"], ["c"])
    assert store.read("t").count() == 104
    remove_path(spark, f"{store.root}/t/state")
    blind = KeyedStore(spark, unique_name("t_blind"), store.root)
    blind.create_keyspace()
    with pytest.raises(UnrecordedDataError):
        blind.write(spark.createDataFrame([(1, 1, "x", 0.0)], SCHEMA), "t", ["k"], ["c"])


def test_vacuum_after_truncating_overwrite(spark, store):
    a = spark.createDataFrame([(1, 1, "a", 1.0)], SCHEMA)
    store.write(a, "t", ["k"], ["c"], buckets=2)
    store.write(a, "t", ["k"], ["c"])
    store.write(a.limit(0), "t", ["k"], ["c"], mode="overwrite")  # current version holds no files
    assert len(store.vacuum("t", keep=1)) == 2 and store.versions("t") == []
    assert store.read("t").count() == 0
