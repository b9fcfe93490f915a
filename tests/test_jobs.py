"""M1/M2 jobs, A1/A3 audit, J1/J2 joins, G1-G4 generator, JDBC/connector options."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keyferry import checks
from keyferry.operators.audit import reconcile, row_counts
from keyferry.operators.joins import lookup_join, orphans
from keyferry.plans.migrate import NullKeyError, migrate_all, migrate_table, report_frame
from keyferry.sinks.connector import connector_options
from keyferry.sinks.jdbc import write_options
from keyferry.sources.jdbc import JdbcConnection, partition_options, qualified, split_table_name, url_from_template
from keyferry.spec import MappingError, PlanSettings, RunOptions, TableMapping
from keyferry.synth import generate as gen
from tests.conftest import SF001, SF01
from tests.plans import plan_text


def _reader(spark, sf=SF001):
    return lambda name: spark.read.parquet(f"{sf}/{name}.parquet")


def test_migrate_table_report(spark, store):
    m = TableMapping.of("lineitem", "li", "l_orderkey", "l_linenumber")
    rep = migrate_table(spark, _reader(spark), m, store, PlanSettings(), RunOptions(reconcile=True))
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    distinct = li.select("l_orderkey", "l_linenumber").distinct().count()
    assert rep.status == "ok" and rep.rows_read == li.count() and rep.rows_written == distinct
    assert rep.missing_keys == 0 and rep.changed_rows == 0
    assert rep.plan_action in ("none", "coalesce", "repartition") and rep.total_s > 0
    # Reference profile: the NTZ timestamp is stored as text.
    assert dict(store.read("li").dtypes)["l_shipdate"] == "string"


def test_migrate_refuses_null_keys(spark, store):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    with pytest.raises(NullKeyError):
        migrate_table(spark, lambda _: df, TableMapping.of("s", "t", "id"), store)
    assert not store.exists("t")


def test_migrate_all_isolates_failures(spark, store):
    mappings = [
        {"source_table": "nation", "target_table": "nation", "partition_key": "n_nationkey"},
        {"source_table": "missing", "target_table": "m", "partition_key": "id"},
        {"source_table": "region", "target_table": "region"},
        {"source_table": "region", "target_table": "region", "partition_key": "r_regionkey"},
    ]
    reports = migrate_all(spark, _reader(spark), mappings, store)
    assert [(r.source, r.status) for r in reports] == [
        ("nation", "ok"), ("missing", "failed"), ("region", "failed"), ("region", "ok"),
    ]
    assert reports[2].error_class == "MappingError"
    assert report_frame(spark, reports).count() == 4
    with pytest.raises(MappingError):
        migrate_all(spark, _reader(spark), [], store)


def test_empty_source_skipped(spark, store):
    empty = spark.createDataFrame([], "id int, v string")
    rep = migrate_table(spark, lambda _: empty, TableMapping.of("s", "t", "id"), store)
    assert rep.status == "skipped_empty" and rep.rows_read == 0 and not store.exists("t")


def test_reconcile_finds_differences(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "k int, v string")
    tgt = spark.createDataFrame([(1, "a"), (2, "x"), (4, "e")], "k int, v string")
    r = reconcile(src, tgt, ["k"]).first().asDict()
    assert r == {"source_rows": 4, "source_keys": 3, "target_rows": 3, "missing_keys": 1, "extra_keys": 1,
                 "changed_rows": 1}


def test_row_counts(spark):
    got = {r["table"]: r["rows"] for r in row_counts({t: spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("region", "nation")}).collect()}
    assert got == {"region": 5, "nation": 25}


def test_lookup_join_leaves_the_broadcast_to_spark(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_partkey", "l_quantity")
    part = spark.read.parquet(f"{SF01}/part.parquet").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "BroadcastHashJoin" in plan_text(lookup_join(li, part, "l_partkey"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
        assert "BroadcastHashJoin" not in plan_text(lookup_join(li, part, "l_partkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "pk int")
    r = orphans(child, ["fk"], parent, ["pk"], "c->p").first()
    assert (r.orphan_keys, r.orphan_rows) == (1, 3)
    big = plan_text(orphans(child, ["fk"], parent, ["pk"], "c->p"), "simple")
    # The child is aggregated before it meets the parent.
    assert big.index("LeftOuter") < big.rindex("partial_count")


def test_generator_consistency(spark):
    n_c, n_p = 50, 7
    customers = gen.customers(spark.range(1, n_c + 1).withColumnRenamed("id", "customer_id"))
    products = gen.products(spark.range(101, 101 + n_p).withColumnRenamed("id", "product_id"))
    orders = gen.orders(spark.range(1001, 1301).withColumnRenamed("id", "order_id"), n_c)
    lines = gen.order_lines(orders, products, n_p)
    assert orphans(orders, ["customer_id"], customers, ["customer_id"], "o->c").first().orphan_rows == 0
    assert orphans(lines, ["product_id"], products, ["product_id"], "l->p").first().orphan_rows == 0
    per_order = lines.groupBy("order_id").agg(F.count("*").alias("n"), F.count_distinct("product_id").alias("d"))
    assert per_order.filter("n != d OR n > 7 OR n < 1").count() == 0
    assert per_order.count() == 300
    assert lines.filter("quantity < 1 OR quantity > 5").count() == 0
    p = products.collect()
    assert p[0].product_name == gen.CATALOGUE[0][1] and p[0].sku.startswith(gen.CATALOGUE[0][1][:3].upper())
    c = customers.collect()
    assert all(r.email == f"{r.first_name.lower()}.{r.last_name.lower()}@" + r.email.split("@")[1] for r in c)
    assert str(c[0].created_date) == gen.CUSTOMER_START
    # Same ids, any partitioning: the same rows.
    again = gen.customers(spark.range(1, n_c + 1, numPartitions=5).withColumnRenamed("id", "customer_id"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, c))
    with pytest.raises(ValueError):
        gen.orders(spark.range(1), 0)


@pytest.mark.parametrize("last", [2_913_000, 8_999_999, gen.LAST_DAY - 19_754])
def test_generated_dates_go_on_past_9999(spark, workdir, last):
    """As many days as the SQL adds, read back from Parquet as well."""
    import duckdb

    spark.createDataFrame([(0,), (2_912_999,), (last,), (None,)], "o_orderkey bigint").write.parquet(workdir + "/orders.parquet")
    spark.range(3).select(F.col("id").alias("c_custkey")).write.parquet(workdir + "/customer.parquet")
    checks.gen_orders(spark, workdir).write.parquet(workdir + "/made")
    names = ["order_id", "customer_id", "status", "payment_method", "shipping_address", "notes"]
    made = spark.read.parquet(workdir + "/made").select(F.unix_date("order_date"), *names).collect()
    db, folder = duckdb.connect(), workdir.removeprefix("file:")
    for t in ("orders", "customer"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    wanted = db.execute(f"SELECT order_date - DATE '1970-01-01', {', '.join(names)} FROM ({checks.SQL_GEN_ORDERS})").fetchall()
    assert sorted(map(tuple, made), key=str) == sorted(wanted, key=str) and made != []


def test_a_day_beyond_any_date_is_an_error_unless_wrapped(spark):
    ids = spark.createDataFrame([(gen.LAST_DAY - 19_753 + gen.FIRST_ORDER_ID,)], "order_id bigint")
    with pytest.raises(Exception, match="give span_days"):
        gen.orders(ids, 3).select(F.unix_date("order_date")).collect()
    assert gen.orders(ids, 3, span_days=1).first().order_date.isoformat() == gen.ORDER_START


def test_jdbc_and_connector_options():
    url = url_from_template("jdbc:x://{host}:{port};databaseName={database};encrypt={encrypt}", host="h", port=1433,
                            database="d", encrypt=True)
    assert url == "jdbc:x://h:1433;databaseName=d;encrypt=true"
    conn = JdbcConnection(url, "u", "p", "drv")
    assert split_table_name("orders") == ("dbo", "orders")
    assert split_table_name("sales.orders") == ("sales", "orders")
    assert split_table_name("db.sales.orders") == ("db.sales", "orders")
    assert qualified("orders") == "dbo.orders"
    o = write_options(conn, "orders")
    assert o["batchsize"] == "10000" and o["isolationLevel"] == "READ_COMMITTED" and o["truncate"] == "true"
    assert o["dbtable"] == "dbo.orders" and o["user"] == "u" and o["driver"] == "drv"
    assert partition_options("id", 1, 100, 4) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "100",
                                                   "numPartitions": "4"}
    c = connector_options("ks", "t", {"output.batch.size.rows": 1000, "output.concurrent.writes": None})
    assert c == {"keyspace": "ks", "table": "t", "output.batch.size.rows": "1000"}


def test_migrate_through_connector_store(spark):
    """The job drives any store with the keyed write interface; Spark's
    built-in ``noop`` sink stands in for an external connector."""
    from keyferry.sinks.connector import ConnectorStore

    st = ConnectorStore(spark, "noop", "ks", tuning={"output.batch.size.rows": 1000})
    m = TableMapping.of("lineitem", "li", "l_orderkey", "l_linenumber")
    settings = PlanSettings(repartition_threshold=1000, rows_per_partition=2000)
    rep = migrate_table(spark, _reader(spark), m, st, settings, RunOptions())
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    assert rep.status == "ok" and rep.rows_written == li.select("l_orderkey", "l_linenumber").distinct().count()
    assert rep.plan_action == "repartition" and rep.plan_partitions == li.count() // 2000


def test_migrate_with_cache_persists_and_releases(spark, store, monkeypatch):
    from keyferry.plans import migrate as mg

    calls = []
    keep, release = mg.keep, mg.release
    monkeypatch.setattr(mg, "keep", lambda df, on: calls.append(("keep", on)) or keep(df, on))
    monkeypatch.setattr(mg, "release", lambda df, on: calls.append(("release", on)) or release(df, on))
    m = TableMapping.of("orders", "o", "o_custkey", ["o_orderdate", "o_orderkey"], source_key="o_orderkey")
    rep = migrate_table(spark, _reader(spark), m, store, PlanSettings(enable_cache=True))
    assert rep.status == "ok" and rep.rows_written == rep.rows_read
    assert calls == [("keep", True), ("release", True)]
    assert not spark.sparkContext._jsc.getPersistentRDDs()  # released after the write


def test_nested_types_fail_before_reading(spark, store):
    from keyferry.functions.typemap import UnsupportedTypeError

    reports = migrate_all(spark, _reader(spark), [{"source": "embeddings", "target": "v", "partition_key": "vec_id"}],
                          store)
    assert reports[0].status == "failed" and reports[0].error_class == "UnsupportedTypeError"
    assert reports[0].rows_read is None
    rep = migrate_table(spark, _reader(spark), TableMapping.of("embeddings", "v", "vec_id"), store,
                        options=RunOptions(profile="exact"))
    assert rep.status == "ok"
    assert dict(store.read("v").dtypes)["embedding"] == "array<double>"
    with pytest.raises(UnsupportedTypeError):
        migrate_table(spark, _reader(spark), TableMapping.of("embeddings", "v2", "vec_id"), store)


def test_migrate_all_in_parallel_keeps_order_and_results(spark, store):
    mappings = [
        {"source_table": t, "target_table": f"p_{t}", "partition_key": k}
        for t, k in [("nation", "n_nationkey"), ("region", "r_regionkey"), ("supplier", "s_suppkey"),
                     ("missing", "id"), ("part", "p_partkey")]
    ]
    seq = migrate_all(spark, _reader(spark), mappings, store)
    par = migrate_all(spark, _reader(spark), [dict(m, target_table=m["target_table"] + "_x") for m in mappings],
                      store, parallelism=3)
    assert [(r.source, r.status, r.rows_written) for r in seq] == [(r.source, r.status, r.rows_written) for r in par]
    assert [r.status for r in par] == ["ok", "ok", "ok", "failed", "ok"]


def test_reconcile_compares_values_across_types(spark):
    src = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    tgt = spark.createDataFrame([(1, 5), (2, 7)], "k bigint, v bigint")
    r = reconcile(src, tgt, ["k"]).first()
    assert (r.missing_keys, r.extra_keys, r.changed_rows) == (0, 0, 1)


def test_bucket_count_by_bytes(spark, store):
    from keyferry.operators.keys import profile_keys
    from keyferry.plans.partition_plan import bucket_count

    narrow = spark.range(2000).select(F.col("id").alias("k"))
    wide = narrow.select("k", F.repeat(F.lit("x"), 1000).alias("payload"))
    b_narrow = profile_keys(narrow, ["k"], with_bytes=True).first()["bytes"]
    b_wide = profile_keys(wide, ["k"], with_bytes=True).first()["bytes"]
    assert b_narrow == 2000 * 8 and b_wide == 2000 * (8 + 1000)
    s = PlanSettings(target_bucket_bytes=500_000)
    assert bucket_count(2000, s, data_bytes=b_narrow) == 1
    assert bucket_count(2000, s, data_bytes=b_wide) == 5  # same rows, wider rows: more buckets
    rep = migrate_table(spark, lambda _: wide, TableMapping.of("w", "w", "k"), store, s)
    assert rep.buckets == 5 and store.describe("w")["buckets"] == 5


def test_narrow_shuffle_warning(spark, caplog):
    import logging

    from keyferry.plans import migrate as mg

    m = TableMapping.of("s", "t", "k")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        with caplog.at_level(logging.WARNING, logger="keyferry.migrate"):
            mg._check_shuffle_width(spark, 100_000_000, m)
        assert "initialPartitionNum to at least 5" in caplog.text
        caplog.clear()
        with caplog.at_level(logging.WARNING, logger="keyferry.migrate"):
            mg._check_shuffle_width(spark, 1_000, m)
        assert caplog.text == ""
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_reconcile_status_by_mode(spark, store):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    m = TableMapping.of("lineitem", "rs", "l_orderkey", "l_linenumber")
    first = migrate_table(spark, lambda _: li, m, store, options=RunOptions(reconcile=True))
    assert first.status == "ok" and first.extra_keys == 0
    # Appending a part of the table into it: other keys are expected.
    part = li.filter("l_returnflag = 'R'")
    again = migrate_table(spark, lambda _: part, m, store, options=RunOptions(reconcile=True))
    assert again.status == "ok" and again.extra_keys > 0 and again.missing_keys == 0
    # Overwrite with the part: the old keys must be gone, so nothing extra.
    over = migrate_table(spark, lambda _: part, m, store, options=RunOptions(mode="overwrite", reconcile=True))
    assert over.status == "ok" and over.extra_keys == 0


def test_review_fixes(spark, workdir):
    from keyferry import config
    from keyferry.session import shared_dir
    from keyferry.sinks.csv import export_tables, load_folder, table_sink

    # Reconcile sees values moved between NULL positions.
    src = spark.createDataFrame([(1, None, 5)], "k int, a int, b int")
    tgt = spark.createDataFrame([(1, 5, None)], "k int, a int, b int")
    assert reconcile(src, tgt, ["k"]).first().changed_rows == 1
    # Empty inventory.
    assert row_counts({}).count() == 0
    # Quoted flags.
    _, _, opts = config.run_settings({"write_options": {"confirm.truncate": "false"}})
    assert opts.confirm_truncate is False
    # Ignore mode on existing tables: the sink skips, the load does not wait.
    export_tables({"region": spark.read.parquet(f"{SF001}/region.parquet")}, workdir + "/f")
    spark.sql("CREATE DATABASE IF NOT EXISTS fix_db")
    load_folder(spark, workdir + "/f", table_sink("fix_db", workdir + "/t"), mode="overwrite")
    again = load_folder(spark, workdir + "/f", table_sink("fix_db", workdir + "/t"), mode="ignore")
    assert [(r.table, r.rows, r.status) for r in again] == [("region", None, "ok")]

    # No shared folder on a cluster: refuse rather than use the driver's /tmp.
    class _Conf:
        def get(self, k, d=None):
            return {"spark.master": "yarn"}.get(k, d)

    class _NoContext:
        conf = _Conf()

        @property
        def sparkContext(self):  # noqa: N802
            raise RuntimeError("no context")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_NoContext())


def test_reconcile_with_map_columns(spark):
    src = spark.createDataFrame([(1, {"a": 1, "b": 2}), (2, {"x": 0})], "k int, m map<string,int>")
    same = spark.createDataFrame([(1, {"b": 2, "a": 1}), (2, {"x": 0})], "k int, m map<string,int>")
    other = spark.createDataFrame([(1, {"a": 1, "b": 3}), (2, {"x": 0})], "k int, m map<string,int>")
    assert reconcile(src, same, ["k"]).first().changed_rows == 0
    assert reconcile(src, other, ["k"]).first().changed_rows == 1


def test_nested_maps_are_canonical(spark):
    from keyferry.operators.keys import dedupe

    schema = "k int, m map<string,map<string,int>>, s struct<x:map<string,int>>, a array<map<string,int>>"
    src = spark.createDataFrame(
        [(1, {"o": {"b": 2, "a": 1}}, ({"q": 1, "p": 2},), [{"y": 1, "x": 2}]),
         (1, {"o": {"a": 0}}, ({"p": 0},), [{"x": 0}])], schema)
    one = dedupe(src, ["k"]).collect()
    assert len(one) == 1
    tgt = spark.createDataFrame([(1, {"o": {"a": 1, "b": 2}}, ({"p": 2, "q": 1},), [{"x": 2, "y": 1}])], schema)
    r = reconcile(src, tgt, ["k"]).first()
    assert (r.missing_keys, r.extra_keys) == (0, 0)
    # Equal contents in another entry order (see ``same``): no change reported.
    same = spark.createDataFrame([(1, {"o": {"b": 2, "a": 1}}, ({"q": 1, "p": 2},), [{"y": 1, "x": 2}])], schema)
    assert reconcile(same, tgt, ["k"]).first().changed_rows == 0


def test_reconcile_nested_nulls_and_name_case(spark):
    src = spark.createDataFrame([(1, [None, 1])], "k int, a array<int>")
    tgt = spark.createDataFrame([(1, [1, None])], "k int, a array<int>")
    assert reconcile(src, tgt, ["k"]).first().changed_rows == 1
    s2 = spark.createDataFrame([(1, 5)], "k int, Amount int")
    t2 = spark.createDataFrame([(1, 5)], "k int, amount bigint")
    assert reconcile(s2, t2, ["k"]).first().changed_rows == 0


def test_mode_case_does_not_cause_mismatch(spark, store):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    m = TableMapping.of("lineitem", "mc", "l_orderkey", "l_linenumber")
    migrate_table(spark, lambda _: li, m, store)
    part = li.filter("l_returnflag = 'R'")
    rep = migrate_table(spark, lambda _: part, m, store, options=RunOptions(mode="Append", reconcile=True))
    assert rep.status == "ok"


def test_readme_example_flow(spark, workdir):
    from keyferry import KeyedStore, PlanSettings, RunOptions, migrate_all, report_frame

    read = lambda name: spark.read.parquet(f"{SF001}/{name.split('.')[-1]}.parquet")
    store = KeyedStore(spark, keyspace="readme_sales", root=workdir + "/keyed")
    mappings = [{"source_table": "dbo.orders", "target_table": "orders", "partition_key": "o_custkey",
                 "clustering_keys": ["o_orderdate", "o_orderkey"], "source_key": "o_orderkey"}]
    report = migrate_all(spark, read, mappings, store, PlanSettings(), RunOptions(reconcile=True), parallelism=4)
    assert report_frame(spark, report).first().status == "ok"
    got = store.lookup("orders", ordered=True, o_custkey=42).collect()
    assert [r.o_orderdate for r in got] == sorted(r.o_orderdate for r in got)


def test_report_shows_buckets_used(spark, store):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    m = TableMapping.of("lineitem", "bk", "l_orderkey", "l_linenumber")
    first = migrate_table(spark, lambda _: li, m, store, PlanSettings(rows_per_partition=1000))
    again = migrate_table(spark, lambda _: li, m, store, PlanSettings(rows_per_partition=100))
    assert first.buckets == again.buckets == store.describe("bk")["buckets"]


def test_report_fields_for_connector_and_skipped(spark, store):
    from keyferry.sinks.connector import ConnectorStore

    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    m = TableMapping.of("lineitem", "rf", "l_orderkey", "l_linenumber")
    rep = migrate_table(spark, lambda _: li, m, ConnectorStore(spark, "noop", "ks"))
    assert rep.status == "ok" and rep.buckets is None
    migrate_table(spark, lambda _: li, m, store, PlanSettings(rows_per_partition=1000))
    skipped = migrate_table(spark, lambda _: li, m, store, PlanSettings(rows_per_partition=10),
                            RunOptions(mode="ignore"))
    assert skipped.status == "skipped_exists" and skipped.buckets == store.describe("rf")["buckets"]
