"""M1, F1, A1 and V1 in one scan of the source; dependency order; cancellation; refused values."""

from __future__ import annotations

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from keyferry.operators.keys import distinct_estimate, key_sketch
from keyferry.plans import migrate as mg
from keyferry.plans.migrate import NullKeyError, RepeatedKeyError, RunControl, migrate_all, migrate_table, report_frame
from keyferry.session import shared_dir
from keyferry.sinks.connector import ConnectorStore
from keyferry.spec import MappingError, PlanSettings, RunOptions, TableMapping
from tests.conftest import SF001, SF01


def counted(spark, rows, schema="k bigint, c bigint, v string"):
    """A source that is no file, and the number of its rows that Spark has asked for."""
    asked = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            asked.add(b.num_rows)
            yield b

    return spark.createDataFrame(rows, schema).coalesce(2).mapInArrow(count, schema), asked


ROWS = [(i % 50, i // 50, f"v{i}") for i in range(400)] + [(3, 3, "again")]


@pytest.mark.parametrize("options", [RunOptions(), RunOptions(reconcile=True)])
@pytest.mark.parametrize("buckets", [None, 3])
def test_a_source_is_evaluated_once(spark, store, options, buckets):
    df, asked = counted(spark, ROWS)
    m = TableMapping.of("s", "t", "k", "c", buckets=buckets)
    rep = migrate_table(spark, lambda _: df, m, store, options=options)
    assert asked.value == len(ROWS)
    assert (rep.status, rep.rows_read, rep.rows_written) == ("ok", 401, 400)
    assert not options.reconcile or (rep.missing_keys, rep.extra_keys, rep.changed_rows) == (0, 0, 0)
    again, asked = counted(spark, [(3, 3, "zzz"), (99, 0, "new")])
    rep = migrate_table(spark, lambda _: again, m, store, options=options)  # the table's own layout: no copy
    assert asked.value == 2 and (rep.rows_read, rep.rows_written) == (2, 401)
    assert not options.reconcile or (rep.missing_keys, rep.extra_keys, rep.changed_rows) == (0, 399, 0)
    assert store.lookup("t", k=3, c=3).first().v == "zzz"


def test_file_source_is_planned_from_its_footers(spark, store, monkeypatch):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    rows, size = mg._file_sizes(li)
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{SF01}/lineitem.parquet") for f in names] or [f"{SF01}/lineitem.parquet"]
    assert rows == li.count() and size == sum(os.path.getsize(f) for f in files)
    assert mg._file_sizes(li.select("l_orderkey")) == (rows, size)
    for other in (li.where("l_quantity > 5"), li.limit(3), li.join(li, "l_orderkey"), spark.range(3), li.distinct()):
        assert mg._file_sizes(other) is None
    monkeypatch.setattr(mg, "profile_keys", lambda *a, **b: pytest.fail("no profile scan"))
    rep = migrate_table(spark, lambda _: li, TableMapping.of("l", "l", "l_orderkey", "l_linenumber"), store, PlanSettings(rows_per_partition=20_000))
    assert rep.status == "ok" and rep.rows_read == rows and rep.buckets == 3


def test_event_log_shows_one_content_scan(spark, tmp_path):
    """In a session of its own, with Spark's event log: the source's columns are read by one query."""
    import subprocess
    import sys

    code = f"""
import sys; sys.path.insert(0, {os.getcwd()!r})
from pyspark.sql import SparkSession
s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
     .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{tmp_path}").config("spark.eventLog.compress", "false")
     .config("spark.eventLog.rolling.enabled", "false").getOrCreate())
from keyferry import KeyedStore, RunOptions, TableMapping, migrate_all
st = KeyedStore(s, "one_scan")
read = lambda n: s.read.parquet("{SF001}/lineitem.parquet")
r = migrate_all(s, read, [TableMapping.of("l", "l", "l_orderkey", "l_linenumber")], st, options=RunOptions(profile="exact", reconcile=True))
assert r[0].status == "ok", r
s.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    scans: dict[int, set] = {}

    def walk(execution: int, node: dict) -> None:
        if node["nodeName"].startswith("Scan parquet") and "lineitem.parquet" in str(node["metadata"].get("Location")):
            scans.setdefault(execution, set()).add(node["metadata"].get("ReadSchema", ""))
        for child in node["children"]:
            walk(execution, child)

    for name in os.listdir(tmp_path):
        for line in open(tmp_path / name):
            event = json.loads(line)
            if event["Event"].endswith(("SparkListenerSQLExecutionStart", "SparkListenerSQLAdaptiveExecutionUpdate")):
                walk(event["executionId"], event["sparkPlanInfo"])
    assert scans and sum(any(x not in ("", "struct<>") for x in read) for read in scans.values()) == 1


@pytest.mark.parametrize("buckets", [None, 2])
def test_null_and_repeated_keys_leave_no_table(spark, store, buckets):
    files = lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(store.root).select("path").count()
    store.write(spark.createDataFrame([(1, 1, "a")], "k bigint, c bigint, v string"), "t", ["k"], ["c"], buckets=2)
    before = files()
    for target in ("t", "fresh"):
        df, asked = counted(spark, [(1, 1, "x"), (None, 1, "y"), (None, None, "z"), (None, 1, "y")])
        with pytest.raises(NullKeyError, match="'k': 3, 'c': 1"):
            migrate_table(spark, lambda _: df, TableMapping.of("s", target, "k", "c", buckets=buckets), store)
        assert asked.value == 4
        df, _ = counted(spark, [(i % 100, 0, "x") for i in range(400)])
        with pytest.raises(RepeatedKeyError):
            migrate_table(spark, lambda _: df, TableMapping.of("s", target, "k", "c", source_key="k", buckets=buckets), store)
        df, _ = counted(spark, [])
        rep = migrate_table(spark, lambda _: df, TableMapping.of("s", target, "k", "c", buckets=buckets), store)
        assert (rep.status, rep.rows_read, rep.rows_written) == ("skipped_empty", 0, None)
    assert not store.exists("fresh") and [tuple(r) for r in store.read("t").collect()] == [(1, 1, "a")] and files() == before


def test_copies_of_a_source_are_removed(spark, store):
    df, _ = counted(spark, ROWS)
    migrate_table(spark, lambda _: df, TableMapping.of("s", "copied", "k", "c"), store)
    root = shared_dir(spark).removeprefix("file:")
    assert not [n for n in os.listdir(f"{root}/keyferry") if n.startswith("source-copied")]


def test_external_store_gets_nothing_before_the_checks(spark, workdir):
    st = ConnectorStore(spark, "parquet", "ks", tuning={"path": workdir + "/out"})
    df, asked = counted(spark, [(1, 1, "x"), (None, 1, "y")])
    with pytest.raises(NullKeyError):
        migrate_table(spark, lambda _: df, TableMapping.of("s", "t", "k", "c"), st)
    assert asked.value == 2 and not os.path.exists(workdir.removeprefix("file:") + "/out")


def test_mismatch_is_reported_when_the_table_differs(spark, store, monkeypatch):
    monkeypatch.setattr(mg, "digest", lambda df: (0, 0, 0, 0))  # as if other rows came back
    df, _ = counted(spark, ROWS)
    rep = migrate_table(spark, lambda _: df, TableMapping.of("s", "t", "k", "c"), store, options=RunOptions(reconcile=True))
    assert (rep.status, rep.missing_keys, rep.changed_rows) == ("ok", 0, 0)  # the key-wise comparison decides
    whole = store.read
    monkeypatch.setattr(store, "read", lambda t, bucketed=True: whole(t, bucketed).where("k <> 7") if store.exists(t) else whole(t, bucketed))
    rep = migrate_table(spark, lambda _: df, TableMapping.of("s", "t2", "k", "c"), store, options=RunOptions(reconcile=True))
    assert (rep.status, rep.missing_keys) == ("mismatch", 8)


def test_key_summary_without_a_scan(spark, store):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    m = TableMapping.of("orders", "o", "o_custkey", ["o_orderdate", "o_orderkey"], source_key="o_orderkey")
    migrate_all(spark, lambda _: orders, [m], store)
    got = store.key_summary("o")
    assert got["rows"] == orders.count() and abs(got["keys"] - got["rows"]) < 0.03 * got["rows"]
    store.write(orders.limit(5), "plain", ["o_custkey"])
    assert store.key_summary("plain") is None and store.key_summary("absent") is None
    halves = [orders.where(f"o_orderkey % 2 = {i}").agg(key_sketch(["o_orderkey"])).first()[0] for i in (0, 1)]
    assert abs(distinct_estimate(spark, *halves) - got["rows"]) < 0.03 * got["rows"]
    once = distinct_estimate(spark, halves[0])
    assert abs(distinct_estimate(spark, halves[0], halves[0]) - once) < 0.01 * once


# -- M2 ---------------------------------------------------------------------------
CHAIN = [("c", "b"), ("b", "a")]


def chain(spark, store, broken=(), relations=CHAIN, **more):
    began = []

    def read(name):
        began.append(name)
        if name in broken:
            raise RuntimeError(f"no {name}")
        return spark.createDataFrame([(1, name)], "k int, v string")

    reports = migrate_all(spark, read, [TableMapping.of(n, f"t_{n}", "k") for n in ("c", "b", "a", "d")], store, relations=relations, **more)
    return {r.source: r.status for r in reports}, began


@pytest.mark.parametrize("parallelism", [1, 3])
def test_children_wait_and_are_skipped(spark, store, parallelism):
    status, began = chain(spark, store, parallelism=parallelism)
    assert set(status.values()) == {"ok"} and began.index("a") < began.index("b") < began.index("c")
    status, began = chain(spark, store, broken=("a",), parallelism=parallelism)
    assert status == {"a": "failed", "b": "skipped_parent", "c": "skipped_parent", "d": "ok"} and "b" not in began
    status, _ = chain(spark, store, broken=("b",), parallelism=parallelism, relations=[("C", "B"), ("b", "A"), ("c", "elsewhere")])
    assert status == {"a": "ok", "b": "failed", "c": "skipped_parent", "d": "ok"}


def test_circles_are_refused(spark, store):
    with pytest.raises(MappingError, match="circle"):
        chain(spark, store, relations=[*CHAIN, ("a", "c")])
    assert chain(spark, store, relations=[("a", "a")])[0]["a"] == "ok"  # a table that refers to itself


def test_a_run_can_be_cancelled(spark, store):
    control, under_way = RunControl(spark), threading.Event()

    def read(name):
        if name == "slow":
            under_way.set()
            return spark.range(4, numPartitions=4).select(F.col("id").alias("k"), F.expr("java_method('java.lang.Thread', 'sleep', 60000L)").alias("v"))
        return spark.createDataFrame([(1, "x")], "k int, v string")

    def stop():
        under_way.wait(60)
        while not spark.sparkContext.statusTracker().getActiveStageIds():
            pass
        control.cancel()

    watcher = threading.Thread(target=stop)
    watcher.start()
    maps = [TableMapping.of(n, f"x_{n}", "k") for n in ("quick", "slow", "late")]
    reports = migrate_all(spark, read, maps, store, control=control)
    watcher.join()
    assert [r.status for r in reports] == ["ok", "cancelled", "cancelled"] and not store.exists("x_slow")
    assert spark.range(3).count() == 3  # other jobs go on


# -- P1 ---------------------------------------------------------------------------
def test_refused_values_are_set_aside(spark, store, workdir):
    store.write(spark.createDataFrame([(1, 5, "2024-01-01")], "k int, n int, d string").withColumn("d", F.col("d").cast("date")), "t", ["k"], buckets=2)
    batch = spark.createDataFrame([("2", "6", "2024-02-02"), ("3", "six", "2024-02-30"), ("4", None, "2024-03-03"), ("x", "7", "2024-04-04")], "k string, n string, d string")
    m = TableMapping.of("s", "t", "k")
    with pytest.raises(Exception):
        migrate_table(spark, lambda _: batch, m, store)
    rep = migrate_table(spark, lambda _: batch, m, store, options=RunOptions(rejects=workdir + "/rejects"))
    assert (rep.status, rep.rows_read, rep.rows_written, rep.values_refused) == ("ok", 2, 3, 3)
    aside = spark.read.parquet(workdir + "/rejects/t")
    assert sorted((r["column"], r["type"], r["value"]) for r in aside.collect()) == [("d", "date", "2024-02-30"), ("k", "int", "x"), ("n", "int", "six")]
    assert report_frame(spark, [rep]).first()["values_refused"] == 3
    good = migrate_table(spark, lambda _: batch.where("n = '6'"), m, store, options=RunOptions(rejects=workdir + "/none"))
    assert good.values_refused == 0 and not os.path.exists(workdir.removeprefix("file:") + "/none/t")
