"""S2 ranges, R2 with heavy keys, R1 from file sizes, records set aside, merge."""

from __future__ import annotations

import datetime
import decimal
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keyferry import checks
from keyferry.operators.conform import fitting, refused_values, try_types
from keyferry.operators.layout import HEAVY_SHARE, by_key_balanced, heavy_keys
from keyferry.sinks.connector import ConnectorStore, MergeStore, merge_into
from keyferry.sinks.csv import export_tables, load_folder, table_sink, write_csv
from keyferry.sources.csv_folder import folder_row_counts, good_records, read_checked, read_csv, rejects, scan_folder
from keyferry.sources.files import file_totals, plain_files, size_plans
from keyferry.sources.ranges import hash_predicates, quantile_cuts, range_predicates, sql_literal
from tests.conftest import SF01
from tests.plans import plan_text


def held(df, predicates):
    """Per row of df, the numbers of the predicates that hold it."""
    marks = F.filter(F.array(*[F.when(F.coalesce(F.expr(p), F.lit(False)), F.lit(i)) for i, p in enumerate(predicates)]), lambda x: x.isNotNull())
    return [r[0] for r in df.select(marks).collect()]


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(20,4)", "date", "timestamp", "timestamp_ntz"])
def test_ranges_hold_every_row_once(spark, kind):
    days = kind in ("date", "timestamp", "timestamp_ntz")
    value = F.expr("date '2020-02-28' + cast(id * id % 1009 as int)") if days else F.expr("id * id % 1009 - 300.25")
    df = spark.range(2_000).select(F.when(F.col("id") % 40 != 0, value).cast(kind).alias("k"))
    predicates = range_predicates("k", quantile_cuts(df, "k", 8))
    places = held(df, predicates)
    sizes = Counter(p[0] for p in places)
    assert all(len(p) == 1 for p in places) and len(predicates) == 8
    assert max(sizes.values()) <= 300 and min(sizes.values()) >= 200


def test_ranges_of_odd_columns(spark):
    one = spark.createDataFrame([(7,)] * 50 + [(None,)] * 3, "k int")
    assert quantile_cuts(one, "k", 4) == [] and range_predicates("k", []) == ["1 = 1"]
    hot = spark.createDataFrame([(7,)] * 900 + [(i,) for i in range(100)], "k int")
    p = range_predicates("k", quantile_cuts(hot, "k", 10))
    assert 1 < len(p) < 10 and all(len(x) == 1 for x in held(hot, p))
    none = spark.createDataFrame([], "k int")
    assert quantile_cuts(none, "k", 4) == []
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (0.0,), (-0.0,), (None,)] + [(float(i),) for i in range(50)], "k double")
    assert all(len(x) == 1 for x in held(odd, range_predicates("k", quantile_cuts(odd, "k", 5))))
    with pytest.raises(ValueError, match="hash"):
        quantile_cuts(spark.createDataFrame([("a",)], "k string"), "k", 3)
    with pytest.raises(ValueError):
        quantile_cuts(one, "k", 0)


def test_hash_ranges(spark):
    df = spark.createDataFrame([(f"key {i}",) for i in range(800)] + [(None,)] * 5 + [("",)], "k string")
    places = held(df, hash_predicates("k", 4))
    assert all(len(p) == 1 for p in places) and max(Counter(p[0] for p in places).values()) < 260
    assert hash_predicates("k", 1) == ["1 = 1"]
    assert hash_predicates("k", 2, "ABS(CHECKSUM({column})) % {n}")[1] == "(k IS NOT NULL AND ABS(CHECKSUM(k)) % 2 = 1)"


def test_literals():
    assert sql_literal(datetime.date(2024, 2, 29)) == "DATE '2024-02-29'"
    assert sql_literal(datetime.datetime(2024, 2, 29, 1, 2, 3, 4)) == "TIMESTAMP '2024-02-29 01:02:03.000004'"
    assert (sql_literal(5), sql_literal(decimal.Decimal("1.50")), sql_literal(0.1)) == ("5", "1.50", "0.1E0")
    for bad in (True, "text", float("nan")):
        with pytest.raises(ValueError):
            sql_literal(bad)


def test_jdbc_read_by_quantiles(spark, monkeypatch):
    """The cuts are taken over the split column alone; no database here, so the read is a stand-in."""
    from keyferry.sources import jdbc

    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    monkeypatch.setattr(jdbc, "read_table", lambda *a, **b: orders)
    p = jdbc.quantile_split(spark, jdbc.JdbcConnection("jdbc:x:y"), "orders", "o_totalprice", 5)
    assert len(p) == 5 and sum(orders.where(x).count() for x in p) == orders.count()


# -- R2 ---------------------------------------------------------------------------
def skewed(spark, n=20_000):
    key = F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN concat('warm', id % 7) WHEN id % 997 = 2 THEN NULL ELSE concat('k', id % 5000) END")
    return spark.range(0, n, 1, 6).select(key.alias("k"), (F.col("id") % 2).alias("c"), "id")


@pytest.mark.parametrize("n", [1, 5, 32])
def test_heavy_keys_are_cut_and_light_keys_are_not(spark, n):
    df = skewed(spark)
    found = heavy_keys(df, n, ["k"])
    rows = by_key_balanced(df, n, ["k"], found).select("*", F.spark_partition_id().alias("p")).collect()
    assert len(rows) == df.count() and sorted(r.id for r in rows) == list(range(len(rows)))
    sizes, counts, parts = Counter(r.p for r in rows), Counter(r.k for r in rows), {}
    for r in rows:
        parts.setdefault(r.k, set()).add(r.p)
    assert max(sizes.values()) <= 2 * len(rows) / n
    limit = len(rows) // (n * HEAVY_SHARE)
    assert all(len(parts[k]) == 1 for k in counts if counts[k] <= limit) and len(parts["hot"]) == n
    assert len(found.homes) <= n * HEAVY_SHARE


def test_equal_rows_of_a_heavy_key_spread(spark):
    df = spark.range(0, 8_000, 1, 16).select(F.lit("same").alias("k"), F.lit(1).alias("v"))
    sizes = Counter(r[0] for r in by_key_balanced(df, 4, ["k"]).select(F.spark_partition_id()).collect())
    assert len(sizes) == 4 and max(sizes.values()) <= 4_000


def test_balance_of_nothing_and_of_even_keys(spark):
    empty = spark.createDataFrame([], "k int, v map<string,int>")
    assert by_key_balanced(empty, 4, ["k"]).count() == 0
    even = spark.range(4_000).select(F.col("id").alias("k"), F.create_map(F.lit("a"), "id").alias("m"))
    assert heavy_keys(even, 4, ["k"]).homes == {} and by_key_balanced(even, 4, ["k"]).columns == ["k", "m"]
    with pytest.raises(ValueError):
        heavy_keys(even, 0, ["k"])


# -- R1 ---------------------------------------------------------------------------
def test_sizes_come_from_metadata(spark, workdir):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    text = plan_text(file_totals(li))
    assert "ReadSchema: struct<>" in text and plain_files(li) and not plain_files(li.where("l_tax > 0"))
    li.limit(100).repartition(4).write.parquet(workdir + "/few")
    few = spark.read.parquet(workdir + "/few")
    r = file_totals(few).first()
    folder = workdir.removeprefix("file:") + "/few"
    assert (r.rows, r.files) == (100, 4) and r.bytes == sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.startswith("part-"))
    got = size_plans({"few": few}, 1_000).first()
    assert got.partitions == -(-r.bytes // 1_000) and size_plans({"few": few}, 1 << 40).first().partitions == 1
    spark.createDataFrame([], "a int").write.parquet(workdir + "/empty")
    assert file_totals(spark.read.schema("a int").parquet(workdir + "/empty")).first().rows == 0
    with pytest.raises(ValueError):
        size_plans({"few": few}, 0)


# -- S4, K7 -----------------------------------------------------------------------
TEXTS = [(1, 'say "hi", ok', " lead"), (2, "two\nlines", "trail "), (3, "back\\slash", ","), (4, None, '""'), (5, "plain", "x")]


def test_texts_survive_export_scan_load_and_count(spark, workdir):
    df = spark.createDataFrame(TEXTS, "id int, t string, u string")
    export_tables({"texts": df}, workdir)
    assert sorted(map(tuple, scan_folder(spark, workdir).tables["texts"].collect())) == sorted(TEXTS)
    assert scan_folder(spark, workdir).tables["texts"].schema["id"].dataType.simpleString() == "int"
    assert folder_row_counts(spark, workdir).first().rows == 5
    spark.sql("CREATE DATABASE IF NOT EXISTS dialect_db")
    res = load_folder(spark, workdir, table_sink("dialect_db", workdir + "-loaded"))
    assert res[0].rows == 5 and sorted(map(tuple, spark.table(res[0].target).collect())) == sorted(TEXTS)
    lines = read_csv(spark, workdir + "/texts", options={"multiLine": "false"})
    assert lines.count() == 6  # one record per line: as asked for


def test_texts_survive_the_feed(spark, workdir, store):
    from keyferry.spec import TableMapping
    from keyferry.streaming.folder_feed import feed_keyed_table

    df = spark.createDataFrame(TEXTS, "id int, t string, u string")
    write_csv(df, workdir + "/in/first")
    feed_keyed_table(spark, workdir + "/in/*", df.schema, store, TableMapping.of("in", "fed", "id"), checkpoint=workdir + "/cp").awaitTermination()
    assert sorted(map(tuple, store.read("fed").collect())) == sorted(TEXTS)


def test_records_that_do_not_fit(spark, workdir):
    folder = workdir.removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    with open(folder + "/t.csv", "w") as f:
        f.write('id,name,price\n1,a,1.5\n2,b\n3,"c\nd",x\n4,e,2.5,more\n,,\n5,"f ""q""",3.5\n')
    checked = read_checked(spark, workdir + "/t.csv", "id int, name string, price double")
    assert sorted(r.id or 0 for r in good_records(checked).collect()) == [0, 1, 5]
    bad = {r.record: (r.file.rsplit("/", 1)[1], r.parsed) for r in rejects(checked).collect()}
    assert set(bad) == {"2,b", '3,"c\nd",x', "4,e,2.5,more"} and bad["2,b"] == ("t.csv", '{"id":2,"name":"b"}')
    spark.sql("CREATE DATABASE IF NOT EXISTS aside_db")
    res = load_folder(spark, workdir, table_sink("aside_db", workdir + "-l"), schemas={"t": "id int, name string, price double"}, rejects_root=workdir + "-r")
    assert (res[0].rows, res[0].rejected) == (3, 3) and spark.read.parquet(res[0].rejects).count() == 3
    assert spark.table(res[0].target).columns == ["id", "name", "price"]
    inferred = load_folder(spark, workdir, table_sink("aside_db", workdir + "-l2"), rejects_root=workdir + "-r2")
    assert (inferred[0].rows, inferred[0].rejected) == (4, 2)  # the price column is text: only field counts can be wrong
    with pytest.raises(ValueError):
        load_folder(spark, workdir, table_sink("aside_db"), mode="ignore", rejects_root=workdir + "-r3")


def test_refused_values_at_any_type(spark):
    df = spark.createDataFrame([("1", 300, [1], None), ("x", 5, [2], "2024-01-01 00:00:00"), (None, None, None, "never")],
                               "a string, b int, c array<int>, d string")
    tried = try_types(df, {"a": "int", "b": "tinyint", "c": "array<int>", "d": "timestamp"})
    assert fitting(tried).count() == 0
    assert sorted((r["column"], r["type"], r["value"]) for r in refused_values(tried).collect()) == [
        ("a", "int", "x"), ("b", "tinyint", "300"), ("d", "timestamp", "never")]
    assert fitting(try_types(df, {})).count() == 3 and fitting(try_types(df, {"c": "array<int>"})).columns == df.columns
    with pytest.raises(ValueError):
        try_types(df, {"zz": "int"})


# -- K3, U2 -------------------------------------------------------------------------
def test_connector_options_reach_a_balanced_write(spark, workdir):
    from keyferry.plans.partition_plan import PartitionPlan

    st = ConnectorStore(spark, "parquet", "ks", tuning={"path": workdir + "/o"}, balance_heavy_keys=True)
    st.write(skewed(spark).where("k is not null"), "t", ["k"], ["id"], unique=True, plan=PartitionPlan("repartition", 4, by_key=True))
    back = spark.read.parquet(workdir + "/o").select("k", "id", F.col("_metadata.file_path").alias("f"))
    files = back.groupBy("k").agg(F.count_distinct("f").alias("n"))
    assert back.count() == skewed(spark).where("k is not null").count()
    assert files.where("k = 'hot'").first().n == 4 and files.where("k like 'k%' and n > 1").count() == 0


def lines_table(spark, path, orders=1_000):
    """Six lines an order; the first two of each get the heavy key."""
    cols = {c: F.lit(1.0) for c in checks.LINEITEM_COLS}
    cols |= {"l_orderkey": F.expr("id div 6"), "l_linenumber": F.expr("cast(id % 6 + 1 as int)"), "l_returnflag": F.lit("N")}
    spark.range(0, 6 * orders, 1, 4).select(*[c.alias(n) for n, c in cols.items()]).write.parquet(f"{path}/lineitem.parquet")


def test_partitions_grow_with_the_table(spark, workdir, monkeypatch):
    """No task of the write or of the comparison holds an eighth of a table of any size."""
    monkeypatch.setattr(checks, "BALANCED_ROWS", 200, raising=False)
    monkeypatch.setattr(checks, "fresh_path", lambda *_: workdir + "/sent")
    lines_table(spark, workdir)
    out = checks.connector_grouping(spark, workdir)
    assert [tuple(r) for r in out.collect()] == [(6_000, 0, 0)]
    sizes = spark.read.parquet(workdir + "/sent").groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(sizes) == 30 and max(r["count"] for r in sizes) <= 400
    asked = []
    monkeypatch.setattr(checks, "by_key_balanced", lambda df, n, key: asked.append(n) or by_key_balanced(df, n, key))
    assert checks.key_balance(spark, workdir).first().asDict() == {
        "rows": 6_000, "keys": 1_001, "light_keys_cut": 0, "heavy_key_cut": True, "even": True}
    assert asked == [30]


@pytest.mark.parametrize("chunk", [1, 7, 10_000])
def test_order_is_compared_across_chunks(spark, workdir, monkeypatch, chunk):
    """Rows sent in no order and keys sent to many files are all counted, at the bounds of chunks as well."""
    monkeypatch.setattr(checks, "ORDER_CHUNK", chunk)
    monkeypatch.setattr(checks, "fresh_path", lambda *_: workdir + "/sent")

    def send(self, df, *_, **__):
        df.repartition(3).write.parquet(workdir + "/sent")

    monkeypatch.setattr(ConnectorStore, "write", send)
    lines_table(spark, workdir, 200)
    got = checks.connector_grouping(spark, workdir).first()
    files, late = {}, 0
    for f in spark.read.parquet(workdir + "/sent").select(F.col("_metadata.file_path")).distinct().collect():
        sent = [tuple(r) for r in spark.read.parquet(f.file_path).coalesce(1).select("k", "l_orderkey", "line").collect()]
        late += sum(a > b for a, b in zip(sent, sent[1:]))
        for k, *_ in sent:
            files.setdefault(k, set()).add(f.file_path)
    cut = sum(len(x) > 1 for k, x in files.items() if k != -1)
    assert tuple(got) == (1_200, late, cut) and late > 100 and cut > 100


def test_nothing_is_sent_of_an_empty_table(spark, workdir):
    lines_table(spark, workdir, 0)
    assert tuple(checks.connector_grouping(spark, workdir).first()) == (0, 0, 0)


def test_merge_is_called_for_row_level_tables(spark, monkeypatch):
    """No format with row-level operations is at hand: the call is checked, the write is not."""
    calls = []

    class Writer:
        def __getattr__(self, name):
            return lambda *a: calls.append(name) or self

    def merge(self, table, condition):
        calls.append((table, sorted(map(tuple, self.collect()))))
        return Writer()

    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    monkeypatch.setattr(type(batch), "mergeInto", merge)
    merge_into(batch, "cat.ks.t", ["k"])
    assert calls == [("cat.ks.t", [(1, "b"), (2, "c")]), "whenMatched", "updateAll", "whenNotMatched", "insertAll", "merge"]
    calls.clear()
    st = MergeStore(spark, "parquet", "merge_ks")
    st.create_keyspace()
    assert st.write(batch, "t", ["k"]).created and calls == [] and st.read("t").count() == 2
    st.write(batch, "t", ["k"])
    assert calls[0][0] == "merge_ks.t" and calls[-1] == "merge"
    assert st.write(batch, "t", ["k"], mode="ignore").skipped
    spark.sql("DROP TABLE merge_ks.t")
