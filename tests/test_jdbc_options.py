"""S1/S2 read logic without a database: the options handed to Spark's JDBC
source are captured instead of executed."""

from __future__ import annotations

import pytest

from keyferry.sources import jdbc


class _FakeReader:
    def __init__(self, log, result):
        self.log, self.result, self.opts = log, result, {}

    def option(self, k, v):
        self.opts[k] = v
        return self

    def load(self):
        self.log.append(dict(self.opts))
        return self.result(self.opts)


class _Row(dict):
    def __getitem__(self, k):
        return dict.__getitem__(self, k)


class _Bounds:
    def __init__(self, lo, hi):
        self.row = _Row(lo=lo, hi=hi)

    def first(self):
        return self.row


@pytest.fixture()
def captured(monkeypatch):
    log = []

    def fake_reader(spark, conn, extra=None):
        r = _FakeReader(log, lambda o: _Bounds(10, 99) if "query" in o else "frame")
        for k, v in {**conn.options(), **(extra or {})}.items():
            r.option(k, v)
        return r

    monkeypatch.setattr(jdbc, "_reader", fake_reader)
    return log


class _Spark:
    class sparkContext:  # noqa: N801
        defaultParallelism = 8


def test_plain_read_is_one_table_read(captured):
    conn = jdbc.JdbcConnection("jdbc:x://h", "u", "p")
    assert jdbc.read_table(_Spark, conn, "orders") == "frame"
    assert captured == [{"url": "jdbc:x://h", "user": "u", "password": "p", "dbtable": "dbo.orders"}]


def test_partitioned_read_discovers_bounds(captured):
    conn = jdbc.JdbcConnection("jdbc:x://h")
    jdbc.read_table(_Spark, conn, "sales.orders", partition_column="order_id", num_partitions=4)
    bounds, read = captured
    assert bounds["query"] == "SELECT MIN(order_id) AS lo, MAX(order_id) AS hi FROM sales.orders"
    assert read["partitionColumn"] == "order_id" and read["numPartitions"] == "4"
    assert (read["lowerBound"], read["upperBound"]) == ("10", "99")


def test_partitioned_read_with_given_bounds_runs_no_query(captured):
    conn = jdbc.JdbcConnection("jdbc:x://h")
    jdbc.read_table(_Spark, conn, "orders", partition_column="id", lower_bound=1, upper_bound=5)
    assert len(captured) == 1 and captured[0]["numPartitions"] == "8"  # default parallelism
    assert (captured[0]["lowerBound"], captured[0]["upperBound"]) == ("1", "5")


def test_predicate_partitions_go_to_spark_jdbc():
    seen = {}

    class _Read:
        def jdbc(self, url, table, predicates=None, properties=None):
            seen.update(url=url, table=table, predicates=predicates, properties=properties)
            return "frame"

    class _S:
        read = _Read()

    conn = jdbc.JdbcConnection("jdbc:x://h", "u", "p", "drv")
    preds = ["id < 100", "id >= 100 AND id < 5000", "id >= 5000"]
    assert jdbc.read_table(_S, conn, "orders", predicates=preds, fetchsize=1000) == "frame"
    assert seen == {"url": "jdbc:x://h", "table": "dbo.orders", "predicates": preds,
                    "properties": {"user": "u", "password": "p", "driver": "drv", "fetchsize": "1000"}}


def test_fractional_bounds_become_whole_numbers():
    import decimal

    o = jdbc.partition_options("id", decimal.Decimal("1.5000000000"), 99.2, 4)
    assert (o["lowerBound"], o["upperBound"]) == ("1", "100")
    assert jdbc.partition_options("d", "2024-01-01", "2024-12-31", 2)["lowerBound"] == "2024-01-01"


def test_source_keys_from_nested_section_and_qualified_names():
    from keyferry import config

    cfg = {"db": {"jdbc_url": "jdbc:x://h", "tables": [{"name": "sales.orders", "primary_key": "id"},
                                                       {"name": "items", "primary_key": ["a", "b"]}]}}
    assert config.source_keys(cfg) == {"sales.orders": ("id",), "dbo.items": ("a", "b")}


def test_write_table_hands_options_to_spark():
    import pytest as _pytest

    from keyferry.sinks.jdbc import write_table

    seen = {}

    class _Writer:
        def format(self, f):
            seen["format"] = f
            return self

        def mode(self, m):
            seen["mode"] = m
            return self

        def option(self, k, v):
            seen.setdefault("options", {})[k] = v
            return self

        def save(self):
            seen["saved"] = True

    class _Frame:
        write = _Writer()

    conn = jdbc.JdbcConnection("jdbc:x://h", "u", "p")
    write_table(_Frame(), conn, "orders", mode="append", num_partitions=8)
    assert seen["format"] == "jdbc" and seen["mode"] == "append" and seen["saved"]
    o = seen["options"]
    assert o["dbtable"] == "dbo.orders" and o["numPartitions"] == "8" and o["batchsize"] == "10000"
    with _pytest.raises(ValueError):
        write_table(_Frame(), conn, "orders", mode="upsert")
