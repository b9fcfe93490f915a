"""Every registered query equals its DuckDB statement (sf0.001): column
names, column types, row count and an order-insensitive value hash."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as se
from keyferry import checks
from keyferry.checks import TABLES
from tests.conftest import SF001
from tools.compare import digest, spark_type_name


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(checks.QUERIES) == set(checks.ORACLE_SQL)
    assert set(checks.QUERIES) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    dtypes = {d[0]: str(d[1]) for d in res.description}
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert {f.name: spark_type_name(f.dataType) for f in df.schema.fields} == dtypes
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


def test_entry_smoke(spark):
    df = se.entry(spark)
    rows = {r["source"]: r["status"] for r in df.collect()}
    assert rows["customer"] == "ok" and rows["no_such_table"] == "failed"


@pytest.mark.parametrize("name", ["conform_reference", "conform_exact", "migrate_exact", "folder_feed_upsert"])
def test_timestamps_do_not_depend_on_session_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = se.queries()[name](spark, SF001)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(se.oracle_sql()[name])
    assert digest(df.columns, srows) == digest([d[0] for d in res.description], res.fetchall())
