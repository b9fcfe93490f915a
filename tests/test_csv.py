"""CSV folders and their edge cases (FIXTURES section 3)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

from keyferry.sinks.csv import FolderLoadError, export_tables, load_folder, table_sink, write_csv
from keyferry.sources.csv_folder import folder_row_counts, list_tables, read_csv, scan_folder
from tests.conftest import SF001


def _local(path: str) -> str:
    return path.split(":", 1)[1] if path.startswith("file:") else path


def _write(folder: str, name: str, text: str) -> None:
    os.makedirs(_local(folder), exist_ok=True)
    with open(os.path.join(_local(folder), name), "w") as f:
        f.write(text)


def test_folder_of_plain_files(spark, workdir):
    _write(workdir, "zips.csv", "id,zip_code,note\n1,02134,\"a, quoted\"\n2,90210,\n")
    _write(workdir, "header_only.csv", "a,b\n")
    _write(workdir, "empty.csv", "")
    _write(workdir, "readme.txt", "not a table")
    # A zero-byte file has no header, hence no columns: Spark's file scan does
    # not list it at all, so it is not a table of the folder.
    assert sorted(list_tables(spark, workdir)) == ["header_only", "zips"]
    scan = scan_folder(spark, workdir)
    assert sorted(scan.tables) == ["header_only", "zips"] and not scan.failures
    hdr = scan.tables["header_only"]
    assert hdr.count() == 0 and [f.dataType for f in hdr.schema.fields] == [T.StringType(), T.StringType()]
    z = scan.tables["zips"]
    rows = sorted(tuple(r) for r in z.collect())
    # Inference makes zip codes numbers and loses the leading zero; empty is NULL.
    assert rows == [(1, 2134, "a, quoted"), (2, 90210, None)]
    declared = read_csv(spark, list_tables(spark, workdir)["zips"], schema="id int, zip_code string, note string")
    assert sorted(tuple(r) for r in declared.collect()) == [(1, "02134", "a, quoted"), (2, "90210", None)]
    counts = {r["table"]: r["rows"] for r in folder_row_counts(spark, workdir).collect()}
    assert counts == {"header_only": 0, "zips": 2}


def test_empty_or_missing_folder(spark, workdir):
    assert list_tables(spark, workdir + "/nothing-here") == {}
    assert scan_folder(spark, workdir + "/nothing-here").tables == {}


def test_export_and_load_round_trip(spark, workdir):
    tables = {t: spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("region", "nation")}
    export_tables(tables, workdir)
    assert sorted(list_tables(spark, workdir)) == ["nation", "region"]
    db = "t_load_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    results = load_folder(spark, workdir, table_sink(db, workdir + "-loaded"), mode="overwrite")
    assert {(r.table, r.rows, r.status) for r in results} == {("nation", 25, "ok"), ("region", 5, "ok")}
    assert spark.table(f"{db}.nation").count() == 25


def test_first_failing_write_stops_load(spark, workdir):
    tables = {t: spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("nation", "region")}
    export_tables(tables, workdir)
    seen = []

    def sink(name, df, mode):
        if name == "nation":
            raise RuntimeError("target down")
        seen.append(name)

    with pytest.raises(FolderLoadError) as e:
        load_folder(spark, workdir, sink)
    assert e.value.failed.table == "nation" and seen == []


def test_write_csv_column_order(spark, workdir):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    write_csv(df, workdir + "/t", columns=["y", "x"])
    assert read_csv(spark, workdir + "/t").columns == ["y", "x"]


def test_header_only_csv_is_skipped_by_migration(spark, workdir, store):
    from keyferry.plans.migrate import migrate_all

    _write(workdir, "empty_orders.csv", "order_id,customer_id\n")
    _write(workdir, "orders.csv", "order_id,customer_id\n1,10\n2,10\n")
    scan = scan_folder(spark, workdir)
    mappings = [{"source": n, "target": n, "partition_key": "customer_id", "clustering_keys": "order_id"}
                for n in ("empty_orders", "orders")]
    reports = migrate_all(spark, scan.tables.__getitem__, mappings, store)
    assert [(r.source, r.status, r.rows_read) for r in reports] == [("empty_orders", "skipped_empty", 0),
                                                                   ("orders", "ok", 2)]
    assert not store.exists("empty_orders") and store.read("orders").count() == 2


def test_folder_counts_with_spaces_and_plus_in_names(spark, workdir):
    folder = workdir + "/kf t+x"
    _write(folder, "x y.csv", "a\n1\n")
    _write(folder + "/my tab+1", "p.csv", "a\n1\n2\n")
    counts = {r["table"]: r["rows"] for r in folder_row_counts(spark, folder).collect()}
    assert counts == {"x y": 1, "my tab+1": 2}


def test_folder_paths_are_matched_whole(spark, workdir):
    _write(workdir + "/data", "a.csv", "x\n1\n")
    _write(workdir + "/data/sub", "b.csv", "x\n1\n2\n")
    _write(workdir + "/data/t/data", "deep.csv", "x\n1\n")  # three levels down: not a table
    # A path with "..": the folder is matched as a normalised whole path.
    assert sorted(list_tables(spark, workdir + "/data/sub/..")) == ["a", "sub"]
    tables = list_tables(spark, workdir + "/data")
    assert sorted(tables) == ["a", "sub"]  # data/t/data/deep.csv is three levels down: no table "t"
    counts = {r["table"]: r["rows"] for r in folder_row_counts(spark, workdir + "/data").collect()}
    assert counts == {"a": 1, "sub": 2}


def test_glob_characters_in_names(spark, workdir):
    folder = workdir + "/g"
    _write(folder, "sales[2024].csv", "a\n1\n2\n")
    _write(folder + "/q{1}", "p.csv", "a\n1\n")
    scan = scan_folder(spark, folder)
    assert sorted(scan.tables) == ["q{1}", "sales[2024]"] and not scan.failures
    counts = {r["table"]: r["rows"] for r in folder_row_counts(spark, folder).collect()}
    assert counts == {"sales[2024]": 2, "q{1}": 1}


def test_folder_path_with_glob_characters(spark, workdir):
    from keyferry.sinks.csv import load_folder, table_sink

    folder = workdir + "/in[1]"
    _write(folder, "sales[2024].csv", "a\n1\n2\n")
    assert sorted(list_tables(spark, folder)) == ["sales[2024]"]
    assert {r["table"]: r["rows"] for r in folder_row_counts(spark, folder).collect()} == {"sales[2024]": 2}
    spark.sql("CREATE DATABASE IF NOT EXISTS glob_db")
    res = load_folder(spark, folder, table_sink("glob_db", workdir + "/loaded"), mode="overwrite")
    assert [(r.table, r.rows) for r in res] == [("sales[2024]", 2)]
    from keyferry.sinks.csv import catalog_name

    assert catalog_name("sales[2024]").startswith("sales_2024__")
    assert res[0].target == f"`glob_db`.`{catalog_name('sales[2024]')}`"
    assert spark.table(res[0].target).count() == 2
    assert catalog_name("Orders") != catalog_name("orders") == "orders"
