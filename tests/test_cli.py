"""The command-line programs, run in-process on the test session."""

from __future__ import annotations

import json

from keyferry.cli import main
from keyferry.sources.csv_folder import list_tables, read_csv
from tests.conftest import SF001


def test_migrate_cli(spark, workdir, capsys, tmp_path):
    mappings = [
        {"source_table": "nation", "target_table": "nation", "partition_key": "n_nationkey"},
        {"source_table": "orders", "target_table": "orders", "partition_key": "o_custkey",
         "clustering_keys": ["o_orderdate", "o_orderkey"], "source_key": "o_orderkey"},
        {"source_table": "nope", "target_table": "nope", "partition_key": "id"},
    ]
    mfile = tmp_path / "m.json"
    mfile.write_text(json.dumps(mappings))
    code = main(["migrate", "--mappings", str(mfile), "--source", f"parquet:{SF001}", "--keyspace", "cli_ks",
                 "--root", workdir, "--parallelism", "2", "--reconcile"], spark)
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert [(r["source"], r["status"]) for r in lines] == [("nation", "ok"), ("orders", "ok"), ("nope", "failed")]
    assert code == 1  # a failed table makes the run fail
    assert spark.table("cli_ks.orders").count() == spark.read.parquet(f"{SF001}/orders.parquet").count()


def test_generate_and_load_cli(spark, workdir, capsys):
    assert main(["generate", "--out", workdir + "/gen", "--customers", "20", "--products", "5", "--orders", "30"],
                spark) == 0
    assert sorted(list_tables(spark, workdir + "/gen")) == ["customers", "order_details", "orders", "products"]
    zips = read_csv(spark, list_tables(spark, workdir + "/gen")["customers"], infer=False).select("zip_code")
    # Read as text, zip codes keep their leading zeros: always five digits.
    assert zips.filter("length(zip_code) != 5").count() == 0
    assert main(["load-folder", "--folder", workdir + "/gen", "--database", "cli_load",
                 "--location-root", workdir + "/loaded"], spark) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert {r["table"]: r["rows"] for r in out}["customers"] == 20
    assert spark.table("cli_load.orders").count() == 30


def test_migrate_cli_with_config_files(spark, workdir, capsys, tmp_path):
    """Mappings, plan and write options from a YAML config; primary keys from
    a source config become source keys (no dedupe shuffle for them)."""
    (tmp_path / "target.yaml").write_text(
        "table_mappings:\n"
        "  - source_table: dbo.orders\n"
        "    target_table: orders\n"
        "    partition_key: o_custkey\n"
        "    clustering_keys:\n"
        "      - o_orderdate\n"
        "      - o_orderkey\n"
        "  - source_table: region\n"
        "    target_table: region\n"
        "    partition_key: r_regionkey\n"
        "optimization:\n"
        "  enable_repartition: true\n"
        "  enable_cache: true\n"
        "  repartition_threshold: 1000\n"
        "  target_partitions: null\n"
        "  rows_per_partition: 500\n"
        "write_options:\n"
        "  mode: append\n"
        "  confirm.truncate: true\n"
    )
    (tmp_path / "source.yaml").write_text(
        "db:\n"
        "  host: h\n"
        "  port: 1\n"
        "  database: d\n"
        "  jdbc_url: 'jdbc:x://{host}:{port};databaseName={database};encrypt={encrypt}'\n"
        "  connection:\n"
        "    encrypt: false\n"
        "tables:\n"
        "  - name: orders\n"
        "    schema: dbo\n"
        "    primary_key: o_orderkey\n"
    )
    from keyferry import config

    src = config.load_file(str(tmp_path / "source.yaml"))
    assert config.jdbc_connection(src).url == "jdbc:x://h:1;databaseName=d;encrypt=false"
    maps, plan, opts = config.run_settings(config.load_file(str(tmp_path / "target.yaml")))
    assert plan.enable_cache and plan.rows_per_partition == 500 and opts.mode == "append"
    assert config.attach_source_keys(maps, config.source_keys(src))[0]["source_key"] == ["o_orderkey"]

    # The real parquet reader reads "dbo.orders" from orders.parquet; the
    # mappings handed to the job carry the source keys from the source config.
    import keyferry.cli as cli

    seen = {}
    real = cli.migrate_all

    def spy(spark_, reader, mappings, *a, **kw):
        seen["mappings"] = mappings
        return real(spark_, reader, mappings, *a, **kw)

    cli.migrate_all = spy
    try:
        code = main(["migrate", "--config", str(tmp_path / "target.yaml"), "--source-config",
                     str(tmp_path / "source.yaml"), "--source", f"parquet:{SF001}", "--keyspace", "cfg_ks",
                     "--root", workdir], spark)
    finally:
        cli.migrate_all = real
    assert seen["mappings"][0]["source_key"] == ["o_orderkey"]
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert code == 0 and [r["status"] for r in lines] == ["ok", "ok"]
    orders = spark.read.parquet(f"{SF001}/orders.parquet").count()
    assert lines[0]["rows_written"] == orders and lines[0]["plan_action"] == "repartition"


def test_migrate_cli_through_a_connector(spark, workdir, capsys, tmp_path):
    mfile = tmp_path / "m.json"
    mfile.write_text(json.dumps([{"source_table": "nation", "target_table": "nation", "partition_key": "n_nationkey"}]))
    import keyferry.cli as cli

    made = {}
    real = cli.ConnectorStore

    def spy(spark_, fmt, keyspace, tuning=None):
        made.update(fmt=fmt, keyspace=keyspace, tuning=tuning)
        return real(spark_, fmt, keyspace, tuning=tuning)

    cli.ConnectorStore = spy
    try:
        code = main(["migrate", "--mappings", str(mfile), "--source", f"parquet:{SF001}", "--keyspace", "ks",
                     "--target-format", "noop", "--target-option", "output.batch.size.rows=1000"], spark)
    finally:
        cli.ConnectorStore = real
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert code == 0 and lines[0]["status"] == "ok" and lines[0]["rows_written"] == 25
    assert made == {"fmt": "noop", "keyspace": "ks", "tuning": {"output.batch.size.rows": "1000"}}


def test_print_ddl(spark, capsys, tmp_path):
    mfile = tmp_path / "m.json"
    mfile.write_text(json.dumps([{"source_table": "orders", "target_table": "orders", "partition_key": "o_custkey",
                                  "clustering_keys": ["o_orderdate", "o_orderkey"]}]))
    assert main(["migrate", "--mappings", str(mfile), "--source", f"parquet:{SF001}", "--keyspace", "ks",
                 "--print-ddl"], spark) == 0
    out = capsys.readouterr().out.strip().splitlines()[-1]
    assert out.startswith('CREATE TABLE IF NOT EXISTS "ks"."orders" ("o_orderkey" bigint, "o_custkey" bigint')
    assert '"o_orderdate" text' in out and out.endswith('PRIMARY KEY (("o_custkey"), "o_orderdate", "o_orderkey"))')


def test_print_ddl_begins_with_the_keyspace(spark, capsys, tmp_path):
    cfg = tmp_path / "c.json"
    cfg.write_text(json.dumps({"keyspace": {"replication_factor": 3, "durable_writes": "false"}, "table_mappings": [
        {"source_table": "region", "target_table": "region", "partition_key": "r_regionkey"}]}))
    assert main(["migrate", "--config", str(cfg), "--source", f"parquet:{SF001}", "--keyspace", "ks", "--print-ddl"], spark) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert out[-2] == ("CREATE KEYSPACE IF NOT EXISTS \"ks\" WITH replication = {'class': 'SimpleStrategy', 'replication_factor': 3} "
                       "AND durable_writes = false")


def test_relations_and_rejects(spark, capsys, tmp_path):
    mfile = tmp_path / "m.json"
    mfile.write_text(json.dumps([{"source_table": "nation", "target_table": "nation", "partition_key": "n_nationkey"},
                                 {"source_table": "region", "target_table": "region", "partition_key": "no_such"}]))
    code = main(["migrate", "--mappings", str(mfile), "--source", f"parquet:{SF001}", "--keyspace", "rel_ks", "--root", str(tmp_path / "k"),
                 "--relation", "nation=region", "--rejects", str(tmp_path / "r")], spark)
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert code == 1 and [r["status"] for r in lines] == ["skipped_parent", "failed"]


def test_load_folder_options(spark, capsys, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_text("id;name\n1;a\n2;b;c\n")
    code = main(["load-folder", "--folder", str(tmp_path / "in"), "--database", "opt_db", "--location-root", str(tmp_path / "out"),
                 "--csv-option", "sep=;", "--rejects", str(tmp_path / "r")], spark)
    line = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")][0]
    assert code == 0 and (line["rows"], line["rejected"]) == (1, 1)
