"""Command line: the three programs of a migration toolkit.

    python -m keyferry migrate --mappings m.json --source parquet:/data --keyspace ks --root /shared/ks
    python -m keyferry migrate --config target.yaml --source-config source.yaml --source jdbc \\
        --keyspace ks --root /shared/ks
    python -m keyferry migrate --mappings m.json --source jdbc --url jdbc:... --user u --password-file p \\
        --keyspace ks --root /shared/ks
    python -m keyferry migrate --config target.yaml --source-config source.yaml --source jdbc \\
        --keyspace ks --target-format <connector format> --target-option output.concurrent.writes=5
    python -m keyferry load-folder --folder /landing --database staging --location-root /shared/staging
    python -m keyferry generate --out /shared/sample --customers 1000 --products 200 --orders 5000

Options are explicit arguments; mappings are a JSON list of objects with
``source_table``, ``target_table``, ``partition_key``, optional
``clustering_keys``, ``source_key``, ``order_by``, ``buckets`` and, for JDBC
sources, ``split_column`` / ``num_partitions`` (a partitioned read). The
session comes from ``spark-submit`` (``getOrCreate``). ``migrate`` prints one
JSON line per table and exits 1 when any table failed; ``load-folder`` exits
1 when a table was unreadable.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyferry import config
from keyferry.functions.typemap import keyed_table_ddl, keyspace_ddl
from keyferry.operators.conform import conform
from keyferry.plans.migrate import migrate_all
from keyferry.sinks.connector import ConnectorStore
from keyferry.sinks.csv import load_folder, table_sink, write_csv
from keyferry.sinks.keyed import KeyedStore
from keyferry.sources import jdbc
from keyferry.spec import PlanSettings, RunOptions, TableMapping
from keyferry.synth import generate as gen


def _reader(spark: SparkSession, args: argparse.Namespace, mappings: list[dict]) -> Callable[[str], DataFrame]:
    if args.source.startswith("parquet:"):
        root = args.source.split(":", 1)[1].rstrip("/")
        # "dbo.orders" names the file orders.parquet: the schema part is the source's.
        return lambda name: spark.read.parquet(f"{root}/{jdbc.split_table_name(name)[1]}.parquet")
    if args.source == "table":
        return spark.table
    if args.source == "jdbc":
        password = getattr(args, "password_value", None)
        if args.password_file:
            with open(args.password_file) as f:
                password = f.read().strip()
        conn = jdbc.JdbcConnection(args.url, args.user, password, args.driver)
        splits = {m.get("source_table") or m.get("source"): m for m in mappings if m.get("split_column")}

        def read(name: str) -> DataFrame:
            schema, table = jdbc.split_table_name(name)
            m = splits.get(name, {})
            return jdbc.read_table(
                spark, conn, table, schema, partition_column=m.get("split_column"),
                num_partitions=m.get("num_partitions"),
            )

        return read
    raise SystemExit(f"unknown --source {args.source!r}: use parquet:<dir>, table or jdbc")


def cmd_migrate(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.config:
        mappings, settings, options = config.run_settings(config.load_file(args.config))
    else:
        if not args.mappings:
            raise SystemExit("give --mappings or --config")
        with open(args.mappings) as f:
            mappings = json.load(f)
        settings, options = PlanSettings(), RunOptions()
    if args.plan:
        settings = PlanSettings.from_dict({**settings.__dict__, **json.loads(args.plan)})
    options.mode = args.mode or options.mode
    options.profile = args.profile
    options.reconcile = args.reconcile
    options.rejects = args.rejects
    options.confirm_truncate = options.confirm_truncate and not args.no_truncate
    if args.source_config:
        src_cfg = config.load_file(args.source_config)
        mappings = config.attach_source_keys(mappings, config.source_keys(src_cfg))
        if args.source == "jdbc" and not args.url:
            conn = config.jdbc_connection(src_cfg)
            args.url, args.user, args.driver = conn.url, conn.user, conn.driver
            args.password_value = conn.password
    if args.print_ddl:
        # DDL for the external store's keyspace and tables, from the conformed source schemas.
        print(keyspace_ddl(args.keyspace, **config.keyspace_settings(config.load_file(args.config) if args.config else {})))
        read = _reader(spark, args, mappings)
        for raw in mappings:
            m = TableMapping.from_dict(raw)
            schema = conform(read(m.source), options.profile).schema
            print(keyed_table_ddl(schema, args.keyspace, m.target, m.partition_key, m.clustering_keys, options.profile))
        return 0
    if args.target_format:
        # An external keyed store through its Spark connector (jar on the cluster).
        tuning = {**options.extra, **_pairs("--target-option", args.target_option)}
        store = ConnectorStore(spark, args.target_format, args.keyspace, tuning=tuning)
    else:
        if not args.root:
            raise SystemExit("give --root: the shared folder that keeps the keyed tables")
        store = KeyedStore(spark, args.keyspace, args.root)
    reports = migrate_all(spark, _reader(spark, args, mappings), mappings, store, settings, options,
                          parallelism=args.parallelism, relations=_pair_list("--relation", args.relation))
    for r in reports:
        print(json.dumps(r.__dict__, default=str))
    return 1 if any(r.status in ("failed", "mismatch", "skipped_parent", "cancelled") for r in reports) else 0


def _pair_list(flag: str, given: Sequence[str] | None) -> list[tuple[str, str]]:
    bad = [kv for kv in given or [] if "=" not in kv]
    if bad:
        raise SystemExit(f"{flag} takes key=value, got {bad}")
    return [tuple(kv.split("=", 1)) for kv in given or []]


def _pairs(flag: str, given: Sequence[str] | None) -> dict[str, str]:
    return dict(_pair_list(flag, given))


def cmd_load_folder(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.url:
        password = None
        if args.password_file:
            with open(args.password_file) as f:
                password = f.read().strip()
        conn = jdbc.JdbcConnection(args.url, args.user, password, args.driver)

        def sink(name: str, df: DataFrame, mode: str) -> str:
            from keyferry.sinks.jdbc import write_table

            write_table(df, conn, name, args.schema, mode)
            return jdbc.qualified(name, args.schema)
    else:
        if not args.location_root:
            raise SystemExit("give --location-root: the shared folder that keeps the loaded tables")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{args.database}`")
        sink = table_sink(args.database, args.location_root)
    results = load_folder(spark, args.folder, sink, mode=args.mode, options=_pairs("--csv-option", args.csv_option), rejects_root=args.rejects)
    for r in results:
        print(json.dumps(r.__dict__))
    return 1 if any(r.status != "ok" for r in results) else 0


def cmd_generate(spark: SparkSession, args: argparse.Namespace) -> int:
    for n, what in ((args.customers, "customers"), (args.products, "products"), (args.orders, "orders"),
                    (args.max_items, "max-items")):
        if n < 1:
            raise SystemExit(f"--{what} must be at least 1")
    ids = lambda first, n, name: spark.range(first, first + n).select(F.col("id").alias(name))
    customers = gen.customers(ids(gen.FIRST_CUSTOMER_ID, args.customers, "customer_id"))
    products = gen.products(ids(gen.FIRST_PRODUCT_ID, args.products, "product_id"))
    orders = gen.orders(ids(gen.FIRST_ORDER_ID, args.orders, "order_id"), args.customers)
    lines = gen.order_lines(orders, products, args.products, args.max_items)
    out = args.out.rstrip("/")
    for name, df in (("customers", customers), ("products", products), ("orders", orders), ("order_details", lines)):
        write_csv(df, f"{out}/{name}", mode="overwrite")
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="keyferry")
    sub = p.add_subparsers(dest="cmd", required=True)

    m = sub.add_parser("migrate", help="relational/parquet tables -> keyed tables")
    m.add_argument("--mappings", help="JSON list of table mappings")
    m.add_argument("--config", help="YAML/JSON with table_mappings, optimization, write_options")
    m.add_argument("--source-config", help="YAML/JSON with the JDBC source (jdbc_url, tables with primary keys)")
    m.add_argument("--source", required=True, help="parquet:<dir> | table | jdbc")
    m.add_argument("--url")
    m.add_argument("--user")
    m.add_argument("--password-file")
    m.add_argument("--driver")
    m.add_argument("--keyspace", required=True)
    m.add_argument("--root", help="folder of the keyed tables (shared storage)")
    m.add_argument("--target-format", help="write through this connector format instead of keyed parquet tables")
    m.add_argument("--target-option", action="append", help="connector option k=v (repeatable)")
    m.add_argument("--print-ddl", action="store_true", help="print the keyed-store DDL of each mapping and stop")
    m.add_argument("--mode", choices=["append", "overwrite", "ignore", "error"], help="default: config or append")
    m.add_argument("--profile", default="reference", choices=["reference", "exact"])
    m.add_argument("--plan", help="JSON of PlanSettings fields")
    m.add_argument("--parallelism", type=int, default=1)
    m.add_argument("--reconcile", action="store_true")
    m.add_argument("--relation", action="append", help="child=parent source tables: the child waits for its parent (repeatable)")
    m.add_argument("--rejects", help="shared folder for values that an existing table's types refuse")
    m.add_argument("--no-truncate", action="store_true", help="refuse overwrite of existing tables")

    f = sub.add_parser("load-folder", help="CSV folder -> catalog tables or a JDBC database")
    f.add_argument("--folder", required=True)
    f.add_argument("--database", default="staging")
    f.add_argument("--location-root")
    f.add_argument("--url")
    f.add_argument("--user")
    f.add_argument("--password-file")
    f.add_argument("--driver")
    f.add_argument("--schema", default=jdbc.DEFAULT_SCHEMA)
    f.add_argument("--mode", default="overwrite")
    f.add_argument("--csv-option", action="append", help="option of the CSV reader k=v (repeatable), e.g. multiLine=false")
    f.add_argument("--rejects", help="shared folder for records that do not fit their table")

    g = sub.add_parser("generate", help="related sample tables as CSV")
    g.add_argument("--out", required=True)
    g.add_argument("--customers", type=int, default=100)
    g.add_argument("--products", type=int, default=50)
    g.add_argument("--orders", type=int, default=500)
    g.add_argument("--max-items", type=int, default=gen.MAX_ITEMS)
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = spark or SparkSession.builder.appName(f"keyferry-{args.cmd}").getOrCreate()
    return {"migrate": cmd_migrate, "load-folder": cmd_load_folder, "generate": cmd_generate}[args.cmd](spark, args)


if __name__ == "__main__":
    sys.exit(main())
