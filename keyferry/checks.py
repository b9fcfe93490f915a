"""Registered queries: one per operator of the inventory, each with a DuckDB
statement that computes the same rows from the same parquet tables.

Every query reads whole given tables (or frames Spark derives from them).
Queries that write (keyed tables, CSV exports) write under the shared work
folder, into fresh locations, so repeated or concurrent runs never collide.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyferry.operators.audit import reconcile, row_counts
from keyferry.operators.conform import REFUSED, as_utc_wall_clock, conform, refusal_counts, refused_values, try_types
from keyferry.operators.joins import line_amount as line_amount_join
from keyferry.operators.joins import orphans
from keyferry.operators.keys import duplicate_keys as duplicate_keys_op
from keyferry.operators.keys import key_sketch, null_key_counts
from keyferry.operators.layout import by_key, by_key_balanced, round_robin, shrink
from keyferry.plans.migrate import migrate_all, migrate_table as migrate_table_job, report_frame
from keyferry.plans.partition_plan import PartitionPlan, plan_columns
from keyferry.session import fresh_path, unique_name
from keyferry.sinks.connector import ConnectorStore
from keyferry.sinks.csv import export_tables, load_checked, load_folder, table_sink, write_csv
from keyferry.sinks.keyed import KeyedStore
from keyferry.sources.csv_folder import folder_row_counts, read_checked, read_csv
from keyferry.sources.files import size_plans
from keyferry.sources.ranges import hash_predicates, quantile_cuts, range_predicates
from keyferry.spec import PlanSettings, RunOptions, TableMapping
from keyferry.streaming.folder_feed import feed_keyed_table
from keyferry.synth import generate as gen

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Keys of the driver tables used by the keyed checks.
LINEITEM_PK, LINEITEM_CK = ("l_orderkey",), ("l_linenumber",)
ORDERS_PK, ORDERS_CK = ("o_custkey",), ("o_orderdate", "o_orderkey")
CHECK_BUCKETS = 8

# Partition-plan settings scaled so the test tables reach every branch.
CHECK_PLAN = PlanSettings(
    repartition_threshold=10_000, rows_per_partition=5_000, small_rows_per_partition=1_000, small_max_partitions=10
)
CHECK_CURRENT_PARTITIONS = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _store(spark: SparkSession) -> KeyedStore:
    st = KeyedStore(spark, "kf_check", fresh_path(spark, "store"))
    st.create_keyspace()
    return st


def _nonkey_desc(cols: list[str], key: tuple[str, ...]) -> str:
    return ", ".join(f"{c} DESC" for c in cols if c not in key)


LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


# -- U1 / K2 -------------------------------------------------------------------
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _store(spark)
    name = unique_name("lineitem")
    st.write(table(spark, sf_dir, "lineitem"), name, LINEITEM_PK, LINEITEM_CK, buckets=CHECK_BUCKETS)
    return st.read(name)


SQL_KEYED_UPSERT = f"""SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {_nonkey_desc(LINEITEM_COLS, LINEITEM_PK + LINEITEM_CK)}) = 1"""


# -- U2 ------------------------------------------------------------------------
def _second_batch(orders: DataFrame) -> DataFrame:
    """Open orders re-sent with a revised priority and price, and pending
    orders re-sent under new keys (negated order keys)."""
    revised = orders.filter(F.col("o_orderstatus") == "O").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice"), "o_orderdate",
        F.lit("0-REVISED").alias("o_orderpriority"),
    )
    rekeyed = orders.filter(F.col("o_orderstatus") == "P").select(
        (-F.col("o_orderkey") - F.lit(1)).alias("o_orderkey"), "o_custkey", "o_orderstatus", "o_totalprice",
        "o_orderdate", "o_orderpriority",
    )
    return revised.unionByName(rekeyed)


SQL_SECOND_BATCH = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
         '0-REVISED' AS o_orderpriority FROM orders WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT -o_orderkey - 1 AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'P'"""


def keyed_upsert_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _store(spark)
    name = unique_name("orders")
    orders = table(spark, sf_dir, "orders")
    st.write(orders, name, ORDERS_PK, ORDERS_CK, buckets=CHECK_BUCKETS, unique=True)
    st.write(_second_batch(orders), name, ORDERS_PK, ORDERS_CK, mode="append")
    return st.read(name)


SQL_KEYED_UPSERT_TWO_BATCHES = f"""WITH b2 AS ({SQL_SECOND_BATCH})
SELECT * FROM b2
UNION ALL
SELECT o.* FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.o_custkey = o.o_custkey AND b2.o_orderdate = o.o_orderdate
                  AND b2.o_orderkey = o.o_orderkey)"""


def keyed_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _store(spark)
    name = unique_name("orders")
    orders = table(spark, sf_dir, "orders")
    st.write(orders, name, ORDERS_PK, ORDERS_CK, buckets=CHECK_BUCKETS, unique=True)
    st.write(_second_batch(orders), name, ORDERS_PK, ORDERS_CK, mode="overwrite", confirm_truncate=True)
    return st.read(name)


SQL_KEYED_OVERWRITE = SQL_SECOND_BATCH
SQL_KEYED_COMPACT = SQL_KEYED_UPSERT_TWO_BATCHES


def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch written twice (as after a retried run) leaves the
    table of one write."""
    st = _store(spark)
    name = unique_name("lineitem")
    li = table(spark, sf_dir, "lineitem")
    st.write(li, name, LINEITEM_PK, LINEITEM_CK, buckets=CHECK_BUCKETS)
    st.write(li, name, LINEITEM_PK, LINEITEM_CK)
    return st.read(name)


SQL_UPSERT_IDEMPOTENT = SQL_KEYED_UPSERT


def keyed_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert a second batch, then point the table back at its first version."""
    st = _store(spark)
    name = unique_name("orders")
    orders = table(spark, sf_dir, "orders")
    first = st.write(orders, name, ORDERS_PK, ORDERS_CK, buckets=CHECK_BUCKETS, unique=True).location
    st.write(_second_batch(orders), name, ORDERS_PK, ORDERS_CK)
    st.rollback(name, first)
    return st.read(name)


SQL_KEYED_ROLLBACK = "SELECT * FROM orders"


def keyed_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two upserts, then compaction to one file per bucket: same rows."""
    st = _store(spark)
    name = unique_name("orders")
    orders = table(spark, sf_dir, "orders")
    st.write(orders, name, ORDERS_PK, ORDERS_CK, buckets=CHECK_BUCKETS, unique=True)
    st.write(_second_batch(orders), name, ORDERS_PK, ORDERS_CK)
    st.compact(name)
    return st.read(name)


def folder_feed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming form of the folder load: orders arrive as CSV in two rounds
    (all orders, then the second batch) and each round is fed through the
    checkpointed file stream into the keyed table."""
    orders = table(spark, sf_dir, "orders")
    folder = fresh_path(spark, "feed")
    st = _store(spark)
    name = unique_name("orders_feed")
    m = TableMapping.of("incoming", name, ORDERS_PK, ORDERS_CK)
    for i, batch in enumerate((orders, _second_batch(orders))):
        write_csv(batch, f"{folder}/in/round{i}")
        q = feed_keyed_table(
            spark, f"{folder}/in/*", orders.schema, st, m, buckets=CHECK_BUCKETS, checkpoint=f"{folder}/checkpoint"
        )
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"feed round {i} failed: {q.exception()}")
    return st.read(name)


SQL_FOLDER_FEED_UPSERT = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM ({SQL_KEYED_UPSERT_TWO_BATCHES}) AS t"""


# -- S3 / K4 K5 K6 R6 -----------------------------------------------------------
def keyed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _store(spark)
    name = unique_name("orders")
    st.write(table(spark, sf_dir, "orders"), name, ORDERS_PK, ORDERS_CK, buckets=CHECK_BUCKETS, unique=True)
    return st.read(name)


SQL_KEYED_SCAN = "SELECT * FROM orders"


def keyed_table_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _store(spark)
    name = unique_name("orders")
    orders = table(spark, sf_dir, "orders")
    created = st.create_table(name, orders, ORDERS_PK, ORDERS_CK, buckets=CHECK_BUCKETS)
    assert created and st.exists(name) and not st.create_table(name, orders, ORDERS_PK, ORDERS_CK)
    st.write(orders, name, ORDERS_PK, ORDERS_CK, unique=True)
    # Read by ordinary splits, not per bucket: a customer holding a third of
    # the orders is then combined map-side instead of being one task.
    return st.read(name, bucketed=False).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"),
        F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"),
    )


SQL_KEYED_TABLE_LAYOUT = """SELECT o_custkey, count(*) AS orders, min(o_orderdate) AS first_date,
  max(o_orderdate) AS last_date FROM orders GROUP BY o_custkey"""


def keyed_layout_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows outside the bucket of their key, and rows before their predecessor in a file."""
    st = _store(spark)
    name = unique_name("orders")
    st.write(table(spark, sf_dir, "orders"), name, ORDERS_PK, ORDERS_CK, buckets=CHECK_BUCKETS, unique=True)
    rows = st.read(name, bucketed=False).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"),
        F.struct(*ORDERS_PK, *ORDERS_CK).alias("key"),
        F.pmod(F.hash(*ORDERS_PK), F.lit(CHECK_BUCKETS)).cast("int").alias("bucket"))
    own = F.regexp_extract("file", r"_([0-9]{5})\.c[0-9]+", 1).cast("int")
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    return rows.select((F.col("bucket") != own).alias("misplaced"), (before > F.col("key")).alias("late")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("misplaced").alias("misplaced"), F.count_if("late").alias("out_of_order"))


SQL_KEYED_LAYOUT_ORDER = "SELECT count(*) AS rows, 0::BIGINT AS misplaced, 0::BIGINT AS out_of_order FROM orders"


def keyed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer's orders from a date on, in key order (reading a part is the feature)."""
    st = _store(spark)
    name = unique_name("orders")
    orders = table(spark, sf_dir, "orders")
    st.write(orders, name, ORDERS_PK, ORDERS_CK, buckets=CHECK_BUCKETS, unique=True)
    who = orders.agg(F.min("o_custkey")).first()[0]
    since = orders.agg(F.min("o_orderdate")).first()[0]
    return st.lookup(name, ranges={"o_orderdate": (since, None)}, ordered=True, o_custkey=who)


SQL_KEYED_LOOKUP = """SELECT * FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders)
  AND o_orderdate >= (SELECT min(o_orderdate) FROM orders)"""


# -- P1 ------------------------------------------------------------------------
def conform_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "events"), "reference")


SQL_CONFORM_REFERENCE = """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM events"""


def conform_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_utc_wall_clock(conform(table(spark, sf_dir, "lineitem"), "exact"))


SQL_CONFORM_EXACT = "SELECT * FROM lineitem"


# -- V1 ------------------------------------------------------------------------
def key_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_key_counts(table(spark, sf_dir, "orders"), ORDERS_PK + ORDERS_CK, "orders").unionByName(
        null_key_counts(table(spark, sf_dir, "events"), ("user_id", "ts"), "events")
    )


SQL_KEY_NULL_COUNTS = """SELECT 'orders' AS "table", 'o_custkey' AS "column", CAST(count_if(o_custkey IS NULL) AS BIGINT) AS null_cells, count(*) AS rows FROM orders
UNION ALL SELECT 'orders', 'o_orderdate', CAST(count_if(o_orderdate IS NULL) AS BIGINT), count(*) FROM orders
UNION ALL SELECT 'orders', 'o_orderkey', CAST(count_if(o_orderkey IS NULL) AS BIGINT), count(*) FROM orders
UNION ALL SELECT 'events', 'user_id', CAST(count_if(user_id IS NULL) AS BIGINT), count(*) FROM events
UNION ALL SELECT 'events', 'ts', CAST(count_if(ts IS NULL) AS BIGINT), count(*) FROM events"""


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys_op(table(spark, sf_dir, "lineitem"), LINEITEM_PK + LINEITEM_CK)


SQL_DUPLICATE_KEYS = """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""


# -- R1-R4 -------------------------------------------------------------------------
def partition_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = row_counts({t: table(spark, sf_dir, t) for t in TABLES}).withColumnRenamed("table", "table_name")
    current = F.lit(CHECK_CURRENT_PARTITIONS).cast("bigint")
    action, n = plan_columns(F.col("rows"), current, CHECK_PLAN)
    return counts.select(
        "table_name", "rows", current.alias("current_partitions"), action.alias("action"), n.alias("partitions")
    )


def _counts_sql(alias: str = "table_name") -> str:
    return "\nUNION ALL ".join(f"SELECT '{t}' AS {alias}, count(*) AS rows FROM {t}" for t in TABLES)


SQL_PARTITION_PLAN = f"""WITH c AS ({_counts_sql()})
SELECT table_name, rows, CAST({CHECK_CURRENT_PARTITIONS} AS BIGINT) AS current_partitions,
  CASE WHEN rows >= {CHECK_PLAN.repartition_threshold} THEN 'repartition'
       WHEN {CHECK_CURRENT_PARTITIONS} > {CHECK_PLAN.small_max_partitions} THEN 'coalesce' ELSE 'none' END AS action,
  CAST(CASE WHEN rows >= {CHECK_PLAN.repartition_threshold} THEN greatest(1, rows // {CHECK_PLAN.rows_per_partition})
       WHEN {CHECK_CURRENT_PARTITIONS} > {CHECK_PLAN.small_max_partitions}
         THEN greatest(1, least({CHECK_PLAN.small_max_partitions}, rows // {CHECK_PLAN.small_rows_per_partition}))
       ELSE {CHECK_CURRENT_PARTITIONS} END AS BIGINT) AS partitions
FROM c"""


def key_locality(spark: SparkSession, sf_dir: str) -> DataFrame:
    parted = by_key(table(spark, sf_dir, "orders"), 8, ORDERS_PK)
    per_key = parted.select("o_custkey", F.spark_partition_id().alias("pid")).groupBy("o_custkey").agg(
        F.count_distinct("pid").alias("parts")
    )
    return per_key.agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("parts") > 1).alias("split_keys"))


SQL_KEY_LOCALITY = "SELECT count(DISTINCT o_custkey) AS keys, CAST(0 AS BIGINT) AS split_keys FROM orders"


def balanced_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    parted = round_robin(lines, 6)
    sizes = parted.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("n"))
    # Every input partition deals its rows out in turn, so it adds at most one to the difference.
    return sizes.agg(F.count(F.lit(1)).alias("partitions_used"), F.sum("n").cast("bigint").alias("rows"),
                     (F.max("n") - F.min("n") <= F.lit(lines.rdd.getNumPartitions())).alias("even"))


SQL_BALANCED_PARTITIONS = """SELECT CAST(least(6, count(*)) AS BIGINT) AS partitions_used, count(*) AS rows, true AS even
FROM lineitem"""


def coalesced_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions merged without a shuffle; every row stays."""
    merged = shrink(round_robin(table(spark, sf_dir, "lineitem"), 12), 4)
    sizes = merged.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("partitions_used"), F.sum("n").cast("bigint").alias("rows"))


SQL_COALESCED_PARTITIONS = "SELECT CAST(least(4, count(*)) AS BIGINT) AS partitions_used, count(*) AS rows FROM lineitem"


# -- A1 ------------------------------------------------------------------------
def row_count_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({t: table(spark, sf_dir, t) for t in TABLES})


SQL_ROW_COUNT_AUDIT = f"""{_counts_sql('"table"')}"""


# -- M1 / M2 / F1 / A2 / A3 ---------------------------------------------------------
def _reader(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    def read(name: str) -> DataFrame:
        if name == "orders_without_customer":
            # A derived source that is empty on consistent data (F1 path).
            return table(spark, sf_dir, "orders").join(
                table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti"
            )
        return table(spark, sf_dir, name)

    return read


def migrate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _store(spark)
    name = unique_name("customer")
    m = TableMapping.of("customer", name, "c_custkey", source_key="c_custkey")
    rep = migrate_table_job(spark, _reader(spark, sf_dir), m, st, PlanSettings(), RunOptions())
    assert rep.status == "ok", rep
    return st.read(name)


SQL_MIGRATE_TABLE = "SELECT * FROM customer"


def migrate_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 in the exact profile with reconciliation: timestamps stay instants
    (read back here as UTC wall clock), duplicates resolved by U1."""
    st = _store(spark)
    name = unique_name("lineitem")
    m = TableMapping.of("lineitem", name, LINEITEM_PK, LINEITEM_CK, buckets=CHECK_BUCKETS)
    rep = migrate_table_job(spark, _reader(spark, sf_dir), m, st, PlanSettings(),
                            RunOptions(profile="exact", reconcile=True))
    assert rep.status == "ok" and rep.missing_keys == 0 and rep.changed_rows == 0, rep
    return as_utc_wall_clock(st.read(name))


SQL_MIGRATE_EXACT = SQL_KEYED_UPSERT


REPORT_MAPPINGS = [
    {"source_table": "customer", "target_table": "customers", "partition_key": "c_custkey", "source_key": "c_custkey"},
    {"source_table": "part", "target_table": "parts", "partition_key": ["p_partkey"]},
    {"source_table": "orders", "target_table": "orders", "partition_key": "o_custkey",
     "clustering_keys": ["o_orderdate", "o_orderkey"], "source_key": "o_orderkey"},
    {"source_table": "lineitem", "target_table": "lineitems", "partition_key": "l_orderkey",
     "clustering_keys": "l_linenumber"},
    {"source_table": "orders_without_customer", "target_table": "orphans", "partition_key": "o_custkey"},
    {"source_table": "no_such_table", "target_table": "missing", "partition_key": "id"},
    {"source_table": "supplier", "target_table": "no_key"},
    {"source_table": "embeddings", "target_table": "vectors", "partition_key": "vec_id", "source_key": "vec_id"},
]


def migrate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = KeyedStore(spark, unique_name("kf_report"), fresh_path(spark, "report"))
    reports = migrate_all(spark, _reader(spark, sf_dir), REPORT_MAPPINGS, st, PlanSettings(), RunOptions(), parallelism=4)
    return report_frame(spark, reports).select(
        "source", "status", "rows_read", "rows_written", "error_class"
    )


SQL_MIGRATE_REPORT = """SELECT 'customer' AS source, 'ok' AS status, (SELECT count(*) FROM customer) AS rows_read,
  (SELECT count(*) FROM customer) AS rows_written, CAST(NULL AS VARCHAR) AS error_class
UNION ALL SELECT 'part', 'ok', (SELECT count(*) FROM part), (SELECT count(DISTINCT p_partkey) FROM part), NULL
UNION ALL SELECT 'orders', 'ok', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders), NULL
UNION ALL SELECT 'lineitem', 'ok', (SELECT count(*) FROM lineitem),
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)), NULL
UNION ALL SELECT 'orders_without_customer', 'skipped_empty', 0, NULL, NULL
UNION ALL SELECT 'no_such_table', 'failed', NULL, NULL, 'AnalysisException'
UNION ALL SELECT 'supplier', 'failed', NULL, NULL, 'MappingError'
UNION ALL SELECT 'embeddings', 'failed', NULL, NULL, 'UnsupportedTypeError'"""


def reconcile_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _store(spark)
    name = unique_name("lineitem")
    src = table(spark, sf_dir, "lineitem")
    st.write(src, name, LINEITEM_PK, LINEITEM_CK, buckets=CHECK_BUCKETS)
    return reconcile(src, st.read(name), LINEITEM_PK + LINEITEM_CK)


SQL_RECONCILE = """WITH k AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
SELECT (SELECT count(*) FROM lineitem) AS source_rows, k.n AS source_keys, k.n AS target_rows,
  CAST(0 AS BIGINT) AS missing_keys, CAST(0 AS BIGINT) AS extra_keys, CAST(0 AS BIGINT) AS changed_rows FROM k"""


# -- J1 / J2 -------------------------------------------------------------------------
def line_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    prices = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return line_amount_join(lines, prices, "l_partkey", "l_quantity", "p_retailprice")


SQL_LINE_AMOUNT = """SELECT l.l_partkey, l.l_orderkey, l.l_linenumber, l.l_quantity, p.p_retailprice,
  round(p.p_retailprice * l.l_quantity, 2) AS amount
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""


FK_RELATIONS = [
    ("orders.o_custkey->customer", "orders", ["o_custkey"], "customer", ["c_custkey"]),
    ("lineitem.l_orderkey->orders", "lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
    ("lineitem.l_partkey->part", "lineitem", ["l_partkey"], "part", ["p_partkey"]),
    ("lineitem.l_suppkey->supplier", "lineitem", ["l_suppkey"], "supplier", ["s_suppkey"]),
    ("customer.c_nationkey->nation", "customer", ["c_nationkey"], "nation", ["n_nationkey"]),
    ("supplier.s_nationkey->nation", "supplier", ["s_nationkey"], "nation", ["n_nationkey"]),
    ("nation.n_regionkey->region", "nation", ["n_regionkey"], "region", ["r_regionkey"]),
]


def foreign_key_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        orphans(table(spark, sf_dir, c), fk, table(spark, sf_dir, p), pk, rel)
        for rel, c, fk, p, pk in FK_RELATIONS
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SQL_FOREIGN_KEY_ORPHANS = "\nUNION ALL ".join(
    f"""SELECT '{rel}' AS relation, count(DISTINCT c.{fk[0]}) AS orphan_keys, count(*) AS orphan_rows
FROM {c} c WHERE c.{fk[0]} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{pk[0]} = c.{fk[0]})"""
    for rel, c, fk, p, pk in FK_RELATIONS
)


# -- S4 / K8 / K7 --------------------------------------------------------------------
def csv_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "csv") + "/customer"
    write_csv(table(spark, sf_dir, "customer"), path)
    return read_csv(spark, path)


SQL_CSV_INFERRED_SCAN = """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
  c_acctbal, c_mktsegment FROM customer"""


def csv_declared_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "customer")
    path = fresh_path(spark, "csv") + "/customer"
    write_csv(src, path)
    return read_csv(spark, path, schema=src.schema)


SQL_CSV_DECLARED_SCAN = "SELECT * FROM customer"

FOLDER_TABLES = ["region", "nation", "supplier", "orders", "documents"]


def csv_folder_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "csvfolder")
    export_tables({t: table(spark, sf_dir, t) for t in FOLDER_TABLES}, folder)
    return folder_row_counts(spark, folder)


SQL_CSV_FOLDER_COUNTS = "\nUNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in FOLDER_TABLES)


def csv_folder_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "csvfolder")
    export_tables({t: table(spark, sf_dir, t) for t in FOLDER_TABLES}, folder)
    db = unique_name("kf_load")
    loaded_root = fresh_path(spark, "loaded")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{loaded_root}'")
    results = load_folder(spark, folder, table_sink(db, loaded_root), mode="overwrite")
    loaded = row_counts({r.table: spark.table(r.target) for r in results if r.status == "ok"})
    written = spark.createDataFrame([(r.table, r.rows) for r in results], "table string, rows_observed bigint")
    return loaded.join(written, "table")


SQL_CSV_FOLDER_LOAD = "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows, count(*) AS rows_observed FROM {t}" for t in FOLDER_TABLES
)


# -- G1-G4 ---------------------------------------------------------------------------
def _customer_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select((F.col("c_custkey") + F.lit(gen.FIRST_CUSTOMER_ID)).alias("customer_id"))


def _product_ids(spark, sf_dir):
    return table(spark, sf_dir, "part").select((F.col("p_partkey") + F.lit(gen.FIRST_PRODUCT_ID)).alias("product_id"))


def _order_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select((F.col("o_orderkey") + F.lit(gen.FIRST_ORDER_ID)).alias("order_id"))


SQL_CUSTOMER_IDS = f"SELECT c_custkey + {gen.FIRST_CUSTOMER_ID} AS customer_id FROM customer"
SQL_PRODUCT_IDS = f"SELECT p_partkey + {gen.FIRST_PRODUCT_ID} AS product_id FROM part"
SQL_ORDER_IDS = f"SELECT o_orderkey + {gen.FIRST_ORDER_ID} AS order_id FROM orders"


def gen_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen.customers(_customer_ids(spark, sf_dir))


def gen_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen.products(_product_ids(spark, sf_dir))


def gen_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_customers = table(spark, sf_dir, "customer").count()
    return gen.orders(_order_ids(spark, sf_dir), n_customers)


def gen_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_customers = table(spark, sf_dir, "customer").count()
    n_products = table(spark, sf_dir, "part").count()
    orders = gen.orders(_order_ids(spark, sf_dir), n_customers)
    products = gen.products(_product_ids(spark, sf_dir))
    return gen.order_lines(orders, products, n_products)


def gen_draw_independence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For pairs of drawn columns: do more than half of the pairs that could occur do so?"""
    n_c, n_p = table(spark, sf_dir, "customer").count(), table(spark, sf_dir, "part").count()
    customers, products = gen.customers(_customer_ids(spark, sf_dir)), gen.products(_product_ids(spark, sf_dir))
    orders = gen.orders(_order_ids(spark, sf_dir), n_c)
    lines = gen.order_lines(orders, products, n_p).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items"), F.min("product_id").alias("product"))
    domain = F.substring_index("email", "@", -1).alias("domain")
    word = F.substring_index("description", " ", 1).alias("word")
    pairs = [
        ("first and last name", customers.select("first_name", "last_name"), len(gen.FIRST_NAMES) * len(gen.LAST_NAMES)),
        ("city and mail domain", customers.select("city", domain), len(gen.PLACES) * len(gen.DOMAINS)),
        ("category and descriptor", products.select("category", word), len(gen.CATEGORIES) * len(gen.DESCRIPTORS)),
        ("status and payment", orders.select("status", "payment_method"), len(gen.STATUSES) * len(gen.PAYMENTS)),
        ("items and a product modulo 5", lines.select("items", F.col("product") % 5), gen.MAX_ITEMS * 5),
    ]
    rows = [
        df.toDF("a", "b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).agg(
            F.lit(name).alias("pair"), (2 * F.count(F.lit(1)) > F.least(F.lit(possible), F.sum("n"))).alias("spread"))
        for name, df, possible in pairs
    ]
    return reduce(DataFrame.unionByName, rows)


# No formula of the generator: the answer has to be yes.
SQL_GEN_DRAW_INDEPENDENCE = """SELECT * FROM (VALUES ('first and last name', true), ('city and mail domain', true),
  ('category and descriptor', true), ('status and payment', true), ('items and a product modulo 5', true)) v(pair, spread)"""


def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with spaces, quotes and line breaks through a CSV export and back."""
    folder = fresh_path(spark, "csv-text")
    sent = {n: table(spark, sf_dir, n) for n in ("documents", "conversations")}
    export_tables(sent, folder)
    back = {n: read_csv(spark, f"{folder}/{n}", schema=df.schema) for n, df in sent.items()}
    docs = back["documents"].select(F.lit("documents").alias("tab"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text")
    turns = back["conversations"].select(F.lit("conversations").alias("tab"), F.col("conv_id").alias("id"), F.col("turn").cast("bigint"), "text")
    return docs.unionByName(turns).select("tab", "id", "turn", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("chars"))


# An empty string has no CSV form of its own and comes back as NULL.
SQL_CSV_TEXT_ROUNDTRIP = """SELECT tab, id, turn, md5(nullif(text, '')) AS text_md5, length(nullif(text, '')) AS chars FROM (
  SELECT 'documents' AS tab, doc_id AS id, 0::BIGINT AS turn, text FROM documents
  UNION ALL SELECT 'conversations', conv_id, turn::BIGINT, text FROM conversations)"""


def migrate_one_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two mappings of disjoint sources into one target, submitted at once."""
    store = KeyedStore(spark, unique_name("kf_shared"), fresh_path(spark, "shared-target"))
    orders = table(spark, sf_dir, "orders")
    sources = {"open": orders.filter("o_orderstatus = 'O'"), "rest": orders.filter("o_orderstatus <> 'O'")}
    maps = [TableMapping.of(n, "orders", "o_custkey", ["o_orderdate", "o_orderkey"], buckets=CHECK_BUCKETS) for n in sources]
    reports = migrate_all(spark, sources.__getitem__, maps, store, options=RunOptions(profile="exact"), parallelism=4)
    failed = [r.error for r in reports if r.status != "ok"]
    if failed:
        raise RuntimeError("; ".join(failed))
    return store.read("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


SQL_MIGRATE_ONE_TARGET = "SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"

SQL_GEN_CUSTOMERS = gen.customers_sql(SQL_CUSTOMER_IDS)
SQL_GEN_PRODUCTS = gen.products_sql(SQL_PRODUCT_IDS)
SQL_GEN_ORDERS = gen.orders_sql(SQL_ORDER_IDS, "SELECT count(*) FROM customer")
SQL_GEN_ORDER_DETAILS = gen.order_lines_sql(
    gen.orders_sql(SQL_ORDER_IDS, "SELECT count(*) FROM customer"), gen.products_sql(SQL_PRODUCT_IDS),
    "SELECT count(*) FROM part",
)


# -- S4 with records set aside --------------------------------------------------------
def _broken(field: str, key: str) -> str:
    """Which records are broken by hand: some end early, some hold text for a number, some have a field too many."""
    return (f"CASE WHEN {key} % 11 = 0 THEN 'short' WHEN {key} % 13 = 0 THEN 'text' WHEN {key} % 17 = 0 THEN 'long' ELSE 'good' END"
            + (f" AS {field}" if field else ""))


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV lines, some broken by hand, loaded with what does not fit set aside."""
    orders = table(spark, sf_dir, "orders")
    folder, loaded = fresh_path(spark, "broken-csv"), fresh_path(spark, "loaded-csv")
    fields = [F.col(c).cast("string") for c in orders.columns]
    line = F.expr(_broken("", "o_orderkey"))
    text = (F.when(line == "short", F.concat_ws(",", *fields[:-2]))
            .when(line == "text", F.concat_ws(",", *fields[:3], F.lit("n/a"), *fields[4:]))
            .when(line == "long", F.concat_ws(",", *fields, F.lit("more")))
            .otherwise(F.concat_ws(",", *fields)))
    orders.select(text).write.text(f"{folder}/orders.csv")
    for_csv = {"header": "false"}
    db = unique_name("kf_rejects")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{loaded}'")
    # Part files of Spark's text writer end in .txt: the table is read by its own folder.
    checked = read_checked(spark, f"{folder}/orders.csv", orders.schema, for_csv)
    sink = table_sink(db, loaded)
    done = load_checked("orders", checked, sink, "overwrite", f"{loaded}/rejects")
    kept = spark.table(done.target).agg(F.sum("o_orderkey").alias("kept_keys"), F.count(F.lit(1)).alias("loaded"))
    aside = spark.read.parquet(done.rejects).agg(
        F.count(F.lit(1)).alias("set_aside"), F.count_if(F.col("record").isNull()).alias("without_text"),
        F.count_if(F.col("record").endswith(",more")).alias("too_long"))
    report = spark.createDataFrame([(done.rows, done.rejected)], "rows bigint, rejected bigint")
    one = F.lit(1).alias("one")
    return (report.select("*", one).join(kept.select("*", one), "one").join(aside.select("*", one), "one").drop("one"))


SQL_CSV_REJECTS = f"""WITH t AS (SELECT o_orderkey, {_broken('kind', 'o_orderkey')} FROM orders)
SELECT count_if(kind = 'good')::BIGINT AS rows, count_if(kind <> 'good')::BIGINT AS rejected,
  (sum(o_orderkey) FILTER (WHERE kind = 'good'))::BIGINT AS kept_keys, count_if(kind = 'good')::BIGINT AS loaded,
  count_if(kind <> 'good')::BIGINT AS set_aside, 0::BIGINT AS without_text, count_if(kind = 'long')::BIGINT AS too_long FROM t"""


# -- P1 with refused values reported ----------------------------------------------------
REFUSING_TYPES = {
    "events": {"event_type": "int", "user_id": "tinyint", "value": "tinyint", "ts": "date", "event_id": "smallint"},
    "documents": {"lang": "boolean", "source": "double", "n_chars": "smallint", "doc_id": "string"},
}


def conform_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for name, types in REFUSING_TYPES.items():
        tried = try_types(table(spark, sf_dir, name), types)
        parts.append(refusal_counts(tried, list(types)).select(F.lit(name).alias("tab"), "column", "refused"))
        whole = tried.agg(F.count_if(F.size(REFUSED) == 0).alias("refused")).select(
            F.lit(name).alias("tab"), F.lit("kept rows").alias("column"), "refused")
        listed = refused_values(tried).agg(F.count(F.lit(1)).alias("refused")).select(
            F.lit(name).alias("tab"), F.lit("refused values").alias("column"), "refused")
        parts += [whole, listed]
    return reduce(DataFrame.unionByName, parts)


# What the types refuse, in words: numbers beyond a type's range (fractions are cut off), texts that are no number.
_REFUSES = {
    ("events", "event_type"): "event_type IS NOT NULL AND NOT regexp_full_match(event_type, '[+-]?[0-9]+')",
    ("events", "user_id"): "user_id NOT BETWEEN -128 AND 127",
    ("events", "value"): "trunc(value) NOT BETWEEN -128 AND 127",
    ("events", "ts"): "false",
    ("events", "event_id"): "event_id NOT BETWEEN -32768 AND 32767",
    ("documents", "lang"): "lang IS NOT NULL AND lower(trim(lang)) NOT IN ('t', 'true', 'y', 'yes', '1', 'f', 'false', 'n', 'no', '0')",
    ("documents", "source"): "source IS NOT NULL AND TRY_CAST(source AS DOUBLE) IS NULL",
    ("documents", "n_chars"): "n_chars NOT BETWEEN -32768 AND 32767",
    ("documents", "doc_id"): "false",
}


def _refusals_sql(name: str) -> str:
    own = {c: f"coalesce({w}, false)" for (t, c), w in _REFUSES.items() if t == name}
    any_of = " OR ".join(own.values())
    rows = [f"SELECT '{name}' AS tab, '{c}' AS \"column\", count_if({w})::BIGINT AS refused FROM {name}" for c, w in own.items()]
    rows.append(f"SELECT '{name}', '*', count_if({any_of})::BIGINT FROM {name}")
    rows.append(f"SELECT '{name}', 'kept rows', count_if(NOT ({any_of}))::BIGINT FROM {name}")
    rows.append(f"SELECT '{name}', 'refused values', sum({' + '.join(f'({w})::INT' for w in own.values())})::BIGINT FROM {name}")
    return "\nUNION ALL ".join(rows)


SQL_CONFORM_REJECTS = "\nUNION ALL ".join(_refusals_sql(t) for t in REFUSING_TYPES)


# -- R2, K3 with heavy keys ----------------------------------------------------------------
SKEWED_KEY = "CASE WHEN l_linenumber <= 2 THEN -1 ELSE l_orderkey END"
BALANCED_PARTS = 8  # of a table of up to 4,000,000 rows
BALANCED_ROWS = 500_000  # of a partition of a larger one: what one task holds does not grow with the table
ORDER_CHUNK = 10_000  # rows of a file that are compared by one window


def _balanced_parts(df: DataFrame) -> int:
    return max(BALANCED_PARTS, -(-df.count() // BALANCED_ROWS))


def _skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which a quarter and more share one key."""
    return table(spark, sf_dir, "lineitem").withColumn("k", F.expr(SKEWED_KEY).cast("bigint"))


def key_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heavy keys cut into pieces, light keys whole, and no partition over twice the mean."""
    lines = _skewed(spark, sf_dir)
    parts = _balanced_parts(lines)
    placed = by_key_balanced(lines, parts, ["k"]).withColumn("p", F.spark_partition_id())
    heavy = F.col("k") == -1
    per_key = placed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p").alias("parts"))
    sizes = placed.groupBy("p").agg(F.count(F.lit(1)).alias("n")).agg((F.max("n") * parts <= 2 * F.sum("n")).alias("even"))
    return per_key.agg(
        F.sum("n").cast("bigint").alias("rows"), F.count(F.lit(1)).alias("keys"),
        F.count_if(~heavy & (F.col("parts") > 1)).alias("light_keys_cut"),
        F.max(heavy & (F.col("parts") > 1)).alias("heavy_key_cut")).join(sizes, F.col("even").isNotNull())


SQL_KEY_BALANCE = f"""SELECT count(*) AS rows, count(DISTINCT {SKEWED_KEY}) AS keys, 0::BIGINT AS light_keys_cut,
  true AS heavy_key_cut, true AS even FROM lineitem"""


def connector_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: what an external store is sent: rows of a partition key from one task, in key
    order, except those of a key too large for one. Spark's Parquet writer stands in for the connector."""
    path = fresh_path(spark, "connector")
    st = ConnectorStore(spark, "parquet", "ks", tuning={"path": path, "output.batch.grouping.key": "partition"}, balance_heavy_keys=True)
    lines = _skewed(spark, sf_dir).withColumn("line", F.monotonically_increasing_id())
    parts = _balanced_parts(lines)
    st.write(lines, "lines", ["k"], ["l_orderkey", "line"], unique=True, plan=PartitionPlan("repartition", parts, by_key=True))
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"),
                                           "k", F.struct("k", "l_orderkey", "line").alias("key"))
    # A file is compared in chunks, however long it is; the last row of each goes before the first of the next as well.
    own = F.expr(f"at div {ORDER_CHUNK}")
    chunks = F.when(F.col("at") % ORDER_CHUNK == ORDER_CHUNK - 1, F.array(own, own + 1)).otherwise(F.array(own))
    chunked = by_key(rows.withColumn("chunk", F.explode(chunks)), parts, ["chunk", "file"])
    before = F.lag("key").over(Window.partitionBy("chunk", "file").orderBy("at"))
    compared = chunked.select("chunk", "file", "k", (own == F.col("chunk")).alias("own"), (before > F.col("key")).alias("late"))
    # The keys of a chunk are counted where it lies, so a key held by many rows is a row per chunk.
    per_chunk = compared.groupBy("chunk", "file", "k").agg(F.count_if("own").alias("rows"), F.count_if("late").alias("late"))
    per_key = by_key(per_chunk, parts, ["k"]).groupBy("k").agg(
        F.sum("rows").alias("rows"), F.sum("late").alias("late"), F.count_distinct("file").alias("files"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias
    return per_key.agg(total("rows")("rows"), total("late")("out_of_order"),
                       F.count_if((F.col("k") != -1) & (F.col("files") > 1)).alias("light_keys_cut"))


SQL_CONNECTOR_GROUPING = "SELECT count(*) AS rows, 0::BIGINT AS out_of_order, 0::BIGINT AS light_keys_cut FROM lineitem"


# -- S2: ranges ------------------------------------------------------------------------------
SPLIT_PARTS = 8
# A few keys are NULL; they belong to one range like any other row.
SPLIT_KEYS = {"order key": "CASE WHEN l_orderkey % 50 <> 0 THEN l_orderkey END", "price": "l_extendedprice", "ship date": "l_shipdate"}


def split_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row in exactly one range, NULL keys too, and ranges of like size."""
    lines, docs = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "documents")
    splits = []
    for name, key in SPLIT_KEYS.items():
        df = lines.select(F.expr(key).alias("k"))
        splits.append((name, df, range_predicates("k", quantile_cuts(df, "k", SPLIT_PARTS))))
    by_text = docs.select(F.expr("CASE WHEN doc_id % 50 <> 0 THEN concat(text, doc_id) END").alias("k"))
    splits.append(("text", by_text, hash_predicates("k", 2)))
    parts = []
    for name, df, predicates in splits:
        counts = [F.count_if(F.expr(p)).alias(f"n{i}") for i, p in enumerate(predicates)]
        held = sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates)  # as a WHERE clause
        whole = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(held == 1).alias("in_one"),
                       F.count_if(F.col("k").isNull() & (held == 1)).alias("nulls_in_one"), *counts)
        sizes = [F.col(f"n{i}") for i in range(len(counts))]
        even = (F.greatest(*sizes) * len(sizes) <= 1.2 * F.col("rows")) & (F.least(*sizes) * len(sizes) >= 0.8 * F.col("rows"))
        parts.append(whole.select(F.lit(name).alias("split"), F.lit(len(counts)).cast("bigint").alias("ranges"), "rows", "in_one", "nulls_in_one", even.alias("even")))
    return reduce(DataFrame.unionByName, parts)


SQL_SPLIT_RANGES = "\nUNION ALL ".join(
    [f"""SELECT '{n}' AS split, {SPLIT_PARTS}::BIGINT AS ranges, count(*) AS rows, count(*) AS in_one,
  count_if(({k}) IS NULL)::BIGINT AS nulls_in_one, true AS even FROM lineitem""" for n, k in SPLIT_KEYS.items()]
    + ["SELECT 'text', 2::BIGINT, count(*), count(*), count_if(doc_id % 50 = 0 OR text IS NULL)::BIGINT, true FROM documents"])


# -- R1 from file sizes -------------------------------------------------------------------------
FILE_BYTES = 64 << 10


def partition_plan_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions from file metadata: enough, and none to spare."""
    plans = size_plans({t: table(spark, sf_dir, t) for t in TABLES}, FILE_BYTES)
    n, size = F.col("partitions"), F.col("bytes")
    return plans.select(F.col("table").alias("tab"), "rows", (size > 0).alias("sized"),
                        ((n * FILE_BYTES >= size) & ((n - 1) * FILE_BYTES < size)).alias("fits"))


SQL_PARTITION_PLAN_BY_SIZE = "\nUNION ALL ".join(f"SELECT '{t}' AS tab, count(*) AS rows, true AS sized, true AS fits FROM {t}" for t in TABLES)


# -- M2 in dependency order -----------------------------------------------------------------------
DEPENDENT = [
    {"source": "lineitem", "target": "lineitem", "partition_key": "l_orderkey", "clustering_keys": "l_linenumber"},
    {"source": "orders", "target": "orders", "partition_key": "o_custkey", "clustering_keys": ["o_orderdate", "o_orderkey"]},
    {"source": "customer", "target": "customer", "partition_key": "c_custkey", "source_key": "c_custkey"},
    {"source": "part", "target": "part", "partition_key": "no_such_column"},
    {"source": "supplier", "target": "supplier", "partition_key": "s_suppkey"},
    {"source": "nation", "target": "nation", "partition_key": "n_nationkey"},
    {"source": "region", "target": "region", "partition_key": "r_regionkey"},
]


def migrate_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children after their parents, and not at all when one failed: part has no such key, so lineitem stays out."""
    relations = [(child, parent) for _, child, _, parent, _ in FK_RELATIONS]
    parts = []
    for parallelism in (1, 4):
        st = KeyedStore(spark, unique_name("kf_order"), fresh_path(spark, "order"))
        began: list[str] = []

        def read(name: str) -> DataFrame:
            began.append(name)
            return table(spark, sf_dir, name)

        reports = migrate_all(spark, read, DEPENDENT, st, options=RunOptions(profile="exact"), parallelism=parallelism, relations=relations)
        place = {n: i for i, n in enumerate(began)}
        early = [r.source for r in reports if any(c == r.source and p in place and place.get(c, len(began)) < place[p] for c, p in relations)]
        parts.append(report_frame(spark, reports).select(
            F.lit(parallelism).cast("bigint").alias("parallelism"), "source", "status", "rows_written",
            F.col("source").isin(early).alias("began_early")))
    return reduce(DataFrame.unionByName, parts)


SQL_MIGRATE_DEPENDENCIES = "\nUNION ALL ".join(
    f"""SELECT {p}::BIGINT AS parallelism, '{t}' AS source, 'ok' AS status, count(*) AS rows_written, false AS began_early FROM {t}"""
    for p in (1, 4) for t in ("region", "nation", "customer", "supplier", "orders")
) + "".join(f"\nUNION ALL SELECT {p}, 'part', 'failed', NULL, false UNION ALL SELECT {p}, 'lineitem', 'skipped_parent', NULL, false" for p in (1, 4))


# -- V1 across batches --------------------------------------------------------------------------
def key_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys sketched per batch and merged without another scan: within 3 % of the exact
    numbers; and a source key declared unique that is not is refused while the table is written."""
    lines = table(spark, sf_dir, "lineitem")
    key = LINEITEM_PK + LINEITEM_CK
    path = fresh_path(spark, "sketches")
    lines.groupBy("l_returnflag").agg(key_sketch(key).alias("s"), F.count(F.lit(1)).alias("rows")).write.parquet(path)
    batches = spark.read.parquet(path)
    each = batches.select("l_returnflag", F.hll_sketch_estimate("s").alias("about"))
    merged = batches.agg(F.hll_sketch_estimate(F.hll_union_agg("s")).alias("about")).select(F.lit("all").alias("l_returnflag"), "about")
    exact = lines.groupBy("l_returnflag").agg(F.count_distinct(*key).alias("keys")).unionByName(
        lines.agg(F.count_distinct(*key).alias("keys")).select(F.lit("all").alias("l_returnflag"), "keys"))
    close = F.abs(F.col("about") - F.col("keys")) <= F.greatest(F.lit(1.0), 0.03 * F.col("keys"))
    sketched = each.unionByName(merged).join(exact, "l_returnflag").select(F.col("l_returnflag").alias("batch"), "keys", close.alias("as_told"))

    st = KeyedStore(spark, unique_name("kf_sketch"), fresh_path(spark, "sketch"))
    declared = [TableMapping.of("lineitem", "wrong", *map(list, (LINEITEM_PK, LINEITEM_CK)), source_key=list(key)),
                TableMapping.of("orders", "right", list(ORDERS_PK), list(ORDERS_CK), source_key=["o_orderkey"])]
    reports = migrate_all(spark, _reader(spark, sf_dir), declared, st, options=RunOptions(profile="exact"))
    told = [("wrong key refused", None, reports[0].error_class == "RepeatedKeyError" and not st.exists("wrong"))]
    summary = st.key_summary("right")
    told.append(("keys of the table", summary["rows"], abs(summary["keys"] - summary["rows"]) <= max(1, 0.03 * summary["rows"])))
    return sketched.unionByName(spark.createDataFrame(told, "batch string, keys bigint, as_told boolean"))


SQL_KEY_SKETCHES = """SELECT l_returnflag AS batch, count(DISTINCT (l_orderkey, l_linenumber)) AS keys, true AS as_told FROM lineitem GROUP BY ALL
UNION ALL SELECT 'all', count(DISTINCT (l_orderkey, l_linenumber)), true FROM lineitem
UNION ALL SELECT 'wrong key refused', NULL, true
UNION ALL SELECT 'keys of the table', count(*), true FROM orders"""


# -- A3: differences ------------------------------------------------------------------------------
def reconcile_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a keyed copy in which some were changed, some left out and some are new."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    wrong = orders.where(key % 97 != 1).withColumn("o_totalprice", F.when(key % 101 == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    new = orders.where(key % 103 == 3).withColumn("o_orderkey", -key - 1)
    st = _store(spark)
    name = unique_name("orders")
    st.write(wrong.unionByName(new), name, ORDERS_PK, ORDERS_CK, buckets=CHECK_BUCKETS, unique=True)
    return reconcile(orders, st.read(name), ORDERS_PK + ORDERS_CK, unique=True)


SQL_RECONCILE_DIFFERENCES = """SELECT count(*) AS source_rows, count(*) AS source_keys,
  (count_if(o_orderkey % 97 <> 1) + count_if(o_orderkey % 103 = 3))::BIGINT AS target_rows, count_if(o_orderkey % 97 = 1)::BIGINT AS missing_keys,
  count_if(o_orderkey % 103 = 3)::BIGINT AS extra_keys, count_if(o_orderkey % 97 <> 1 AND o_orderkey % 101 = 2)::BIGINT AS changed_rows FROM orders"""


# -- R5 -------------------------------------------------------------------------------------------
def migrate_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A joined source, kept while it is profiled and written."""
    st = _store(spark)
    name = unique_name("priced")
    priced = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    m = TableMapping.of("priced", name, ORDERS_PK, ORDERS_CK)
    rep = migrate_table_job(spark, lambda _: priced, m, st, PlanSettings(enable_cache=True), RunOptions(profile="exact", reconcile=True))
    assert rep.status == "ok" and rep.rows_read == rep.rows_written, rep
    return st.read(name).select("o_orderkey", "o_custkey", "o_totalprice", "c_mktsegment")


SQL_MIGRATE_CACHED = "SELECT o_orderkey, o_custkey, o_totalprice, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "keyed_upsert": keyed_upsert,
    "keyed_upsert_two_batches": keyed_upsert_two_batches,
    "keyed_overwrite": keyed_overwrite,
    "folder_feed_upsert": folder_feed_upsert,
    "upsert_idempotent": upsert_idempotent,
    "keyed_rollback": keyed_rollback,
    "keyed_compact": keyed_compact,
    "keyed_scan": keyed_scan,
    "keyed_table_layout": keyed_table_layout,
    "conform_reference": conform_reference,
    "conform_exact": conform_exact,
    "key_null_counts": key_null_counts,
    "duplicate_keys": duplicate_keys,
    "partition_plan": partition_plan,
    "key_locality": key_locality,
    "balanced_partitions": balanced_partitions,
    "row_count_audit": row_count_audit,
    "migrate_table": migrate_table,
    "migrate_exact": migrate_exact,
    "migrate_report": migrate_report,
    "reconcile": reconcile_check,
    "line_amount": line_amount,
    "foreign_key_orphans": foreign_key_orphans,
    "csv_inferred_scan": csv_inferred_scan,
    "csv_declared_scan": csv_declared_scan,
    "csv_folder_counts": csv_folder_counts,
    "csv_folder_load": csv_folder_load,
    "gen_customers": gen_customers,
    "gen_draw_independence": gen_draw_independence,
    "keyed_layout_order": keyed_layout_order,
    "keyed_lookup": keyed_lookup,
    "coalesced_partitions": coalesced_partitions,
    "csv_text_roundtrip": csv_text_roundtrip,
    "migrate_one_target": migrate_one_target,
    "gen_products": gen_products,
    "gen_orders": gen_orders,
    "gen_order_details": gen_order_details,
    "csv_rejects": csv_rejects,
    "conform_rejects": conform_rejects,
    "key_balance": key_balance,
    "connector_grouping": connector_grouping,
    "split_ranges": split_ranges,
    "partition_plan_by_size": partition_plan_by_size,
    "migrate_dependencies": migrate_dependencies,
    "key_sketches": key_sketches,
    "reconcile_differences": reconcile_differences,
    "migrate_cached": migrate_cached,
}

ORACLE_SQL: dict[str, str] = {
    "keyed_upsert": SQL_KEYED_UPSERT,
    "keyed_upsert_two_batches": SQL_KEYED_UPSERT_TWO_BATCHES,
    "keyed_overwrite": SQL_KEYED_OVERWRITE,
    "folder_feed_upsert": SQL_FOLDER_FEED_UPSERT,
    "upsert_idempotent": SQL_UPSERT_IDEMPOTENT,
    "keyed_rollback": SQL_KEYED_ROLLBACK,
    "keyed_compact": SQL_KEYED_COMPACT,
    "keyed_scan": SQL_KEYED_SCAN,
    "keyed_table_layout": SQL_KEYED_TABLE_LAYOUT,
    "conform_reference": SQL_CONFORM_REFERENCE,
    "conform_exact": SQL_CONFORM_EXACT,
    "key_null_counts": SQL_KEY_NULL_COUNTS,
    "duplicate_keys": SQL_DUPLICATE_KEYS,
    "partition_plan": SQL_PARTITION_PLAN,
    "key_locality": SQL_KEY_LOCALITY,
    "balanced_partitions": SQL_BALANCED_PARTITIONS,
    "row_count_audit": SQL_ROW_COUNT_AUDIT,
    "migrate_table": SQL_MIGRATE_TABLE,
    "migrate_exact": SQL_MIGRATE_EXACT,
    "migrate_report": SQL_MIGRATE_REPORT,
    "reconcile": SQL_RECONCILE,
    "line_amount": SQL_LINE_AMOUNT,
    "foreign_key_orphans": SQL_FOREIGN_KEY_ORPHANS,
    "csv_inferred_scan": SQL_CSV_INFERRED_SCAN,
    "csv_declared_scan": SQL_CSV_DECLARED_SCAN,
    "csv_folder_counts": SQL_CSV_FOLDER_COUNTS,
    "csv_folder_load": SQL_CSV_FOLDER_LOAD,
    "gen_customers": SQL_GEN_CUSTOMERS,
    "gen_draw_independence": SQL_GEN_DRAW_INDEPENDENCE,
    "keyed_layout_order": SQL_KEYED_LAYOUT_ORDER,
    "keyed_lookup": SQL_KEYED_LOOKUP,
    "coalesced_partitions": SQL_COALESCED_PARTITIONS,
    "csv_text_roundtrip": SQL_CSV_TEXT_ROUNDTRIP,
    "migrate_one_target": SQL_MIGRATE_ONE_TARGET,
    "gen_products": SQL_GEN_PRODUCTS,
    "gen_orders": SQL_GEN_ORDERS,
    "gen_order_details": SQL_GEN_ORDER_DETAILS,
    "csv_rejects": SQL_CSV_REJECTS,
    "conform_rejects": SQL_CONFORM_REJECTS,
    "key_balance": SQL_KEY_BALANCE,
    "connector_grouping": SQL_CONNECTOR_GROUPING,
    "split_ranges": SQL_SPLIT_RANGES,
    "partition_plan_by_size": SQL_PARTITION_PLAN_BY_SIZE,
    "migrate_dependencies": SQL_MIGRATE_DEPENDENCIES,
    "key_sketches": SQL_KEY_SKETCHES,
    "reconcile_differences": SQL_RECONCILE_DIFFERENCES,
    "migrate_cached": SQL_MIGRATE_CACHED,
}
