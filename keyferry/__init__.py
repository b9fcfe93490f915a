"""keyferry: move tables into partition-keyed storage with Spark.

The main entry points, re-exported:

- ``TableMapping``, ``PlanSettings``, ``RunOptions``: what to migrate and how;
- ``KeyedStore``: keyed tables on bucketed parquet (write, read, lookup, versions);
- ``ConnectorStore``: the same interface through an external connector;
- ``migrate_table``, ``migrate_all``, ``report_frame``: the jobs and their report;
- ``conform``, ``dedupe``, ``upsert``, ``reconcile``: the operators they use.
"""

from keyferry.operators.audit import reconcile, row_counts
from keyferry.operators.conform import conform
from keyferry.operators.keys import dedupe, duplicate_keys, null_key_counts, upsert
from keyferry.plans.migrate import migrate_all, migrate_table, report_frame
from keyferry.plans.partition_plan import plan_partitions
from keyferry.sinks.connector import ConnectorStore
from keyferry.sinks.keyed import KeyedStore
from keyferry.spec import PlanSettings, RunOptions, TableMapping

__all__ = [
    "ConnectorStore",
    "KeyedStore",
    "PlanSettings",
    "RunOptions",
    "TableMapping",
    "conform",
    "dedupe",
    "duplicate_keys",
    "migrate_all",
    "migrate_table",
    "null_key_counts",
    "plan_partitions",
    "reconcile",
    "report_frame",
    "row_counts",
    "upsert",
]
