"""K2/K3 through an external keyed-store connector (a Spark data source).

The store itself applies key semantics (a write with an existing key replaces
the row), so this path only conforms, lays rows out by partition key and
passes options through. Tuning options (rows or bytes per batch, concurrent
writes, throughput cap, batch grouping key) use the connector's own option
names and are set only when given a value. The connector's format name is an
argument: none is bundled here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keyferry.operators.keys import dedupe, require_keys
from keyferry.operators.layout import apply_plan, cluster_order
from keyferry.plans.partition_plan import PartitionPlan
from keyferry.session import unique_name
from keyferry.sinks.keyed import MODES, TruncateNotConfirmedError, WriteResult



def connector_options(
    keyspace: str, table: str, tuning: Mapping[str, object] | None = None, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    o = {"keyspace": keyspace, "table": table}
    for k, v in (tuning or {}).items():
        if v is None:
            continue
        o[k] = str(v)
    o.update({k: str(v) for k, v in (extra or {}).items()})
    return o


def read_table(spark: SparkSession, fmt: str, keyspace: str, table: str) -> DataFrame:
    """S3 through the connector; key filters are pushed down by it."""
    return spark.read.format(fmt).options(keyspace=keyspace, table=table).load()


def write_table(
    df: DataFrame,
    fmt: str,
    keyspace: str,
    table: str,
    partition_key: Sequence[str] = (),
    mode: str = "append",
    confirm_truncate: bool = True,
    plan: PartitionPlan | None = None,
    tuning: Mapping[str, object] | None = None,
    clustering_keys: Sequence[str] = (),
    spread_hot_keys: bool = False,
    observation: Observation | None = None,
    balance_heavy_keys: bool = False,
) -> None:
    """``spread_hot_keys`` lays rows out by partition and clustering keys, so a
    partition key with many rows leaves from many tasks. ``balance_heavy_keys``
    spreads only the partition keys that are too large for one task, so rows of
    every other key still leave together (the connector's grouping by partition
    key stays as good as it was). ``observation`` counts the rows after the
    layout, in the stage that writes them."""
    mode = mode.lower()
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {MODES}")
    opts = connector_options(keyspace, table, tuning)
    if mode == "overwrite":
        if not confirm_truncate:
            raise TruncateNotConfirmedError(f"overwrite of {keyspace}.{table} truncates it")
        opts["confirm.truncate"] = "true"
    layout = list(partition_key) + (list(clustering_keys) if spread_hot_keys else [])
    out = apply_plan(df, plan, layout, balance_heavy_keys) if plan else df
    if plan is not None and plan.action == "repartition" and plan.by_key and partition_key:
        # Rows of one partition key leave a task together, in key order,
        # so the connector can group them into per-partition batches.
        out = cluster_order(out, partition_key, clustering_keys)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows_written"))
    out.write.format(fmt).mode(mode).options(**opts).save()


class ConnectorStore:
    """Keyed tables behind an external connector, with the same write
    interface as ``KeyedStore`` so the migration jobs can target either.

    The store resolves equal keys itself (the later write wins); rows of one
    batch are deduplicated first (U1) so that which row wins is decided here,
    repeatably, and not by the order of concurrent writes. The layout is the
    size-driven partition plan (R1), by partition key, so rows of one key
    leave from one task and the connector can group them into batches.
    """

    # Rows are laid out by the R1 partition plan before the connector writes.
    applies_plan = True

    def __init__(self, spark: SparkSession, fmt: str, keyspace: str, tuning: Mapping[str, object] | None = None,
                 spread_hot_keys: bool = False, balance_heavy_keys: bool = False):
        self.spread_hot_keys = spread_hot_keys
        self.balance_heavy_keys = balance_heavy_keys
        self.spark = spark
        self.fmt = fmt
        self.keyspace = keyspace
        self.tuning = dict(tuning or {})

    def create_keyspace(self, properties: Mapping[str, str] | None = None) -> None:
        """Keyspaces of an external store are made with its own tools."""

    def qualified(self, table: str) -> str:
        return f"{self.keyspace}.{table}"

    def exists(self, table: str) -> bool:
        """Resolving the relation is the test. Only an answer that says the
        table is not there counts as absent; a network or login failure is raised."""
        try:
            self.read(table).schema  # noqa: B018
            return True
        except Exception as e:
            if any(x in str(e).lower() for x in ("not found", "not_found", "does not exist", "couldn't find", "unconfigured table")):
                return False
            raise

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.fmt, self.keyspace, table)

    def write(
        self,
        df: DataFrame,
        table: str,
        partition_key: Sequence[str],
        clustering_keys: Sequence[str] = (),
        mode: str = "append",
        buckets: int = 1,
        order_by: Sequence[str] = (),
        confirm_truncate: bool = True,
        unique: bool = False,
        observation: Observation | None = None,
        plan: PartitionPlan | None = None,
    ) -> WriteResult:
        key = tuple(partition_key) + tuple(clustering_keys)
        df = require_keys(df, key)
        out = df if unique else dedupe(df, key, order_by)
        if mode.lower() == "ignore":
            # The connector may skip the write (table exists): nothing to observe.
            write_table(out, self.fmt, self.keyspace, table, partition_key, mode, confirm_truncate, plan, self.tuning,
                        clustering_keys, self.spread_hot_keys, None, self.balance_heavy_keys)
            return WriteResult(self.qualified(table), mode, None, None)
        obs = observation or Observation(unique_name("kf_connector"))
        write_table(out, self.fmt, self.keyspace, table, partition_key, mode, confirm_truncate, plan, self.tuning,
                    clustering_keys, self.spread_hot_keys, obs, self.balance_heavy_keys)
        # Whether the external table already held rows is not known here.
        return WriteResult(self.qualified(table), mode, obs.get.get("rows_written", 0), None, created=False)


def merge_into(batch: DataFrame, table: str, key: Sequence[str], order_by: Sequence[str] = ()) -> None:
    """U2 on a table whose format has row-level operations: rows of ``batch`` replace
    those with the same key, others are added, and only files with such rows are
    rewritten.

    ``table`` is a catalog table of a data source that supports MERGE; Spark's own
    file tables do not. No such format is at hand here, so the call is tested, the
    write itself is not.
    """
    batch = require_keys(batch, key)
    own, target = "__kf_batch", table.rsplit(".", 1)[-1]
    same = reduce(lambda a, b: a & b, [F.col(f"`{target}`.`{k}`") == F.col(f"{own}.`{k}`") for k in key])
    merge = dedupe(batch, key, order_by).alias(own).mergeInto(table, same)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


class MergeStore(ConnectorStore):
    """Keyed tables of a catalog whose format supports MERGE (row-level operations).

    ``append`` becomes a merge, so a small batch does not rewrite the table; a
    table that is not there, and the other modes, go through ``saveAsTable``.
    """

    applies_plan = False

    def __init__(self, spark: SparkSession, fmt: str, keyspace: str):
        super().__init__(spark, fmt, keyspace)

    def create_keyspace(self, properties: Mapping[str, str] | None = None) -> None:
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {self.keyspace}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.qualified(table))

    def write(self, df: DataFrame, table: str, partition_key: Sequence[str], clustering_keys: Sequence[str] = (),
              mode: str = "append", order_by: Sequence[str] = (), confirm_truncate: bool = True, unique: bool = False,
              **_: object) -> WriteResult:
        mode = mode.lower()
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}; use one of {MODES}")
        name, key = self.qualified(table), tuple(partition_key) + tuple(clustering_keys)
        present = self.exists(table)
        if present and mode == "overwrite" and not confirm_truncate:
            raise TruncateNotConfirmedError(f"overwrite of {name} truncates it")
        if present and mode == "append":
            merge_into(df, name, key, order_by)
            return WriteResult(name, mode, None, None)
        out = require_keys(df, key) if unique else dedupe(require_keys(df, key), key, order_by)
        out.write.format(self.fmt).mode(mode).saveAsTable(name)
        return WriteResult(name, mode, None, None, skipped=present and mode == "ignore", created=not present)
