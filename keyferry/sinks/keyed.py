"""A partition-keyed store on Spark tables.

A keyspace is a catalog database; a keyed table is a parquet table
``CLUSTERED BY (partition key) SORTED BY (partition key, clustering keys)``.
Bucketing gives the store's layout: every row of a partition key sits in one
bucket, in clustering order, so a point read prunes to one bucket and a
``groupBy`` on the partition key needs no shuffle.

Writes are copy-on-write versions. Each write produces a new folder
``<root>/<table>/v-<id>`` through a staging table, and only when it is
complete is the table pointed at it (``ALTER TABLE ... SET LOCATION``). A
failed or lost job therefore leaves the table as it was, and a re-run is
safe: upserts are idempotent.

Save modes follow the keyed-store connector: ``append`` upserts (the default),
``overwrite`` replaces the whole table and needs ``confirm_truncate``,
``ignore`` leaves an existing table alone, ``error`` refuses one. An existing
table keeps its definition (schema, keys, buckets); incoming rows are cast to
it.

One writer per table at a time: two concurrent writes each produce a version,
and the later ``SET LOCATION`` wins.

A session's catalog may be in memory, so each write also records the current
version and the layout beside the data (``<root>/<table>/state``). A session
whose catalog does not know the table, or knows an older version, attaches the
recorded one before it reads or writes. A folder that holds versions but no
record is refused, never written over.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyferry.operators.audit import DIGEST, digest_columns, row_hash
from keyferry.operators.keys import dedupe, distinct_estimate, key_sketch, refuse_map_keys, require_keys, row_bytes, surviving_rows
from keyferry.operators.layout import bucket_aligned
from keyferry.session import fresh_path, remove_path, unique_name
from keyferry.sources.files import reads_files_only

MODES = ("append", "overwrite", "ignore", "error", "errorifexists")

_PK = "keyferry.partition_key"
_CK = "keyferry.clustering_keys"

# Of a batch under way: source rows of a key, and their bytes.
_ROWS, _BYTES = "__kf_rows", "__kf_bytes"


class TableExistsError(RuntimeError):
    pass


class TruncateNotConfirmedError(RuntimeError):
    pass


class SchemaMismatchError(ValueError):
    pass


class UnrecordedDataError(RuntimeError):
    """The table's folder holds versions, but neither catalog nor record knows them."""


def align_to(df: DataFrame, schema) -> DataFrame:
    """``df`` with exactly the columns (names, order, types) of ``schema``.

    New versions of a table must carry the catalog's schema. Values are cast
    (under ANSI rules a value that does not fit raises); missing or extra
    columns are refused.
    """
    have = {c.lower(): c for c in df.columns}
    want = [f.name.lower() for f in schema.fields]
    missing = sorted(set(want) - set(have))
    extra = sorted(set(have) - set(want))
    if missing or extra:
        raise SchemaMismatchError(f"columns missing {missing}, not in table {extra}")
    return df.select(*[F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass(frozen=True)
class StagedBatch:
    """What was counted while a version was written, before it is published."""

    rows_read: int  # rows of the batch, all copies of a key
    batch_keys: int  # rows of the batch that were written, one per key
    null_cells: Mapping[str, int]  # per key column, over rows_read
    bytes_read: int  # estimated size of the batch
    distinct_keys: int | None  # estimate for a batch declared unique
    key_sketch: bytes | None  # of all keys of the version
    digest: tuple[int, ...]  # of all rows of the version (operators.audit)


@dataclass(frozen=True)
class WriteResult:
    table: str
    mode: str
    rows_written: int | None
    location: str | None
    skipped: bool = False
    created: bool = False
    buckets: int | None = None
    batch: StagedBatch | None = None


# File times come from the storage system's clock, version names from the
# driver's: allow this much disagreement before a version counts as newer.
_CLOCK_SKEW_MS = 10 * 60 * 1000


def _version_time(location: str) -> int | None:
    """Write time (epoch ms) carried by a version folder's name."""
    m = re.search(r"/v-([0-9]{13})-[0-9a-f]+/?$", location)
    return int(m.group(1)) if m else None


def _path_missing(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e)


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


class KeyedStore:
    """Keyed tables of one keyspace (catalog database)."""

    # Layout comes from the bucket count, not from the R1 partition plan.
    applies_plan = False

    def __init__(self, spark: SparkSession, keyspace: str, root: str | None = None):
        self.spark = spark
        self.keyspace = keyspace
        self.root = (root or fresh_path(spark, f"store-{keyspace}")).rstrip("/")

    # -- K5 / K6 -----------------------------------------------------------------
    def create_keyspace(self, properties: Mapping[str, str] | None = None) -> None:
        """Create the keyspace (a database located at the store's root) unless
        it exists. Its tables are external, with their own version folders."""
        props = ""
        if properties:
            kv = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
            props = f" WITH DBPROPERTIES ({kv})"
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {_ident(self.keyspace)} LOCATION '{self.root}'{props}"
        )

    def qualified(self, table: str) -> str:
        return f"{self.keyspace}.{table}"

    def exists(self, table: str) -> bool:
        """K6. A table that only its record knows is attached first."""
        return self.spark.catalog.tableExists(self.qualified(table)) or self.attach(table)

    # -- the record beside the data ---------------------------------------------
    def _record(self, table: str, location: str, batch: StagedBatch | None = None) -> None:
        """Note ``location``, the layout and what is known of the keys as current: one
        small text folder, never changed."""
        layout = self.describe(table)
        now = f"{int(time.time() * 1000):013d}"
        state = {"time": now, "location": location, "partition_key": layout["partition_key"],
                 "clustering_keys": layout["clustering_keys"], "buckets": layout["buckets"],
                 "schema": self.spark.table(self.qualified(table)).schema.jsonValue()}
        if batch is not None:
            state |= {"rows": batch.digest[0], "key_sketch": batch.key_sketch.hex() if batch.key_sketch else None}
        line = self.spark.createDataFrame([(json.dumps(state),)], "value string")
        line.coalesce(1).write.text(f"{self.root}/{table}/state/{now}-{uuid.uuid4().hex[:8]}")

    def recorded(self, table: str) -> dict | None:
        """The newest record (its text begins with its time), or None."""
        try:
            states = self.spark.read.option("recursiveFileLookup", "true").text(f"{self.root}/{table}/state")
        except AnalysisException as e:
            if _path_missing(e):
                return None
            raise
        newest = states.agg(F.max("value")).first()[0]
        return json.loads(newest) if newest else None

    def attach(self, table: str) -> bool:
        """Make the session's catalog show the recorded version. False when
        nothing is recorded; refuses versions without a record."""
        state = self.recorded(table)
        present = self.spark.catalog.tableExists(self.qualified(table))
        if state is None:
            if not present and self._holds_versions(table):
                raise UnrecordedDataError(
                    f"{self.root}/{table} holds data that neither the catalog nor a record knows: "
                    "move it away, or register it in the catalog"
                )
            return present
        q = _ident(self.qualified(table))
        if present:
            own = re.sub(r"^file:/*", "/", self.describe(table)["location"].rstrip("/"))
            if own != re.sub(r"^file:/*", "/", state["location"].rstrip("/")):
                self.spark.sql(f"ALTER TABLE {q} SET LOCATION '{state['location']}'")
                self.spark.sql(f"REFRESH TABLE {q}")
            return True
        ticked = lambda cols: ", ".join(f"`{c}`" for c in cols)
        columns = T.StructType.fromJson(state["schema"]).toDDL()
        self.create_keyspace()
        self.spark.sql(
            f"CREATE TABLE {q} ({columns}) USING parquet "
            f"CLUSTERED BY ({ticked(state['partition_key'])}) "
            f"SORTED BY ({ticked(state['partition_key'] + state['clustering_keys'])}) INTO {state['buckets']} BUCKETS "
            f"LOCATION '{state['location']}' TBLPROPERTIES "
            f"('{_PK}' = '{','.join(state['partition_key'])}', '{_CK}' = '{','.join(state['clustering_keys'])}')"
        )
        return True

    def _holds_versions(self, table: str) -> bool:
        try:
            return bool(self._versions(table))
        except AnalysisException as e:
            if _path_missing(e):
                return False
            raise

    # -- K4 -----------------------------------------------------------------------
    def describe(self, table: str) -> dict:
        """Key layout of an existing keyed table, from its properties."""
        props = {
            r["key"]: r["value"]
            for r in self.spark.sql(f"SHOW TBLPROPERTIES {_ident(self.qualified(table))}").collect()
        }
        detail = {
            r["col_name"]: r["data_type"]
            for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(self.qualified(table))}").collect()
        }
        split = lambda s: tuple(x for x in (s or "").split(",") if x)
        return {
            "partition_key": split(props.get(_PK)),
            "clustering_keys": split(props.get(_CK)),
            "buckets": int(detail["Num Buckets"]) if "Num Buckets" in detail else None,
            "location": detail.get("Location"),
        }

    def create_table(
        self,
        table: str,
        df: DataFrame,
        partition_key: Sequence[str],
        clustering_keys: Sequence[str] = (),
        buckets: int = 1,
    ) -> bool:
        """Create an empty keyed table shaped like ``df`` unless it exists.

        Returns True when a table was created.
        """
        if self.exists(table):
            return False
        self._write_version(
            bucket_aligned(df.limit(0), buckets, partition_key), table, partition_key, clustering_keys, buckets,
            replace=False,
        )
        return True

    # -- versions -----------------------------------------------------------------
    def versions(self, table: str) -> list[str]:
        """Version folders of ``table`` that still hold data, oldest first."""
        return [v for v, _ in self._versions(table)]

    def _versions(self, table: str) -> list[tuple[str, object]]:
        """(version folder, start time) of ``table``, oldest first: the start
        time from the folder name, else the newest file's time.

        A version holds data while it has bucket files (names carry the
        bucket id, ``..._00003.c000...parquet``). File names and times are
        listed in Spark (no content read); one row per version comes back.
        """
        files = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(f"{self.root}/{table}")
            .filter(F.col("path").rlike(r"_[0-9]{5}\.c[0-9]+[^/]*\.parquet$"))
            .select(
                F.regexp_extract("path", r"^(.*/v-[0-9a-f-]+)/[^/]+$", 1).alias("v"),
                "modificationTime",
            )
            .filter(F.col("v") != "")
            .groupBy("v")
            .agg(F.max("modificationTime").alias("t"))
        )
        rows = files.collect()
        self._last_file_ms = {r["v"]: r["t"].timestamp() * 1000 for r in rows}
        found = [(r["v"], _version_time(r["v"]) or self._last_file_ms[r["v"]]) for r in rows]
        return sorted(found, key=lambda vt: (vt[1], vt[0]))

    def rollback(self, table: str, location: str) -> None:
        """Point ``table`` back at an earlier version folder, one that ``versions`` lists."""
        bare = lambda p: re.sub(r"^file:/*", "/", p.rstrip("/"))
        if bare(location) not in {bare(v) for v in self.versions(table)}:
            raise ValueError(f"{location} is not a version of {table} that holds data")
        q = _ident(self.qualified(table))
        self.spark.sql(f"ALTER TABLE {q} SET LOCATION '{location}'")
        self.spark.sql(f"REFRESH TABLE {q}")
        self._record(table, location)

    def vacuum(self, table: str, keep: int = 1) -> list[str]:
        """Empty old versions, keeping the current one and the ``keep - 1``
        newest before it. A version is emptied only if it started, and its
        last file was written (within a clock-skew allowance of 10 minutes),
        before the current version started: a folder still being written is
        spared. Run it under the table's one-writer
        rule (not while a write to the table is in progress). Files are
        removed by Spark's own overwrite of each old folder with an empty
        frame. Returns the emptied folders."""
        if keep < 1:
            raise ValueError("keep must be >= 1")
        current = self.describe(table)["location"].rstrip("/")
        listed = self._versions(table)
        current_time = _version_time(current) or next((t for v, t in listed if v.rstrip("/") == current), None)
        if current_time is None:
            return []
        old = [
            v for v, t in listed
            if v.rstrip("/") != current and t < current_time
            and self._last_file_ms.get(v, 0) < current_time + _CLOCK_SKEW_MS
        ]
        drop = old[: max(0, len(old) - (keep - 1))]
        empty = self.spark.createDataFrame([], "x int")
        for v in drop:
            empty.coalesce(1).write.mode("overwrite").parquet(v)
        return drop

    def compact(self, table: str) -> str:
        """Rewrite ``table`` as one file per bucket (a new version).

        Small-batch upserts add up to one file per bucket each; this folds
        them back with one bucket-aligned shuffle (AQE still splits a hot
        bucket). Returns the new version's folder.
        """
        layout = self.describe(table)
        df = bucket_aligned(self.read(table, bucketed=False), layout["buckets"], layout["partition_key"])
        return self._write_version(
            df, table, layout["partition_key"], layout["clustering_keys"], layout["buckets"], replace=True
        )

    # -- S3 / U3 ------------------------------------------------------------------
    def read(self, table: str, bucketed: bool = True) -> DataFrame:
        """The table. ``bucketed=False`` reads the same files as a plain
        parquet folder: no bucket layout is promised, so the scan is split by
        file size and a hot bucket is spread over many tasks (partial
        aggregation then combines it map-side) instead of one task per bucket.
        """
        if not self.spark.catalog.tableExists(self.qualified(table)):
            self.attach(table)
        if bucketed:
            return self.spark.table(self.qualified(table))
        return self.spark.read.schema(self.spark.table(self.qualified(table)).schema).parquet(
            self.describe(table)["location"]
        )

    def lookup(
        self,
        table: str,
        ranges: Mapping[str, tuple[object, object]] | None = None,
        ordered: bool = False,
        **equal,
    ) -> DataFrame:
        """Point, prefix or range read.

        ``equal`` gives key columns by value; with the whole partition key
        given, the scan is pruned to one bucket. ``ranges`` adds closed
        ranges ``(low, high)`` on clustering columns (either end may be None).
        All conditions are pushed to the parquet scan. ``ordered`` returns the
        rows in key order (partition key, then clustering keys), as the store
        keeps them.
        """
        df = self.read(table)
        if ordered:
            layout = self.describe(table)
            order = [F.col(f"`{c}`") for c in layout["partition_key"] + layout["clustering_keys"]]
        for c, v in equal.items():
            df = df.filter(F.col(f"`{c}`") == F.lit(v))
        for c, (lo, hi) in (ranges or {}).items():
            if lo is not None:
                df = df.filter(F.col(f"`{c}`") >= F.lit(lo))
            if hi is not None:
                df = df.filter(F.col(f"`{c}`") <= F.lit(hi))
        return df.orderBy(*order) if ordered else df

    # -- K2 -----------------------------------------------------------------------
    def buckets_of(self, table: str) -> int | None:
        """Bucket count of an existing table (writes keep it), None without one."""
        return self.describe(table)["buckets"] if self.exists(table) else None

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
        plan: object = None,
        snapshot: bool | None = None,
        accept: Callable[[StagedBatch], bool] | None = None,
    ) -> WriteResult:
        """Write ``df`` with the store's key semantics.

        ``plan`` (the size-driven partition plan) is accepted for interface
        parity with external stores and not used: the layout here is set by
        the bucket count.

        ``unique=True`` states that keys of ``df`` are already unique (for
        example the source primary key is part of the target key), which
        saves the dedupe shuffle.

        An upsert reads the batch twice (its keys for the anti join, its rows
        for the new version). ``snapshot`` writes it to the shared work folder
        first, so that both reads see the same rows, and deletes it after the
        write; by default this is done unless every leaf of the batch's plan is
        a file scan.

        ``accept`` is asked when the new version is complete and before it is
        published. What it is shown was counted by the tasks that wrote the
        version, so the batch is not scanned for it. If it raises or returns
        False, the version is deleted and the table stays as it was, or absent.
        Without it, a NULL key cell fails the write.
        """
        mode = mode.lower()
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}; use one of {MODES}")
        key = tuple(partition_key) + tuple(clustering_keys)
        present = self.attach(table)  # the recorded version, not an older one of this session
        if present and mode in ("error", "errorifexists"):
            raise TableExistsError(self.qualified(table))
        if present and mode == "ignore":
            return WriteResult(
                self.qualified(table), mode, None, None, skipped=True, buckets=self.describe(table)["buckets"]
            )
        if present and mode == "overwrite" and not confirm_truncate:
            raise TruncateNotConfirmedError(
                f"overwrite of {self.qualified(table)} truncates it; pass confirm_truncate=True"
            )
        if present:
            # The table's own layout wins over the arguments: files of a new
            # version must carry the bucket spec the catalog entry declares.
            layout = self.describe(table)
            partition_key = layout["partition_key"] or tuple(partition_key)
            clustering_keys = layout["clustering_keys"]
            buckets = layout["buckets"] or buckets
            key = tuple(partition_key) + tuple(clustering_keys)
            df = align_to(df, self.read(table).schema)
        if accept is None:
            df = require_keys(df, key)
        else:
            refuse_map_keys(df, key)
        # Other sources than files (a live database table) may change between
        # the two reads of an upsert's batch, so they are read once, here.
        twice = present and mode == "append"
        taken = None
        if twice and (not reads_files_only(df) if snapshot is None else snapshot):
            taken = fresh_path(self.spark, f"batch-{table}")
            df.write.parquet(taken)
            df = self.spark.read.schema(df.schema).parquet(taken)
        counts = {} if accept is None else {_ROWS: F.lit(1).cast("bigint"), _BYTES: row_bytes(df)}
        obs = observation or Observation(unique_name("kf_write"))
        seen = None if accept is None else Observation(unique_name("kf_batch"))
        try:
            out = df.withColumns(counts) if unique else dedupe(df, key, order_by, counts)
            if twice:
                kept = surviving_rows(self.read(table), df, key)
                out = kept.withColumns({c: F.lit(0).cast("bigint") for c in counts}).unionByName(out)
            # One shuffle into the buckets for rows that stay and rows that come.
            out = bucket_aligned(out, buckets, partition_key)
            # Counted behind the last shuffle: there, a task that runs again counts once.
            out = out.observe(obs, F.count(F.lit(1)).alias("rows_written"))
            if seen is not None:
                out = out.observe(seen, *self._batch_counts(out, key, unique)).drop(*counts)
            location, staging = self._stage_version(out, table, partition_key, clustering_keys, buckets)
        finally:
            if taken:
                remove_path(self.spark, taken)
        batch, accepted = None, True
        if accept is not None:
            try:
                batch = self._batch(seen, key)
                accepted = accept(batch) is not False
            except Exception:
                self._discard(staging, location)
                raise
        if not accepted:
            self._discard(staging, location)
            return WriteResult(self.qualified(table), mode, 0, None, skipped=True, buckets=buckets, batch=batch)
        self._publish(table, staging, location, partition_key, clustering_keys, replace=present, batch=batch)
        return WriteResult(
            self.qualified(table), mode, obs.get.get("rows_written", 0), location, created=not present, buckets=buckets,
            batch=batch,
        )

    @staticmethod
    def _batch_counts(out: DataFrame, key: Sequence[str], unique: bool) -> list[Column]:
        """Aggregates over the rows of a version; rows that were there before have no weight."""
        zero = F.lit(0).cast("bigint")
        own = F.col(_ROWS) > 0
        whole = row_hash(out.drop(_ROWS, _BYTES))
        aggs = [
            F.coalesce(F.sum(_ROWS), zero).alias("rows_read"), F.count_if(own).alias("batch_keys"),
            F.coalesce(F.sum(_BYTES), zero).alias("bytes_read"), *digest_columns(whole),
        ]
        aggs += [F.coalesce(F.sum(F.when(F.col(f"`{k}`").isNull(), F.col(_ROWS))), zero).alias(f"null_{i}") for i, k in enumerate(key)]
        aggs.append(key_sketch(key).alias("key_sketch"))
        if unique:
            aggs.append(F.hll_sketch_estimate(key_sketch(key, own)).alias("distinct_keys"))
        return aggs

    @staticmethod
    def _batch(seen: Observation, key: Sequence[str]) -> StagedBatch:
        got = seen.get  # empty where Spark left out a plan that has no rows
        return StagedBatch(
            got.get("rows_read", 0), got.get("batch_keys", 0), {k: got.get(f"null_{i}", 0) for i, k in enumerate(key)},
            got.get("bytes_read", 0), got.get("distinct_keys"), bytes(got["key_sketch"]) if "key_sketch" in got else None, tuple(got.get(c, 0) for c in DIGEST))

    def _write_version(
        self,
        df: DataFrame,
        table: str,
        partition_key: Sequence[str],
        clustering_keys: Sequence[str],
        buckets: int,
        replace: bool,
    ) -> str:
        location, staging = self._stage_version(df, table, partition_key, clustering_keys, buckets)
        self._publish(table, staging, location, partition_key, clustering_keys, replace)
        return location

    def _stage_version(
        self, df: DataFrame, table: str, partition_key: Sequence[str], clustering_keys: Sequence[str], buckets: int
    ) -> tuple[str, str]:
        """Write a version that no table shows yet: (location, staging table)."""
        # The write time leads the folder name: versions order without listing.
        location = f"{self.root}/{table}/v-{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        staging = unique_name(f"{table}__staging")
        sort_cols = list(partition_key) + list(clustering_keys)
        (
            df.write.format("parquet")
            .bucketBy(buckets, *partition_key)
            .sortBy(*sort_cols)
            .option("path", location)
            .mode("errorifexists")
            .saveAsTable(self.qualified(staging))
        )
        return location, staging

    def _discard(self, staging: str, location: str) -> None:
        self.spark.sql(f"DROP TABLE {_ident(self.qualified(staging))}")  # external: files stay
        remove_path(self.spark, location)

    def _publish(
        self, table: str, staging: str, location: str, partition_key: Sequence[str], clustering_keys: Sequence[str], replace: bool,
        batch: StagedBatch | None = None,
    ) -> None:
        q_table = _ident(self.qualified(table))
        q_staging = _ident(self.qualified(staging))
        if replace:
            self.spark.sql(f"ALTER TABLE {q_table} SET LOCATION '{location}'")
            self.spark.sql(f"DROP TABLE {q_staging}")  # external: files stay
            self.spark.sql(f"REFRESH TABLE {q_table}")
        else:
            self.spark.sql(
                f"ALTER TABLE {q_staging} SET TBLPROPERTIES "
                f"('{_PK}' = '{','.join(partition_key)}', '{_CK}' = '{','.join(clustering_keys)}')"
            )
            self.spark.sql(f"ALTER TABLE {q_staging} RENAME TO {q_table}")
        self._record(table, location, batch)

    def key_summary(self, table: str) -> dict | None:
        """rows, keys (an estimate) and key_sketch of the current version, from its record alone;
        None if its write was not counted (no ``accept``)."""
        state = self.recorded(table)
        if not state or not state.get("key_sketch"):
            return None
        sketch = bytes.fromhex(state["key_sketch"])
        return {"rows": state["rows"], "keys": distinct_estimate(self.spark, sketch), "key_sketch": sketch}
