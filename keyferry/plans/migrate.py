"""M1 migrate one table, M2 migrate many with failures isolated.

Per table:

1. define the source scan (lazy) and the conform projection (schema only:
   an unsupported type fails before anything is read);
2. plan partitions (R1) and the bucket count, if the target has none yet, from
   sizes that cost no scan: a count the caller knows, or the file metadata of a
   plain file source. Any other source (a database, a join) is copied to the
   shared folder once, counted on the way, and the copy is used from there on;
3. write the conformed rows (P1) with keyed semantics (U1/U2, K2) as a new
   bucketed version that no table shows yet. The tasks that write it count the
   batch's rows, bytes and NULL key cells (A1, V1), its distinct keys and the
   digest of the version;
4. publish the version only if those counts pass: an empty source makes no table
   (F1), a NULL key cell or a source key that is not unique fails it (V1);
5. optionally reconcile (A3): the table read back must have the digest of what
   was written; only if not is the source compared with it key by key;
6. one report row: status, counts, plan, timings (A2).

So the content of a source is read once. An external store cannot take a
write back, so its batches are checked (key columns only) before they are sent.
With ``enable_cache`` (R5) a profile job fills a cache that the write reads.
"""

from __future__ import annotations

import contextlib
import graphlib
import logging
import threading
import time
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyferry.operators.audit import digest
from keyferry.operators.audit import reconcile as reconcile_frames
from keyferry.operators.conform import conform, fitting, refused_values, try_types
from keyferry.operators.keys import profile_keys, repeated_rows, row_bytes
from keyferry.operators.layout import keep, release
from keyferry.plans.partition_plan import bucket_count, plan_partitions
from keyferry.session import fresh_path, remove_path, unique_name
from keyferry.sinks.keyed import KeyedStore, StagedBatch
from keyferry.sources.files import file_totals, plain_files, reads_files_only
from keyferry.spec import MappingError, PlanSettings, RunOptions, TableMapping


log = logging.getLogger("keyferry.migrate")


class NullKeyError(ValueError):
    pass


class RepeatedKeyError(ValueError):
    """A source key that was declared unique is not."""


# A sketch of 2**14 registers has a relative error of 0.8 %: six times that, and a key that is
# unique is not refused by chance. Fewer repeats than that show in the reconciliation.
KEY_SKETCH_ERROR = 0.05


REPORT_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("target", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows_read", T.LongType(), True),
        T.StructField("rows_written", T.LongType(), True),
        T.StructField("plan_action", T.StringType(), True),
        T.StructField("plan_partitions", T.LongType(), True),
        T.StructField("buckets", T.LongType(), True),
        T.StructField("missing_keys", T.LongType(), True),
        T.StructField("extra_keys", T.LongType(), True),
        T.StructField("changed_rows", T.LongType(), True),
        T.StructField("values_refused", T.LongType(), True),
        T.StructField("error_class", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
        T.StructField("read_s", T.DoubleType(), True),
        T.StructField("write_s", T.DoubleType(), True),
        T.StructField("total_s", T.DoubleType(), True),
        T.StructField("rows_per_s", T.DoubleType(), True),
    ]
)


@dataclass
class TableReport:
    source: str
    target: str
    status: str = "pending"
    rows_read: int | None = None
    rows_written: int | None = None
    plan_action: str | None = None
    plan_partitions: int | None = None
    buckets: int | None = None
    missing_keys: int | None = None
    extra_keys: int | None = None
    changed_rows: int | None = None
    values_refused: int | None = None
    error_class: str | None = None
    error: str | None = None
    read_s: float | None = None
    write_s: float | None = None
    total_s: float | None = None
    rows_per_s: float | None = None


# Rows per shuffle partition above which a dedupe shuffle risks heavy spill.
MAX_ROWS_PER_SHUFFLE_PARTITION = 20_000_000


def _check_shuffle_width(spark: SparkSession, rows: int, mapping: TableMapping) -> None:
    """Warn when the session's shuffle width is too small for this table.

    The dedupe shuffle takes its partition count from the session (adaptive
    execution merges small partitions but does not split large, even ones),
    so the count must be sized to the data; the job does not change session
    settings itself, as tables may run in parallel on one session.
    """
    if mapping.key_is_unique_by_source():
        return  # no dedupe shuffle; the write's rebalance is split by AQE
    conf = spark.conf
    width = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get(
        "spark.sql.shuffle.partitions", "200"
    )
    try:
        width = int(width)
    except ValueError:  # e.g. "auto" on some platforms
        return
    if width > 0 and rows / width > MAX_ROWS_PER_SHUFFLE_PARTITION:
        need = -(-rows // MAX_ROWS_PER_SHUFFLE_PARTITION)
        log.warning(
            "%s: %d rows over %d shuffle partitions; set "
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum to at least %d "
            "(adaptive execution merges the small ones)",
            mapping.source, rows, width, need,
        )


def _num_partitions(df: DataFrame) -> int:
    """Partitions of the source. Free for a plain scan; for a derived source
    (join, aggregate) adaptive execution runs its shuffle stages to answer, so
    it is asked only when the plan is applied. Unknown (0) where the RDD view
    is not implemented (Spark Connect); the coalesce rule then does not fire.
    Any other failure is the source's own and is raised."""
    try:
        return df.rdd.getNumPartitions()
    except PySparkNotImplementedError:
        return 0


def migrate_table(
    spark: SparkSession,
    reader: Callable[[str], DataFrame],
    mapping: TableMapping,
    store: KeyedStore,
    settings: PlanSettings | None = None,
    options: RunOptions | None = None,
    known_rows: int | None = None,
) -> TableReport:
    """M1. ``store`` is a ``KeyedStore`` or any store with the same write
    interface (``sinks.connector.ConnectorStore``)."""
    settings = settings or PlanSettings()
    options = options or RunOptions()
    rep = TableReport(mapping.source, store.qualified(mapping.target))
    t0 = time.perf_counter()
    df = reader(mapping.source)
    mapping.validate(df.columns)
    # With caching on, the profile job fills the cache and the write reads
    # it, so the source (e.g. a database) is scanned once instead of twice.
    df = keep(df, settings.enable_cache)
    try:
        return _migrate(rep, t0, df, mapping, store, settings, options, known_rows)
    finally:
        release(df, settings.enable_cache)


def _file_sizes(df: DataFrame) -> tuple[int, int] | None:
    """(rows, bytes) of a source that is a plain scan of Parquet or ORC files, from
    file metadata alone; None for any other source."""
    if not plain_files(df):
        return None
    got = file_totals(df).first()
    return int(got["rows"]), int(got["bytes"])


@dataclass
class _Source:
    """A table's rows, and what is known of them before they are written."""

    df: DataFrame  # conformed
    rows: int | None = None
    bytes: int | None = None
    nulls: dict[str, int] = field(default_factory=dict)
    copy: str | None = None  # folder of the copy, to be removed


def _measured(df: DataFrame, mapping: TableMapping, store, settings: PlanSettings, options: RunOptions, known_rows: int | None) -> _Source:
    # Schema-only: an unsupported column type fails here, before any scan.
    src = _Source(conform(df, options.profile), known_rows)
    external = getattr(store, "applies_plan", False)
    if options.rejects and not external and store.exists(mapping.target) and not reads_files_only(df):
        return _copied(src, mapping)  # refused rows and the others must come from the same reading
    if known_rows is not None:
        return src
    if settings.enable_cache or (external and plain_files(df)):
        by_bytes = bool(settings.target_bucket_bytes)
        prof = profile_keys(df, mapping.key, with_bytes=by_bytes).first()
        src.rows, src.bytes = int(prof["rows"]), int(prof["bytes"]) if by_bytes else None
        src.nulls = {k: int(prof[f"null_{k}"]) for k in mapping.key}
        return src
    if not external and (mapping.buckets or store.exists(mapping.target)):
        return src  # the layout is given; the write counts the rest
    sizes = _file_sizes(df)
    if sizes is not None:
        src.rows, src.bytes = sizes
        return src
    return _copied(src, mapping)


def _copied(src: _Source, mapping: TableMapping) -> _Source:
    """The source read once into the shared folder, and counted on the way."""
    spark = src.df.sparkSession
    seen = Observation(unique_name("kf_source"))
    counts = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(src.df)), F.lit(0)).cast("bigint").alias("bytes")]
    counts += [F.count_if(F.col(f"`{k}`").isNull()).alias(f"null_{i}") for i, k in enumerate(mapping.key)]
    src.copy = fresh_path(spark, f"source-{mapping.target}")
    src.df.observe(seen, *counts).write.parquet(src.copy)
    got = seen.get  # empty where Spark left out a plan that has no rows
    src.rows, src.bytes = got.get("rows", 0), got.get("bytes", 0)
    src.nulls = {k: got.get(f"null_{i}", 0) for i, k in enumerate(mapping.key)}
    src.df = spark.read.schema(src.df.schema).parquet(src.copy)
    return src


def _refuse_nulls(mapping: TableMapping, nulls: Mapping[str, int]) -> None:
    bad = {k: n for k, n in nulls.items() if n}
    if bad:
        raise NullKeyError(f"{mapping.source}: NULL key cells {bad}")


def _refuse_repeated_keys(mapping: TableMapping, batch: StagedBatch) -> None:
    """A key that is unique as declared has about as many distinct values as rows."""
    if batch.distinct_keys is not None and batch.distinct_keys < (1 - KEY_SKETCH_ERROR) * batch.rows_read:
        raise RepeatedKeyError(
            f"{mapping.source}: source_key {list(mapping.source_key)} is declared unique, but {batch.rows_read} rows "
            f"hold about {batch.distinct_keys} keys")


def _migrate(rep, t0, df, mapping, store, settings, options, known_rows) -> TableReport:
    external = getattr(store, "applies_plan", False)
    src = _measured(df, mapping, store, settings, options, known_rows)
    try:
        return _write_and_check(rep, t0, src, mapping, store, settings, options, external)
    finally:
        if src.copy:
            remove_path(df.sparkSession, src.copy)


def _write_and_check(rep, t0, src: _Source, mapping, store, settings, options, external) -> TableReport:
    spark = src.df.sparkSession
    rep.rows_read = src.rows
    rep.read_s = time.perf_counter() - t0

    def skip_empty() -> TableReport:
        log.warning("%s is empty, skipped", rep.source)
        rep.status, rep.rows_read, rep.rows_written = "skipped_empty", 0, None
        rep.total_s = time.perf_counter() - t0
        return rep

    if src.rows == 0:
        return skip_empty()
    _refuse_nulls(mapping, src.nulls)
    if src.rows is not None:
        log.info("%s -> %s: %d source rows (%.2fs)", rep.source, rep.target, src.rows, rep.read_s)
        _check_shuffle_width(spark, src.rows, mapping)
        # Only a store that applies the R1 plan needs the current partition count.
        current = _num_partitions(src.df) if external else 0
        plan = plan_partitions(src.rows, current, settings, has_key=True)
        rep.plan_action = plan.action
        # With the partition count not asked (0), a "none" plan has no count to show.
        rep.plan_partitions = None if (plan.action == "none" and current == 0) else plan.partitions
        requested = mapping.buckets
        if requested is None and not settings.target_bucket_bytes and plan.action == "repartition":
            requested = plan.partitions
        rep.buckets = bucket_count(src.rows, settings, requested, src.bytes)
    else:
        plan, rep.buckets = None, mapping.buckets or 1  # an existing table keeps its own count

    if options.rejects and not external and store.exists(mapping.target):
        _set_aside(rep, src, mapping, store, options)

    def accept(batch: StagedBatch) -> bool:
        _refuse_nulls(mapping, batch.null_cells)
        _refuse_repeated_keys(mapping, batch)
        return batch.rows_read > 0

    t1 = time.perf_counter()
    result = store.write(
        src.df,
        mapping.target,
        mapping.partition_key,
        mapping.clustering_keys,
        mode=options.mode,
        buckets=rep.buckets,
        order_by=mapping.order_by,
        confirm_truncate=options.confirm_truncate,
        unique=mapping.key_is_unique_by_source(),
        plan=plan,
        **({} if external else {"accept": accept}),
    )
    rep.write_s = time.perf_counter() - t1
    batch = result.batch
    if batch is not None:
        rep.rows_read = batch.rows_read
        if batch.rows_read == 0:
            return skip_empty()
        if plan is None:
            _check_shuffle_width(spark, batch.rows_read, mapping)
            done = plan_partitions(batch.rows_read, 0, settings, has_key=True)
            rep.plan_action, rep.plan_partitions = done.action, None if done.action == "none" else done.partitions
    rep.rows_written = result.rows_written
    if external:
        rep.buckets = None  # an external store has no buckets of ours
    elif result.buckets is not None:
        rep.buckets = result.buckets  # an existing table keeps its own count
    rep.status = "skipped_exists" if result.skipped else "ok"

    # In ignore mode the target may keep older contents by design: no reconcile.
    if options.reconcile and not result.skipped and options.mode.lower() != "ignore":
        _reconcile(rep, src, mapping, store, options, result)
    rep.total_s = time.perf_counter() - t0
    rep.rows_per_s = rep.rows_read / rep.total_s if rep.total_s and rep.rows_read is not None else None
    log.info(
        "%s -> %s: %s, %s rows written, plan %s(%s), %s buckets, write %.2fs, total %.2fs, %.0f rows/s",
        rep.source, rep.target, rep.status, rep.rows_written, rep.plan_action, rep.plan_partitions, rep.buckets,
        rep.write_s, rep.total_s, rep.rows_per_s or 0,
    )
    return rep


def _set_aside(rep: TableReport, src: _Source, mapping, store, options) -> None:
    """Rows with a value that the existing table's types refuse go to the
    rejects folder, counted by the tasks that write it; the others stay in ``src``."""
    types = {f.name.lower(): f.dataType for f in store.read(mapping.target).schema.fields}
    tried = try_types(src.df, {c: types[c.lower()] for c in src.df.columns if c.lower() in types})
    seen = Observation(unique_name("kf_refused"))
    path = f"{options.rejects.rstrip('/')}/{mapping.target}"
    refused_values(tried).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    rep.values_refused = seen.get.get("n", 0)
    if rep.values_refused:
        src.df = fitting(tried)
    else:
        remove_path(src.df.sparkSession, path)


def _reconcile(rep: TableReport, src: _Source, mapping, store, options, result) -> None:
    """A3: by the digest of what was written, and key by key where that differs."""
    unique, batch = mapping.key_is_unique_by_source(), result.batch
    target = store.read(mapping.target)
    found = digest(store.read(mapping.target, bucketed=False)) if batch is not None else None
    if found is not None and found == batch.digest:
        # The version holds the batch's rows and, after an append, rows of other keys.
        rep.missing_keys, rep.extra_keys = 0, found[0] - batch.batch_keys
        rep.changed_rows = repeated_rows(target, mapping.key) if unique else 0
    else:
        r = reconcile_frames(src.df, target, mapping.key, mapping.order_by, unique=unique).first()
        rep.missing_keys, rep.changed_rows = int(r["missing_keys"]), int(r["changed_rows"])
        rep.extra_keys = int(r["extra_keys"])
    # Every source key must be there with its winning values; other keys
    # are expected only when appending into a table that had rows before.
    extra_ok = options.mode.lower() == "append" and not result.created
    if rep.missing_keys or rep.changed_rows or (rep.extra_keys and not extra_ok):
        rep.status = "mismatch"


class RunControl:
    """Stops a run from another thread: tables under way are cancelled, the others not begun."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.tag = unique_name("keyferry-run")
        self._stopped = threading.Event()

    @property
    def stopped(self) -> bool:
        return self._stopped.is_set()

    def cancel(self) -> None:
        self._stopped.set()
        self._spark.sparkContext.cancelJobsWithTag(self.tag)

    @contextlib.contextmanager
    def tagged(self):
        """Jobs of this thread carry the run's tag."""
        sc = self._spark.sparkContext
        sc.addJobTag(self.tag)
        try:
            yield
        finally:
            sc.removeJobTag(self.tag)


_FAILED = ("failed", "mismatch", "skipped_parent", "cancelled")


def _parents(mappings: Sequence[TableMapping | dict], relations: Sequence[tuple[str, str]]) -> list[set[int]]:
    """Per mapping, the mappings that must be done before it: those of its parent
    tables, and an earlier one of the same target (a table has one writer)."""
    def names(m: TableMapping | dict, *fields: str) -> str:
        got = getattr(m, fields[0], None) if isinstance(m, TableMapping) else next((m[f] for f in fields if m.get(f)), None)
        return str(got or "").lower()

    sources = [names(m, "source", "source_table") for m in mappings]
    targets = [names(m, "target", "target_table") for m in mappings]
    wanted = [{p for p, src in enumerate(sources) if any(c.lower() == sources[i] and q.lower() == src for c, q in relations) and p != i}
              for i in range(len(mappings))]
    try:
        order = list(graphlib.TopologicalSorter({i: w for i, w in enumerate(wanted)}).static_order())
    except graphlib.CycleError as e:
        raise MappingError(f"tables depend on each other in a circle: {[sources[i] for i in e.args[1]]}") from None
    # Writers of one target follow each other in an order that the parents allow.
    place = {i: at for at, i in enumerate(order)}
    for i, t in enumerate(targets):
        for j in range(len(mappings)):
            if t and j != i and targets[j] == t and ((place[j], j) < (place[i], i) if relations else j < i):
                wanted[i].add(j)
    return wanted


def migrate_all(
    spark: SparkSession,
    reader: Callable[[str], DataFrame],
    mappings: Sequence[TableMapping | dict],
    store: KeyedStore,
    settings: PlanSettings | None = None,
    options: RunOptions | None = None,
    parallelism: int = 1,
    relations: Sequence[tuple[str, str]] = (),
    control: RunControl | None = None,
) -> list[TableReport]:
    """M2: every mapping; one table's failure never stops the rest.

    ``parallelism`` > 1 submits that many tables at once as concurrent Spark
    jobs (a thread each), so many small tables keep the cluster busy instead
    of running one after another. Mappings that share a target never overlap.
    Reports keep the mapping order.

    ``relations`` are (child source, parent source) pairs: a child starts when
    its parents are done, and is reported as ``skipped_parent`` if one of them
    failed, did not reconcile or was itself skipped for that reason. A parent
    without rows is no failure. ``control`` lets another thread cancel the run.
    """
    if not mappings:
        raise MappingError("no table mappings given")
    if parallelism < 1:
        raise MappingError("parallelism must be >= 1")
    parents = _parents(mappings, relations)
    related = {(c.lower(), p.lower()) for c, p in relations}
    control = control or RunControl(spark)
    store.create_keyspace()
    reports: list[TableReport | None] = [None] * len(mappings)

    def named(m: TableMapping | dict, status: str, error: Exception | str, total_s: float | None = None) -> TableReport:
        if isinstance(m, TableMapping):
            src, tgt = m.source, store.qualified(m.target)
        elif isinstance(m, dict):
            src = m.get("source_table") or m.get("source") or "?"
            tgt = m.get("target_table") or m.get("target") or "?"
        else:
            src = tgt = "?"
        kind = type(error).__name__ if isinstance(error, Exception) else None
        return TableReport(src, tgt, status, error_class=kind, error=str(error), total_s=total_s)

    def one(i: int) -> TableReport:
        m = mappings[i]
        if control.stopped:
            return named(m, "cancelled", "the run was cancelled")
        try:
            mapping = m if isinstance(m, TableMapping) else TableMapping.from_dict(m)
        except (MappingError, KeyError, TypeError) as e:
            return named(m, "failed", e)
        for p in sorted(parents[i]):
            r = reports[p]
            if r.status in _FAILED and (mapping.source.lower(), r.source.lower()) in related:
                return named(mapping, "skipped_parent", f"{r.source}: {r.status}")
        t0 = time.perf_counter()
        try:
            with control.tagged():
                return migrate_table(spark, reader, mapping, store, settings, options)
        except Exception as e:  # noqa: BLE001 - reported per table, run goes on
            log.error("%s -> %s failed: %s: %s", mapping.source, mapping.target, type(e).__name__,
                      str(e).splitlines()[0] if str(e) else "")
            return named(mapping, "cancelled" if control.stopped else "failed", e, time.perf_counter() - t0)

    order = graphlib.TopologicalSorter({i: w for i, w in enumerate(parents)})
    order.prepare()
    if parallelism == 1:
        while order.is_active():
            for i in sorted(order.get_ready()):
                reports[i] = one(i)
                order.done(i)
        return reports
    with ThreadPoolExecutor(max_workers=parallelism, thread_name_prefix="keyferry-migrate") as pool:
        running = {}
        while order.is_active():
            running |= {pool.submit(one, i): i for i in sorted(order.get_ready())}
            for f in wait(running, return_when=FIRST_COMPLETED).done:
                i = running.pop(f)
                reports[i] = f.result()
                order.done(i)
    return reports


def report_frame(spark: SparkSession, reports: Sequence[TableReport]) -> DataFrame:
    """The run report as a DataFrame (one small row per mapping)."""
    rows = [tuple(asdict(r)[f.name] for f in REPORT_SCHEMA.fields) for r in reports]
    return spark.createDataFrame(rows, REPORT_SCHEMA)
