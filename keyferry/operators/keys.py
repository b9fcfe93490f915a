"""Key validation (V1) and keyed-store write semantics.

A partition-keyed store keeps one row per key: writing a row whose key is
already present replaces it. Spark has no row order inside one batch, so the
winner among rows with equal keys is made explicit: the greatest by
``order_by`` columns, then by every remaining non-key column. The choice is a
total order, so re-runs and any partitioning give the same table.

Both dedupe and upsert are a ``groupBy(key).agg(max(struct(...)))``: the
aggregate is combined map-side, so a key repeated millions of times (a hot
key) is reduced to one row per map task before it is shuffled, and the
shuffle itself is spread by the *whole* key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_WIN = "__kf_win"
_BATCH = "__kf_batch"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def has_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.ArrayType):
        return has_map(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(has_map(f.dataType) for f in dt.fields)
    return False


def _orderable(c: Column, dt: T.DataType) -> Column:
    """``c`` itself when Spark can order it, else its canonical form: every
    map, at any depth, becomes the sorted array of its (key, value) entries.
    The result holds no map, so it can be ordered and hashed, and equal maps
    give equal forms whatever their entry order."""
    if not has_map(dt):
        return c
    if isinstance(dt, T.MapType):
        vt = dt.valueType
        entries = F.transform(
            F.map_entries(c),
            lambda e: F.struct(e["key"].alias("key"), _orderable(e["value"], vt).alias("value")),
        )
        return F.array_sort(entries)
    if isinstance(dt, T.ArrayType):
        et = dt.elementType
        return F.transform(c, lambda x: _orderable(x, et))
    if isinstance(dt, T.StructType):
        return F.when(c.isNull(), F.lit(None)).otherwise(
            F.struct(*[_orderable(c[f.name], f.dataType).alias(f.name) for f in dt.fields])
        )
    return c


def winner(df: DataFrame, columns: Sequence[str]) -> Column:
    """Aggregate picking, per group, the row greatest by ``columns`` in order
    (a total order when they are all non-key columns), as a struct of those
    columns. Uses ``max(struct)``; when a column cannot be ordered (maps),
    ``max_by`` carries the values and orders by their canonical form."""
    types = {f.name: f.dataType for f in df.schema.fields}
    values = F.struct(*[_q(c) for c in columns])
    if not any(has_map(types[c]) for c in columns):
        return F.max(values)
    order = F.struct(*[_orderable(_q(c), types[c]).alias(c) for c in columns])
    return F.max_by(values, order)


def _winner_struct(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> Column:
    rest = [c for c in df.columns if c not in key and c not in order_by]
    return winner(df, list(order_by) + rest)


# Fixed widths (bytes) used to estimate the stored size of a row.
_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}


def row_bytes(df: DataFrame) -> Column:
    """Estimated in-memory size of a row: text and binary by their length,
    fixed-width types by their width, nested values by their JSON length."""
    parts = []
    for f in df.schema.fields:
        c = _q(f.name)
        width = next((w for t, w in _WIDTH.items() if isinstance(f.dataType, t)), None)
        if width is not None:
            parts.append(F.lit(width))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, T.ArrayType) and type(f.dataType.elementType) in _WIDTH:
            parts.append(F.coalesce(F.size(c), F.lit(0)) * _WIDTH[type(f.dataType.elementType)])
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.coalesce(F.octet_length(c.cast("string")), F.lit(0)))
    return sum(parts[1:], parts[0]).cast("bigint") if parts else F.lit(0).cast("bigint")


def profile_keys(df: DataFrame, key: Sequence[str], with_bytes: bool = False) -> DataFrame:
    """One row: total rows and the number of NULL cells per key column.

    Reads only the key columns (column pruning reaches the scan) and runs as a
    single map-side-combined aggregate. ``with_bytes`` adds ``bytes``, the
    estimated total size of the rows, which reads every column.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(_q(k).isNull()).alias(f"null_{k}") for k in key]
    if with_bytes:
        return df.agg(*aggs, F.coalesce(F.sum(row_bytes(df)), F.lit(0)).cast("bigint").alias("bytes"))
    return df.select(*[_q(k) for k in key]).agg(*aggs)


def null_key_counts(df: DataFrame, key: Sequence[str], table: str) -> DataFrame:
    """Long form of ``profile_keys``: (table, column, null_cells, rows)."""
    wide = profile_keys(df, key)
    pairs = F.array(*[
        F.struct(F.lit(k).alias("column"), F.col(f"null_{k}").alias("null_cells")) for k in key
    ])
    return wide.select(
        F.lit(table).alias("table"), F.inline(pairs), F.col("rows")
    )


def refuse_map_keys(df: DataFrame, key: Sequence[str], what: str = "key") -> None:
    types = {f.name: f.dataType for f in df.schema.fields}
    bad = [k for k in key if k in types and has_map(types[k])]
    if bad:
        raise TypeError(f"{what} columns {bad} hold maps, which cannot be keys (no order, no hash)")


def require_keys(df: DataFrame, key: Sequence[str], what: str = "key") -> DataFrame:
    """``df`` unchanged, but a row with a NULL key cell fails the job.

    A keyed store refuses NULL keys, and an anti join never matches them, so
    an upsert would keep adding such rows. The check is a per-row filter in
    the same job (no extra scan); a failed write leaves the table as it was.
    """
    if not key:
        return df
    refuse_map_keys(df, key, what)
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | _q(k).isNull()
    msg = f"NULL {what} cell in ({', '.join(key)}): a keyed table refuses it"
    return df.filter(F.when(any_null, F.raise_error(F.lit(msg))).otherwise(F.lit(True)))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of copies."""
    return (
        df.groupBy(*[_q(k) for k in key])
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def repeated_rows(df: DataFrame, key: Sequence[str]) -> int:
    """Rows beyond the first of their key. Reads the key columns; a table bucketed
    by the leading ones is counted without a shuffle."""
    copies = df.groupBy(*[_q(k) for k in key]).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))).first()[0]


def dedupe(df: DataFrame, key: Sequence[str], order_by: Sequence[str] = (), sums: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per key, the greatest by ``order_by`` then the other columns.

    ``sums`` adds columns that sum an expression over all rows of the key.
    """
    cols, sums = df.columns, sums or {}
    return (
        df.groupBy(*[_q(k) for k in key])
        .agg(_winner_struct(df, key, order_by).alias(_WIN), *[F.sum(c).alias(name) for name, c in sums.items()])
        .select(*[_q(c) if c in key else F.col(f"{_WIN}.`{c}`").alias(c) for c in cols], *sums)
    )


def upsert(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """The table after ``incoming`` is written into ``existing``.

    Rows of ``incoming`` replace existing rows with the same key; among several
    incoming rows for one key the U1 rule picks. Existing rows with no incoming
    match stay. One shuffle of both inputs by key, both sides pre-combined.
    """
    cols = existing.columns
    incoming = incoming.select(*[_q(c) for c in cols])
    both = existing.withColumn(_BATCH, F.lit(0)).unionByName(incoming.withColumn(_BATCH, F.lit(1)))
    rest = [c for c in cols if c not in key and c not in order_by]
    return (
        both.groupBy(*[_q(k) for k in key])
        .agg(winner(both, [_BATCH] + list(order_by) + rest).alias(_WIN))
        .select(*[_q(c) if c in key else F.col(f"{_WIN}.`{c}`").alias(c) for c in cols])
    )


def surviving_rows(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Existing rows whose key is not re-sent by ``incoming``.

    The distinct incoming keys (combined map-side, so a much-repeated key is one
    row per task) are unique on the whole key, as the existing rows are. Spark
    broadcasts them when their size in bytes is under its threshold; then the
    existing table is filtered where it lies. Otherwise both sides are shuffled
    on the whole key: no hot task.
    """
    return existing.join(incoming.select(*[_q(k) for k in key]).distinct(), list(key), "left_anti")


# HyperLogLog registers as a power of two: a relative error of 0.8 %.
SKETCH_BITS = 14


def key_sketch(key: Sequence[str], where: Column | None = None) -> Column:
    """Aggregate: a mergeable sketch of the distinct keys, some 10 KB however many there are.

    NULL cells count as values. ``where`` leaves rows out.
    """
    nulls = F.concat_ws("", *[_q(k).isNull().cast("int").cast("string") for k in key])
    hashed = F.xxhash64(nulls, *[_q(k) for k in key])
    return F.hll_sketch_agg(hashed if where is None else F.when(where, hashed), F.lit(SKETCH_BITS))


def distinct_estimate(spark: SparkSession, *sketches: bytes) -> int:
    """About how many distinct keys the sketched batches hold together."""
    rows = spark.createDataFrame([(bytes(s),) for s in sketches], "s binary")
    return rows.agg(F.hll_sketch_estimate(F.hll_union_agg("s"))).first()[0] or 0
