"""A1 row counts and A3 source/target reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyferry.operators.keys import winner
from keyferry.session import fresh_path


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) for every table, as one distributed query.

    Each branch is a column-free count, so a parquet scan reads no column data.
    """
    if not tables:
        return SparkSession.active().createDataFrame([], "table string, rows bigint")
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), F.col("rows"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _hashable(c: Column, dt: T.DataType) -> Column:
    """``c`` with a NULL flag beside every value at every depth (the hash
    skips NULLs, so [NULL, 1] and [1, NULL] would collide) and maps, which
    Spark does not hash, as their sorted entries."""
    if isinstance(dt, T.ArrayType):
        et = dt.elementType
        return F.transform(c, lambda x: F.struct(x.isNull().alias("n"), _hashable(x, et).alias("v")))
    if isinstance(dt, T.StructType):
        return F.struct(*[
            F.struct(c[f.name].isNull().alias("n"), _hashable(c[f.name], f.dataType).alias("v")).alias(f.name)
            for f in dt.fields
        ])
    if isinstance(dt, T.MapType):
        vt = dt.valueType
        entries = F.transform(
            F.map_entries(c),
            lambda e: F.struct(e["key"].alias("k"), e["value"].isNull().alias("n"), _hashable(e["value"], vt).alias("v")),
        )
        return F.array_sort(entries)  # values are map-free by now: orderable
    return c


def _row_hash(cols: Sequence[tuple[Column, object]]) -> Column:
    """Hash of the values and of where they are NULL, at any depth."""
    if not cols:
        return F.lit(0).cast("bigint")
    nulls = F.concat_ws("", *[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c, _ in cols])
    return F.xxhash64(nulls, *[_hashable(c, dt) for c, dt in cols])


_HASH, _COUNT, _RANGE, _SIDE = "__kf_hash", "__kf_count", "__kf_range", "__kf_side"

# A digest does not depend on the order of the rows: their number, the sums of the
# two halves of their hashes (which cannot overflow) and the xor of the hashes.
DIGEST = ("rows", "low", "high", "xor")


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a whole row, its NULLs included."""
    return _row_hash([(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])


def digest_columns(hash_: Column, weight: Column | None = None) -> list[Column]:
    """The digest as aggregates, for ``agg`` and ``observe``. ``weight`` (1 or
    -1) adds and subtracts rows, so that two equal sets give zeros."""
    low, high = hash_.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(hash_, 32)
    w = F.lit(1) if weight is None else weight
    zero = F.lit(0).cast("bigint")
    parts = (F.sum(w.cast("bigint")), F.sum(low * w), F.sum(high * w), F.bit_xor(hash_))
    return [F.coalesce(c, zero).alias(name) for c, name in zip(parts, DIGEST)]


def digest(df: DataFrame) -> tuple[int, ...]:
    """The digest of all rows: one scan, nothing but the result is shuffled."""
    return tuple(df.select(row_hash(df).alias(_HASH)).agg(*digest_columns(F.col(_HASH))).first())


def _aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with the target's types, when it has the same columns: values
    are compared, not encodings (names matched without case, as Spark does)."""
    target_types = {f.name.lower(): f.dataType for f in target.schema.fields}
    if set(target_types) != {c.lower() for c in source.columns}:
        return source
    return source.select(*[F.col(f"`{c}`").cast(target_types[c.lower()]).alias(c) for c in source.columns])


class _Sides:
    """Both sides of a reconciliation as (key, hash, count, side) rows.

    The expected target row of a key is the U1 winner among its source rows;
    ``count`` is the number of its source rows. Hot keys collapse map-side.
    """

    def __init__(self, source: DataFrame, target: DataFrame, key: Sequence[str], order_by: Sequence[str], unique: bool):
        source = _aligned(source, target)
        self.key = list(key)
        types = {f.name: f.dataType for f in source.schema.fields}
        rest = [c for c in source.columns if c not in key]
        order_rest = list(order_by) + [c for c in rest if c not in order_by]
        keys = [F.col(f"`{k}`") for k in key]
        if unique:
            expected = source.withColumn(_COUNT, F.lit(1).cast("bigint"))
            values = [(F.col(f"`{c}`"), types[c]) for c in rest]
        else:
            expected = source.groupBy(*keys).agg(F.count(F.lit(1)).alias(_COUNT), winner(source, order_rest).alias("_w"))
            values = [(F.col(f"_w.`{c}`"), types[c]) for c in rest]
        self.source = expected.select(*keys, _row_hash(values).alias(_HASH), _COUNT)
        own = [(F.col(f"`{c}`"), types[c]) for c in rest]
        self.target = target.select(*keys, _row_hash(own).alias(_HASH), F.lit(0).cast("bigint").alias(_COUNT))
        # Both sides hash a key alike: as the target's type, with its NULLs.
        self.key_hash = _row_hash([(F.col(f"`{k}`"), types[k]) for k in key])

    def both(self, ranges: Sequence[Column], only: Column | None = None) -> DataFrame:
        """The rows of both sides with their ``ranges`` and the hash of key and values."""
        out = []
        for df, side in ((self.source, 1), (self.target, -1)):
            df = df if only is None else df.where(only)
            out.append(df.select(*ranges, F.xxhash64(self.key_hash, _HASH).alias(_HASH), _COUNT, F.lit(side).alias(_SIDE)))
        return out[0].unionByName(out[1])

    def digests(self, ranges: Sequence[Column], names: Sequence[str], only: Column | None = None) -> DataFrame:
        """Per range: the difference of the sides' digests, source rows and keys, target rows."""
        return self.both(ranges, only).groupBy(*names).agg(
            *digest_columns(F.col(_HASH), F.col(_SIDE)),
            F.sum(_COUNT).alias("source_rows"), F.count_if(F.col(_SIDE) == 1).alias("source_keys"),
            F.count_if(F.col(_SIDE) == -1).alias("target_rows"))

    def compared(self, within) -> DataFrame:
        """The key-wise comparison of the rows that ``within`` leaves of each side."""
        keys = [F.col(f"`{k}`") for k in self.key]
        src = within(self.source).select(*keys, F.col(_COUNT).alias("_n"), F.col(_HASH).alias("_hs"))
        tgt = within(self.target).groupBy(*keys).agg(F.count(F.lit(1)).alias("_t"), F.max(_HASH).alias("_ht"))
        # A key that was declared unique and is not: the source side is summed up as well.
        src = src.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.max("_hs").alias("_hs"))
        both = src.join(tgt, self.key, "full_outer")
        in_src, in_tgt = F.col("_n").isNotNull(), F.col("_t").isNotNull()
        return both.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("source_rows"),
            F.count_if(in_src).alias("source_keys"),
            F.coalesce(F.sum("_t"), F.lit(0)).cast("bigint").alias("target_rows"),
            F.count_if(in_src & ~in_tgt).alias("missing_keys"),
            F.count_if(in_tgt & ~in_src).alias("extra_keys"),
            (F.count_if(in_src & in_tgt & (F.col("_hs") != F.col("_ht")))
             + F.coalesce(F.sum(F.col("_t") - 1), F.lit(0))).cast("bigint").alias("changed_rows"))


_RESULT = ("source_rows", "source_keys", "target_rows", "missing_keys", "extra_keys", "changed_rows")


def reconcile(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str] = (),
    unique: bool = False,
    ranges: int = 4096,
    rows_per_range: int = 64,
) -> DataFrame:
    """One row proving a migration: counts both sides and key-wise differences.

    ``source`` is the (conformed) source, ``target`` the keyed table read back.
    The expected target row of a key is the U1 winner among its source rows; a
    target row whose non-key values differ from it counts as ``changed_rows``,
    and so does every target row beyond the first of its key (a source key that
    was declared unique and is not). ``unique`` states that source keys are
    unique, which saves the source's shuffle by key.

    Both sides are digested per range of the key's hash, in one aggregate that
    shuffles at most ``ranges`` rows per task. Equal digests end the matter: no
    join. Only ranges that differ are digested again in finer ones of about
    ``rows_per_range`` rows, and only rows of finer ranges that still differ are
    joined on their keys.
    """
    spark = source.sparkSession
    sides = _Sides(source, target, key, order_by, unique)
    coarse = F.pmod(sides.key_hash, F.lit(ranges)).cast("int")
    # At most ``ranges`` rows come to the driver.
    found = sides.digests([coarse.alias(_RANGE)], [_RANGE]).collect()
    apart = [r for r in found if any(r[c] for c in DIGEST)]
    if unique and len(apart) < len(found):
        # Equal ranges prove equal rows, not unique keys: two equal rows on both sides stay unseen.
        again = target.groupBy(*[F.col(f"`{k}`") for k in key]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        doubled = {r[0] for r in again.select(coarse).distinct().collect()}
        apart = [r for r in found if any(r[c] for c in DIGEST) or r[_RANGE] in doubled]
    else:
        doubled = set()
    differ = {r[_RANGE] for r in apart}
    equal = [r for r in found if r[_RANGE] not in differ]
    sums = [sum(r[c] for r in equal) for c in ("source_rows", "source_keys", "target_rows")]
    schema = ", ".join(f"{c} bigint" for c in _RESULT)
    same = spark.createDataFrame([(*sums, 0, 0, 0)], schema)
    if not differ:
        return same
    parts = [same]
    only = coarse.isin(sorted(differ))
    fine_ranges = -(-max(r["source_rows"] + r["target_rows"] for r in apart) // rows_per_range)
    if fine_ranges < 2 or doubled:
        parts.append(sides.compared(lambda df: df.where(only)))
    else:
        fine = F.pmod(F.floor(sides.key_hash / F.lit(ranges)), F.lit(fine_ranges))
        names = [_RANGE, "__kf_fine"]
        cut = [coarse.alias(names[0]), fine.alias(names[1])]
        path = fresh_path(spark, "reconcile")
        sides.digests(cut, names, only).write.parquet(path)
        finer = spark.read.parquet(path)
        is_equal = " and ".join(f"{c} = 0" for c in DIGEST)
        zero = [F.lit(0).cast("bigint").alias(c) for c in _RESULT[3:]]
        parts.append(finer.where(is_equal).agg(
            *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in _RESULT[:3]]).select(*_RESULT[:3], *zero))
        open_ranges = finer.where(f"not ({is_equal})").select(*names)
        parts.append(sides.compared(
            lambda df: df.where(only).select("*", *cut).join(open_ranges, names, "left_semi").drop(*names)))
    return reduce(DataFrame.unionByName, parts).agg(*[F.sum(c).cast("bigint").alias(c) for c in _RESULT])
