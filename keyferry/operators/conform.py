"""Conform a DataFrame to the keyed store's column types in one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyferry.functions.typemap import target_type


# Zone-less epoch: adding to it is exact whatever the session zone is.
def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_utc_instant(c: Column) -> Column:
    """A zone-less wall clock read as UTC, as an instant. Built from the
    value's own fields with an explicit UTC zone: no session-zone wall clock
    is involved, so nothing shifts or merges in daylight-saving gaps or
    overlaps."""
    seconds = F.date_part(F.lit("SECOND"), c)  # with microseconds
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), seconds, F.lit("UTC"))


def instant_to_utc_wall_clock(c: Column) -> Column:
    """Inverse of ``ntz_to_utc_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())


def _cast(col: Column, src: T.DataType, dst: T.DataType) -> Column:
    """Cast ``col`` to ``dst``, reading zone-less timestamps as UTC at any
    depth (inside arrays, maps and structs too)."""
    if src == dst:
        return col
    if isinstance(src, T.TimestampNTZType) and isinstance(dst, T.TimestampType):
        return ntz_to_utc_instant(col)
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        return F.transform(col, lambda x: _cast(x, src.elementType, dst.elementType))
    if isinstance(src, T.MapType) and isinstance(dst, T.MapType):
        m = col
        if src.keyType != dst.keyType:
            m = F.transform_keys(m, lambda k, v: _cast(k, src.keyType, dst.keyType))
        if src.valueType != dst.valueType:
            m = F.transform_values(m, lambda k, v: _cast(v, src.valueType, dst.valueType))
        return m
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        fields = [
            _cast(col[sf.name], sf.dataType, df_.dataType).alias(df_.name)
            for sf, df_ in zip(src.fields, dst.fields)
        ]
        return F.when(col.isNull(), F.lit(None).cast(dst)).otherwise(F.struct(*fields))
    return col.cast(dst)


def conform(df: DataFrame, profile: str = "reference") -> DataFrame:
    """Cast every column whose type differs from its target type.

    Columns already of the target type pass through untouched, so the
    projection is free for them and stays inside whole-stage codegen.
    """
    out = []
    for f in df.schema.fields:
        _, dst = target_type(f.dataType, profile)
        c = F.col(f"`{f.name}`")
        out.append(c if dst == f.dataType else _cast(c, f.dataType, dst).alias(f.name))
    return df.select(*out)


# Per row, in ``try_types``: the columns whose value the wanted type refuses.
REFUSED = "__kf_refused"


def try_types(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """``df`` with ``types`` cast to, and ``REFUSED``: an array of (column, type,
    value as text) for every value that its type does not take, empty for a row
    that fits.

    A cast fails a job by default, so one bad row would end the table. Here a
    refused value is NULL and reported. Casts of NULL are no refusal.
    """
    missing = sorted(set(types) - set(df.columns))
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    own = {f.name: f.dataType for f in df.schema.fields}
    values, refused = [], []
    for name in df.columns:
        c, want = F.col(f"`{name}`"), types.get(name)
        if want is None:
            values.append(c)
            continue
        want = T.DataType.fromDDL(want) if isinstance(want, str) else want
        if want == own[name]:
            values.append(c)
            continue
        ntz = isinstance(own[name], T.TimestampNTZType) and isinstance(want, T.TimestampType)
        cast = ntz_to_utc_instant(c) if ntz else c.try_cast(want)
        values.append(cast.alias(name))
        text = F.to_json(F.struct(c)) if isinstance(own[name], (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")
        refused.append(F.when(c.isNotNull() & cast.isNull(), F.struct(
            F.lit(name).alias("column"), F.lit(want.simpleString()).alias("type"), text.alias("value"))))
    none = F.array().cast("array<struct<column:string,type:string,value:string>>")
    found = F.filter(F.array(*refused), lambda x: x.isNotNull()) if refused else none
    return df.select(*values, found.alias(REFUSED))


def fitting(tried: DataFrame) -> DataFrame:
    """The rows of ``try_types`` without a refused value."""
    return tried.where(F.size(REFUSED) == 0).drop(REFUSED)


def refused_values(tried: DataFrame) -> DataFrame:
    """row (as JSON, refused values NULL), column, type, value: one row per refused value."""
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in tried.columns if c != REFUSED])).alias("row")
    return tried.where(F.size(REFUSED) > 0).select(whole, F.inline(REFUSED))


def refusal_counts(tried: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, refused for every one of ``columns``, then ``*`` with the rows that hold a refused value; one scan."""
    names = F.transform(REFUSED, lambda r: r["column"])
    aggs = [F.count_if(F.array_contains(names, c)).alias(f"n{i}") for i, c in enumerate(columns)]
    wide = tried.agg(*aggs, F.count_if(F.size(REFUSED) > 0).alias("any"))
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("refused")) for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*pairs, F.struct(F.lit("*").alias("column"), F.col("any").alias("refused")))))


def as_utc_wall_clock(df: DataFrame) -> DataFrame:
    """Turn every zoned timestamp back into a UTC wall-clock (NTZ) value.

    Used by checks that compare conformed output with engines that carry no
    session time zone.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = instant_to_utc_wall_clock(c).alias(f.name)
        out.append(c)
    return df.select(*out)
