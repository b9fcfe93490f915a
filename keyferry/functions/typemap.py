"""Spark type -> keyed-store column type.

Two profiles:

* ``reference``: the mapping the original migration applies in its DDL. Eight
  scalar types keep their meaning (float widens to double); every other scalar
  is stored as text, including timestamps without a time zone, decimals,
  bytes, shorts and binary. Nested types are refused with a clear error.
* ``exact``: keep every value's meaning. Byte and short widen to int,
  decimals and binary are kept, timestamps without a zone become instants read
  as UTC wall clock, nested types are kept.

``conform`` in operators/conform.py turns the chosen type into one projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

PROFILES = ("reference", "exact")


class UnsupportedTypeError(TypeError):
    pass


# Target type names of the keyed store (CQL spelling).
_REFERENCE_SCALARS: list[tuple[type, str, T.DataType]] = [
    (T.IntegerType, "int", T.IntegerType()),
    (T.LongType, "bigint", T.LongType()),
    (T.DoubleType, "double", T.DoubleType()),
    (T.FloatType, "double", T.DoubleType()),
    (T.StringType, "text", T.StringType()),
    (T.DateType, "date", T.DateType()),
    (T.TimestampType, "timestamp", T.TimestampType()),
    (T.BooleanType, "boolean", T.BooleanType()),
]

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _is_exact_type(dt: T.DataType, cls: type) -> bool:
    # TimestampNTZType is not a subclass of TimestampType, but guard anyway.
    return type(dt) is cls


def target_type(dt: T.DataType, profile: str = "reference") -> tuple[str, T.DataType]:
    """(store type name, Spark type the column is cast to) for one column."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; use one of {PROFILES}")
    if profile == "reference":
        if isinstance(dt, _NESTED):
            raise UnsupportedTypeError(
                f"nested type {dt.simpleString()} has no column type in the reference profile; "
                "use profile='exact'"
            )
        for cls, name, spark_t in _REFERENCE_SCALARS:
            if _is_exact_type(dt, cls):
                return name, spark_t
        return "text", T.StringType()
    return _exact(dt)


def _exact(dt: T.DataType) -> tuple[str, T.DataType]:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType)):
        return "int", T.IntegerType()
    if isinstance(dt, T.LongType):
        return "bigint", T.LongType()
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return "double", T.DoubleType()
    if isinstance(dt, (T.StringType, T.CharType, T.VarcharType)):
        return "text", T.StringType()
    if isinstance(dt, T.DecimalType):
        return "decimal", dt
    if isinstance(dt, T.BinaryType):
        return "blob", dt
    if isinstance(dt, T.DateType):
        return "date", dt
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp", T.TimestampType()
    if isinstance(dt, T.BooleanType):
        return "boolean", dt
    if isinstance(dt, T.ArrayType):
        name, inner = _exact(dt.elementType)
        return f"list<{name}>", T.ArrayType(inner, dt.containsNull)
    if isinstance(dt, T.MapType):
        kn, kt = _exact(dt.keyType)
        vn, vt = _exact(dt.valueType)
        return f"map<{kn}, {vn}>", T.MapType(kt, vt, dt.valueContainsNull)
    if isinstance(dt, T.StructType):
        parts = [(_exact(f.dataType), f) for f in dt.fields]
        name = "frozen<tuple<" + ", ".join(p[0][0] for p in parts) + ">>"
        return name, T.StructType(
            [T.StructField(f.name, p[1], f.nullable) for p, f in parts]
        )
    # Intervals, NullType, variants and anything newer: text.
    return "text", T.StringType()


def schema_ddl(schema: T.StructType, profile: str = "reference") -> list[tuple[str, str]]:
    """Column name and store type for every column, in schema order."""
    return [(f.name, target_type(f.dataType, profile)[0]) for f in schema.fields]


def _quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _is_collection(dt: T.DataType) -> bool:
    return isinstance(dt, (T.ArrayType, T.MapType, T.StructType))


def _ddl_type(dt: T.DataType, profile: str, frozen: bool = False) -> str:
    """Store type name for DDL: collections inside collections (and, with
    ``frozen``, the column itself) are written ``frozen<...>``."""
    if profile == "reference" or not _is_collection(dt):
        return target_type(dt, profile)[0]
    if isinstance(dt, T.ArrayType):
        name = f"list<{_ddl_type(dt.elementType, profile, frozen=True)}>"
    elif isinstance(dt, T.MapType):
        name = f"map<{_ddl_type(dt.keyType, profile, True)}, {_ddl_type(dt.valueType, profile, True)}>"
    else:
        return "frozen<tuple<" + ", ".join(_ddl_type(f.dataType, profile, True) for f in dt.fields) + ">>"
    return f"frozen<{name}>" if frozen else name


def keyspace_ddl(keyspace: str, replication_strategy: str = "SimpleStrategy", replication_factor: int = 1, durable_writes: bool = True) -> str:
    """``CREATE KEYSPACE IF NOT EXISTS`` text for a wide-column keyed store, for its own tools."""
    if int(replication_factor) < 1:
        raise ValueError("replication_factor must be >= 1")
    strategy = str(replication_strategy).replace("'", "''")
    return (f"CREATE KEYSPACE IF NOT EXISTS {_quote(keyspace)} WITH replication = {{'class': '{strategy}', "
            f"'replication_factor': {int(replication_factor)}}} AND durable_writes = {'true' if durable_writes else 'false'}")


def keyed_table_ddl(
    schema: T.StructType,
    keyspace: str,
    table: str,
    partition_key: Sequence[str],
    clustering_keys: Sequence[str] = (),
    profile: str = "reference",
    clustering_order: str | None = None,
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for a wide-column keyed store.

    The key clause keeps the two parts apart: ``PRIMARY KEY ((p1, p2), c1,
    c2)``, partition key in its own brackets (also when it is one column),
    then the clustering keys. ``clustering_order`` ("ASC"/"DESC") adds the
    ordering clause for them. Names are quoted, so they keep their case and
    may be reserved words; collections nested in collections, and collection
    key columns, are frozen. Run it with the store's own tools; nothing here
    connects to a store.
    """
    if not partition_key:
        raise ValueError("a partition key is required")
    keys = set(partition_key) | set(clustering_keys)
    cols = ", ".join(
        f"{_quote(f.name)} {_ddl_type(f.dataType, profile, frozen=f.name in keys)}" for f in schema.fields
    )
    key = (
        f"PRIMARY KEY (({', '.join(map(_quote, partition_key))})"
        + "".join(f", {_quote(c)}" for c in clustering_keys)
        + ")"
    )
    ddl = f"CREATE TABLE IF NOT EXISTS {_quote(keyspace)}.{_quote(table)} ({cols}, {key})"
    if clustering_keys and clustering_order:
        order = ", ".join(f"{_quote(c)} {clustering_order.upper()}" for c in clustering_keys)
        ddl += f" WITH CLUSTERING ORDER BY ({order})"
    return ddl
