"""Relational tables over JDBC.

Only connection *options* are built here; Spark's JDBC source does the work.
A plain read is one task per table. A partitioned read (S2) splits the table
into ``num_partitions`` range reads on a numeric, date or timestamp column;
missing bounds are fetched with one ``MIN``/``MAX`` query that runs inside
the database. Filters and column selections applied to the returned frame are
pushed into the database's SQL by Spark.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from keyferry.sources.ranges import quantile_cuts, range_predicates, sql_literal

# Fixed value: the default schema of a table name without one.
DEFAULT_SCHEMA = "dbo"


def url_from_template(template: str, **parts: object) -> str:
    """Fill a JDBC URL template such as
    ``jdbc:<sub>://{host}:{port};databaseName={database};encrypt={encrypt}``.
    Booleans are written ``true``/``false``."""
    vals = {k: ("true" if v else "false") if isinstance(v, bool) else v for k, v in parts.items()}
    return template.format(**vals)


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        o = {"url": self.url}
        if self.user is not None:
            o["user"] = self.user
        if self.password is not None:
            o["password"] = self.password
        if self.driver:
            o["driver"] = self.driver
        o.update({k: str(v) for k, v in self.properties.items()})
        return o


def split_table_name(name: str, default_schema: str = DEFAULT_SCHEMA) -> tuple[str, str]:
    """``schema.table`` -> (schema, table); no dot -> default schema.

    ``db.schema.table`` keeps everything before the last dot as the schema
    part, so three-part names work instead of failing.
    """
    if "." in name:
        schema, table = name.rsplit(".", 1)
        return schema, table
    return default_schema, name


def qualified(table: str, schema: str = DEFAULT_SCHEMA) -> str:
    return table if "." in table else f"{schema}.{table}"


def _reader(spark: SparkSession, conn: JdbcConnection, extra: Mapping[str, str] | None = None):
    r = spark.read.format("jdbc")
    for k, v in {**conn.options(), **(extra or {})}.items():
        r = r.option(k, v)
    return r


def discover_bounds(spark: SparkSession, conn: JdbcConnection, table: str, column: str) -> tuple[object, object]:
    """(min, max) of ``column``, computed by the database in one query."""
    q = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = _reader(spark, conn, {"query": q}).load().first()
    return row["lo"], row["hi"]


def _bound(v: object, up: bool) -> str:
    """A bound as Spark parses it: numeric bounds are whole numbers (the
    range is widened to cover a fractional min/max); dates and timestamps as
    their text."""
    if isinstance(v, bool):
        raise ValueError("a boolean column cannot split a read")
    if isinstance(v, (int, float, decimal.Decimal)):
        return str(int(math.ceil(v)) if up else int(math.floor(v)))
    return str(v)


def partition_options(column: str, lower: object, upper: object, num_partitions: int) -> dict[str, str]:
    if num_partitions < 1:
        raise ValueError("num_partitions must be >= 1")
    return {
        "partitionColumn": column,
        "lowerBound": _bound(lower, up=False),
        "upperBound": _bound(upper, up=True),
        "numPartitions": str(num_partitions),
    }


def read_table(
    spark: SparkSession,
    conn: JdbcConnection,
    table: str,
    schema: str = DEFAULT_SCHEMA,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    lower_bound: object = None,
    upper_bound: object = None,
    fetchsize: int | None = None,
    extra: Mapping[str, str] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """S1 (whole table, one task) or S2 (``partition_column`` given).

    ``predicates`` is the other form of S2: one WHERE clause per partition,
    run by the database. It suits a split column whose values are uneven
    (min/max strides would give one heavy range): ``quantile_split`` cuts the
    column at its quantiles, ``ranges.hash_predicates`` writes a hash of a text
    key modulo n.
    """
    name = qualified(table, schema)
    opts: dict[str, str] = {"dbtable": name, **(extra or {})}
    if fetchsize:
        opts["fetchsize"] = str(fetchsize)
    if predicates:
        props = {k: v for k, v in {**conn.options(), **opts}.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(conn.url, name, predicates=list(predicates), properties=props)
    if partition_column:
        if lower_bound is None or upper_bound is None:
            lo, hi = discover_bounds(spark, conn, name, partition_column)
            if lo is None:  # empty table: a plain read is as good
                return _reader(spark, conn, opts).load()
            lower_bound = lo if lower_bound is None else lower_bound
            upper_bound = hi if upper_bound is None else upper_bound
        opts.update(partition_options(partition_column, lower_bound, upper_bound, num_partitions or spark.sparkContext.defaultParallelism))
    return _reader(spark, conn, opts).load()


def quantile_split(
    spark: SparkSession, conn: JdbcConnection, table: str, column: str, num_partitions: int, schema: str = DEFAULT_SCHEMA,
    literal: Callable[[object], str] = sql_literal, extra: Mapping[str, str] | None = None,
) -> list[str]:
    """``predicates`` for ``read_table``: ranges of ``column`` with about equally many rows.

    The cuts come from a quantile sketch over that one column, which is all the
    database sends for them.
    """
    values = read_table(spark, conn, table, schema, extra=extra).select(column)
    return range_predicates(column, quantile_cuts(values, column, num_partitions), literal)
