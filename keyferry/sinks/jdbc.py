"""K1: write a DataFrame to a relational table over JDBC.

Fixed values (the reference's defaults): mode ``overwrite``, 10,000 rows per
insert batch, isolation level READ_COMMITTED. Overwrite truncates the table
(keeping its definition) instead of dropping it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from keyferry.sources.jdbc import DEFAULT_SCHEMA, JdbcConnection, qualified

JDBC_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")
DEFAULT_BATCHSIZE = 10_000
DEFAULT_ISOLATION = "READ_COMMITTED"


def write_options(
    conn: JdbcConnection,
    table: str,
    schema: str = DEFAULT_SCHEMA,
    batchsize: int = DEFAULT_BATCHSIZE,
    isolation_level: str = DEFAULT_ISOLATION,
    truncate: bool = True,
    num_partitions: int | None = None,
    column_types: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    o = {
        **conn.options(),
        "dbtable": qualified(table, schema),
        "batchsize": str(batchsize),
        "isolationLevel": isolation_level,
        "truncate": "true" if truncate else "false",
    }
    if num_partitions:
        o["numPartitions"] = str(num_partitions)  # caps concurrent connections
    if column_types:
        o["createTableColumnTypes"] = column_types
    o.update(extra or {})
    return o


def write_table(df: DataFrame, conn: JdbcConnection, table: str, schema: str = DEFAULT_SCHEMA, mode: str = "overwrite", **kw) -> None:
    mode = mode.lower()
    if mode not in JDBC_MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {JDBC_MODES}")
    w = df.write.format("jdbc").mode(mode)
    for k, v in write_options(conn, table, schema, **kw).items():
        w = w.option(k, v)
    w.save()
