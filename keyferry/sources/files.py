"""Sizes of file sources, from file metadata: no content is read.

R1 needs a table's size before its rows are read. For Parquet and ORC files the
number of rows stands in the file footers and the size in the file listing, so a
plan costs neither a column nor a shuffle of rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Plan nodes that keep the rows of a file scan as they are, and formats whose footers count rows.
_KEEPING = {"LogicalRelation", "SubqueryAlias", "View", "Project"}
_COUNTED = {"ParquetFileFormat", "OrcFileFormat"}


def _plan(df: DataFrame):
    """The query execution behind ``df``; None where there is no JVM plan (Spark Connect)."""
    return getattr(df, "_jdf", None) and df._jdf.queryExecution()


def _simple(node) -> str:
    return node.getClass().getSimpleName()


def reads_files_only(df: DataFrame) -> bool:
    """True when every leaf of the plan is a file scan, which stays the same
    when it is read twice. Looks at the plan; lists no files."""
    plan = _plan(df)
    if plan is None:
        return False
    leaves = plan.analyzed().collectLeaves()
    names = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        names.append(_simple(leaf.relation()) if _simple(leaf) == "LogicalRelation" else _simple(leaf))
    return bool(names) and all(n == "HadoopFsRelation" for n in names)


def plain_files(df: DataFrame) -> bool:
    """True when ``df`` is the scan of one set of Parquet or ORC files with all its rows
    (columns may be chosen or renamed), so that their footers give its row count."""
    plan = _plan(df)
    if plan is None:
        return False
    node = plan.analyzed()
    while node.children().size() == 1 and _simple(node) in _KEEPING:
        node = node.children().apply(0)
    if _simple(node) != "LogicalRelation" or _simple(node.relation()) != "HadoopFsRelation":
        return False
    return _simple(node.relation().fileFormat()).rstrip("$") in _COUNTED


def file_totals(df: DataFrame) -> DataFrame:
    """One row: rows, bytes and files of a plain file scan.

    Reads no data column: the row count of every file comes from its footer. A
    file without rows does not show.
    """
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    each = files.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    zero = F.lit(0).cast("bigint")
    return each.agg(F.coalesce(F.sum("n"), zero).alias("rows"), F.coalesce(F.sum("size"), zero).alias("bytes"),
                    F.count(F.lit(1)).alias("files"))


def parts_of(bytes_: Column, target_bytes: int) -> Column:
    """R1 by size: partitions, or buckets, of at most ``target_bytes`` of files each; one at least."""
    if target_bytes < 1:
        raise ValueError("target_bytes must be >= 1")
    return F.greatest(F.lit(1).cast("bigint"), F.ceil(bytes_ / F.lit(target_bytes)).cast("bigint"))


def size_plans(tables: Mapping[str, DataFrame], target_bytes: int) -> DataFrame:
    """R1 for many file tables in one query: table, files, rows, bytes, partitions."""
    if not tables:
        raise ValueError("no tables given")
    plans = [file_totals(df).select(F.lit(name).alias("table"), "files", "rows", "bytes", parts_of(F.col("bytes"), target_bytes).alias("partitions"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, plans)
