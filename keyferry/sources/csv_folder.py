"""A folder of CSV tables.

A table is either a ``name.csv`` file directly in the folder, or a
sub-folder ``name/`` (or ``name.csv/``) holding ``*.csv`` part files, which is
what Spark itself writes. Listing goes through Spark's file index (any file
system), reading only file names. Each table is read with a header and,
unless a schema is declared, inferred types. A table that cannot be read is
reported and skipped; an empty folder gives no tables. A zero-byte file has
no header and no columns; Spark's file scan does not list it, so it is not a
table.

Texts are read in the dialect that ``sinks.csv`` writes (``TEXT_OPTIONS``): quotes
doubled, line breaks inside quotes. A file is then one task, since a line break
may stand inside a record; ``options={"multiLine": "false"}`` lets Spark split
large files that hold one record per line.

Records that do not fit a declared schema can be set aside: ``read_checked`` adds
a column with the raw record, NULL for good ones, and ``rejects`` lists the others
with their file.
"""

from __future__ import annotations

import os
import posixpath
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class FolderScan:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


def _norm(folder: str) -> str:
    return folder.rstrip("/")


_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?(.*)$"


_GLOB_CHARS = "\\{}[]*?"


def _glob_escape(s: str) -> str:
    """``s`` with the characters Spark's path globbing expands escaped."""
    return "".join("\\" + ch if ch in _GLOB_CHARS else ch for ch in s)


def _is_relative(p: str) -> bool:
    return not re.match(_SCHEME, p) and not p.startswith("/")


def _path_part(p: str) -> str:
    """The path of a location without scheme and authority, normalised
    (relative local paths made absolute): what file listings end with."""
    m = re.match(_SCHEME, p)
    path = m.group(2) if m else os.path.abspath(p)
    return posixpath.normpath(path or "/")


def _table_part(folder: str, path: Column | None = None) -> tuple[Column, Column]:
    """(first path component under ``folder``, whether a file lies below it)
    as expressions of a file path; empty for files deeper than one level or
    outside the folder. The folder is matched as a whole path prefix."""
    base = _path_part(folder).rstrip("/") + "/"
    path = F.col("path") if path is None else path
    rel_path = F.regexp_extract(path, _SCHEME, 2)
    inside = rel_path.startswith(base)
    rel = F.when(inside, F.substring(rel_path, len(base) + 1, 1 << 30))
    parts = F.split(rel, "/")
    ok = inside & (F.size(parts) <= 2) & (F.size(parts) >= 1)
    part = F.when(ok, F.element_at(parts, 1)).otherwise(F.lit(""))
    return part, F.when(ok, F.size(parts) == 2).otherwise(F.lit(False))


def list_tables(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Table name -> path globs that read it.

    The file listing stays in Spark (file names only, no content); only the
    distinct table names come back to the driver, however many files a
    table has.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", "true")
            .load(_glob_escape(_norm(folder)))
            .select("path")
        )
        part, nested = _table_part(folder)
        scheme = F.regexp_extract(F.col("path"), r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
        kinds = files.select(part.alias("part"), nested.alias("nested"), scheme.alias("scheme")).distinct()
        rows = kinds.collect()
        if _is_relative(folder) and any(r["scheme"] not in ("", "file") for r in rows):
            # Spark resolves a relative path on the default file system, the
            # driver's working directory is local: they cannot be matched.
            raise ValueError(f"give the folder {folder!r} as an absolute path or URI")
        found = sorted({(r["part"], r["nested"]) for r in rows if r["part"]})
    except Exception as e:  # noqa: BLE001 - empty or missing folder
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e) or "does not exist" in str(e):
            return {}
        raise
    base = _glob_escape(_norm(folder))
    out: dict[str, list[str]] = {}
    for part, nested in found:
        name = part[:-4] if part.endswith(".csv") else part
        esc = _glob_escape(part)
        out.setdefault(name, []).append(f"{base}/{esc}/*.csv" if nested else f"{base}/{esc}")
    return out


# Reads back what ``write_csv`` writes: quotes doubled, line breaks inside quotes.
TEXT_OPTIONS = {"multiLine": "true", "escape": '"'}

# The raw text of a record that does not fit, in ``read_checked``.
RECORD = "__kf_record"


def read_csv(
    spark: SparkSession,
    paths: list[str] | str,
    schema: T.StructType | str | None = None,
    infer: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """``options`` are Spark's, on top of ``TEXT_OPTIONS``.

    Spark cannot look into files with glob characters in their names while it
    reads across lines. Their columns are then inferred line by line, so that
    one of a table with line breaks may stay text; the values are the same.
    """
    given = {"header": "true", **TEXT_OPTIONS, **(options or {})}
    r = spark.read.options(**given)
    if schema is None and given["multiLine"] == "true" and any("\\" in p for p in ([paths] if isinstance(paths, str) else paths)):
        by_line = spark.read.options(**{**given, "multiLine": "false"}).option("inferSchema", "true" if infer else "false")
        schema = by_line.csv(paths).schema
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true" if infer else "false")
    return r.csv(paths)


def read_checked(
    spark: SparkSession,
    paths: list[str] | str,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """``read_csv`` with the column ``RECORD``: the raw text of a record with too
    few or too many fields, or a value that its column's type refuses; NULL for a
    good record. Without a schema types are inferred first, from all values, so
    only the number of fields can be wrong.
    """
    if schema is None:
        schema = read_csv(spark, paths, options=options).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    flagged = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    return read_csv(spark, paths, flagged, options={**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD})


def good_records(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(RECORD).isNull()).drop(RECORD)


def rejects(checked: DataFrame) -> DataFrame:
    """file, record, parsed (the values that could be read, as JSON) of the records that do not fit."""
    own = [F.col(f"`{c}`") for c in checked.columns if c != RECORD]
    return checked.where(F.col(RECORD).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col(RECORD).alias("record"), F.to_json(F.struct(*own)).alias("parsed"))


def scan_folder(
    spark: SparkSession,
    folder: str,
    schemas: Mapping[str, T.StructType | str] | None = None,
    infer: bool = True,
    options: Mapping[str, str] | None = None,
) -> FolderScan:
    """Every table of the folder as a DataFrame; bad tables in ``failures``."""
    scan = FolderScan()
    for name, paths in list_tables(spark, folder).items():
        try:
            df = read_csv(spark, paths, (schemas or {}).get(name), infer, options)
            if not df.columns:
                raise ValueError("no columns: empty file")
            scan.tables[name] = df
        except Exception as e:  # noqa: BLE001 - reported, others go on
            scan.failures[name] = f"{type(e).__name__}: {e}"
    return scan


def folder_row_counts(spark: SparkSession, folder: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """(table, rows) for every table of the folder in ONE distributed job.

    All files are parsed by a single CSV scan with a one-column schema (a
    record's other fields are dropped unparsed); the header line of each file
    is skipped. The table of a row is the path component after the folder,
    taken from the file-metadata column inside Spark. Tables with no rows
    (header-only files) are reported with 0.
    """
    tables = list_tables(spark, folder)
    if not tables:
        return spark.createDataFrame([], "table string, rows bigint")
    globs = sorted(g for gs in tables.values() for g in gs)
    df = read_csv(spark, globs, schema="_c0 string", options=options)
    part, _ = _table_part(folder)
    owner = F.regexp_replace(part, r"\.csv$", "")
    # The metadata path is URL-encoded; decode it to compare with the folder
    # name ("+" is kept: it is not encoded there, but the decoder would read
    # it as a space).
    decoded = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    counted = (
        df.select(decoded.alias("path"))
        .select(owner.alias("table"))
        .groupBy("table")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # One row per table name (not per file).
    names = spark.createDataFrame([(n,) for n in sorted(tables)], "table string")
    return (
        counted.join(names, "table", "right")
        .select("table", F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows"))
    )
