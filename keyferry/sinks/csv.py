"""K8 CSV export and K7 folder load."""

from __future__ import annotations

import hashlib
import re

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keyferry.session import unique_name
from keyferry.sources.csv_folder import RECORD, good_records, list_tables, read_checked, rejects, scan_folder


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "errorifexists") -> None:
    """K8: header line, fixed column order, one folder of part files.

    Values are kept: leading and trailing spaces stay, quotes are doubled and
    line breaks stand inside quotes, as ``csv_folder`` reads them. CSV has one form for NULL and the empty
    string: an empty string comes back as NULL.
    """
    out = df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}
    out.write.option("header", "true").options(**keep).mode(mode).csv(path)


def export_tables(tables: Mapping[str, DataFrame], folder: str, mode: str = "errorifexists") -> list[str]:
    """Write each table as ``folder/<name>/part-*.csv``, a folder S4 reads back."""
    for name, df in tables.items():
        write_csv(df, f"{folder.rstrip('/')}/{name}", mode=mode)
    return list(tables)


@dataclass(frozen=True)
class LoadResult:
    table: str
    rows: int | None
    status: str
    error: str | None = None
    target: str | None = None  # where the sink put it, when it says
    rejected: int | None = None  # records set aside, when asked for
    rejects: str | None = None  # the folder that holds them


class FolderLoadError(RuntimeError):
    def __init__(self, done: list[LoadResult], failed: LoadResult):
        super().__init__(f"load of {failed.table} failed: {failed.error}")
        self.done = done
        self.failed = failed


def load_folder(
    spark: SparkSession,
    folder: str,
    sink: Callable[[str, DataFrame, str], str | None],
    mode: str = "overwrite",
    schemas: Mapping[str, object] | None = None,
    options: Mapping[str, str] | None = None,
    rejects_root: str | None = None,
) -> list[LoadResult]:
    """K7: every CSV table of ``folder`` into ``sink(name, df, mode)``; a sink
    may return the name it wrote to (kept in ``LoadResult.target``).

    Unreadable files are reported and skipped; the first failing *write* stops
    the run (raised with what was done so far). Rows are counted while being
    written, not by a separate scan. In ``ignore`` mode a sink may skip the
    write altogether, so rows are not counted there (reported as None).

    With ``rejects_root``, records that do not fit their table's schema are not
    loaded as rows of NULLs but written to ``rejects_root/<table>`` (file,
    record, parsed), and counted beside the rows; a table without any leaves no
    folder.
    """
    scan = scan_folder(spark, folder, schemas, options=options)
    done = [LoadResult(n, None, "unreadable", err) for n, err in sorted(scan.failures.items())]
    count = mode.lower() != "ignore"
    if rejects_root and not count:
        raise ValueError("records cannot be set aside in ignore mode: the sink may not read them")
    paths = list_tables(spark, folder) if rejects_root else {}
    for name, df in sorted(scan.tables.items()):
        try:
            if rejects_root:
                done.append(load_checked(name, read_checked(spark, paths[name], df.schema, options), sink, mode, rejects_root))
                continue
            obs = Observation(unique_name("kf_load")) if count else None
            target = sink(name, df.observe(obs, F.count(F.lit(1)).alias("rows")) if count else df, mode)
            done.append(LoadResult(name, int(obs.get.get("rows", 0)) if count else None, "ok", target=target))
        except Exception as e:  # noqa: BLE001
            raise FolderLoadError(done, LoadResult(name, None, "failed", f"{type(e).__name__}: {e}")) from e
    return done


def load_checked(
    name: str, checked: DataFrame, sink: Callable[[str, DataFrame, str], str | None], mode: str, rejects_root: str
) -> LoadResult:
    """The good records of ``read_checked`` into ``sink``, the others beside it.

    Both are counted while the sink reads; only if there are rejects is the
    source read again to write them.
    """
    obs = Observation(unique_name("kf_load"))
    seen = checked.observe(obs, F.count_if(F.col(RECORD).isNull()).alias("rows"), F.count(RECORD).alias("rejected"))
    target = sink(name, good_records(seen), mode)
    rows, rejected = int(obs.get.get("rows", 0)), int(obs.get.get("rejected", 0))
    at = None
    if rejected:
        at = f"{rejects_root.rstrip('/')}/{catalog_name(name)}"
        rejects(checked).write.mode("overwrite").parquet(at)
    return LoadResult(name, rows, "ok", None, target, rejected, at)


def catalog_name(name: str) -> str:
    """A valid catalog table name (letters, digits, ``_``) for a file's table
    name, which is also safe as a folder name; a short hash of the original
    keeps distinct names apart when characters had to be replaced."""
    safe = re.sub(r"[^A-Za-z0-9_]", "_", name).lower()
    # Catalog names ignore case: any name not already lower-case and valid
    # gets the hash, so "Orders" and "orders" stay two tables.
    return safe if safe == name else f"{safe}_{hashlib.sha1(name.encode()).hexdigest()[:8]}"


def table_sink(database: str, location_root: str | None = None) -> Callable[[str, DataFrame, str], None]:
    """A sink writing catalog tables (parquet) of ``database``, named by
    ``catalog_name`` (file names may hold characters tables cannot)."""

    def write(name: str, df: DataFrame, mode: str) -> str:
        w = df.write.format("parquet").mode(mode)
        if location_root:
            w = w.option("path", f"{location_root.rstrip('/')}/{catalog_name(name)}")
        target = f"`{database.replace('`', '``')}`.`{catalog_name(name)}`"
        w.saveAsTable(target)
        return target

    return write
