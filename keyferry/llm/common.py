"""Helpers shared by the corpus operators: tables in the shared folder, word rules."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyferry.session import fresh_path, remove_path

# ASCII white space; a word is a run of other characters.
SPACE = r"\x20\x09-\x0D"
# The same characters spelled out, for functions that take plain characters.
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and gives Spark the
    real size of the table, so that it broadcasts only what is small.
    """
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `stored` that nothing reads any more."""
    for df in tables:
        remove_path(df.sparkSession, df.stored_at)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; no other character changes (null stays null)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def split_words(text: Column, separators: str = SPACE) -> Column:
    """Array of the runs of characters outside the class `separators`; null text gives none."""
    return F.array_remove(F.split(text_or_empty(text), f"[{separators}]+", -1), "")


def sliding(first: Column, second: Column, shift: int, count: Column, fold) -> Column:
    """fold(first[i], second[i + shift]) for the first `count` positions (none if negative)."""
    n = F.greatest(count, F.lit(0))
    return F.zip_with(F.slice(first, F.lit(1), n), F.slice(second, F.lit(1 + shift), n), fold)
