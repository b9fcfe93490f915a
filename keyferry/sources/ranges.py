"""Splitting a table into predicates that hold about equally many rows.

A read is split by WHERE clauses, one per task. They must be disjoint and cover
every row, NULL keys included, or rows would be read twice or lost. Numbers,
dates and timestamps are cut at quantiles of the column, from Spark's mergeable
quantile sketch; text keys are dealt by a hash, which keeps neighbouring keys
apart but needs no order of the database's collation.
"""

from __future__ import annotations

import datetime
import decimal
import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sql_literal(v: object) -> str:
    """``v`` as an ANSI SQL literal, exactly."""
    if isinstance(v, bool):
        raise ValueError("a boolean column cannot be cut into ranges")
    if isinstance(v, datetime.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, datetime.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, float):
        if not math.isfinite(v):
            raise ValueError(f"{v} cannot bound a range")
        return f"{v!r}E0" if "e" not in repr(v) else repr(v)
    if isinstance(v, (int, decimal.Decimal)):
        return str(v)
    raise ValueError(f"a {type(v).__name__} column cannot be cut into ranges; deal it by hash")


def quantile_cuts(df: DataFrame, column: str, n: int, accuracy: int | None = None) -> list[object]:
    """At most ``n - 1`` distinct values that cut ``column`` into ranges of about equally many rows.

    One aggregate over that column. The sketch errs by rows / ``accuracy`` ranks,
    by default a fiftieth of a range. A value that fills several ranges is one
    cut, so such a column gives fewer ranges. NaN counts as the largest value.
    """
    if n < 1:
        raise ValueError("the number of ranges must be >= 1")
    dt = df.schema[column].dataType
    if not isinstance(dt, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{column} is {dt.simpleString()}: deal it by hash")
    own = F.col(f"`{column}`")
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        own = F.when(~F.isnan(own) & (F.abs(own) != F.lit(float("inf"))), own)
    shares = [i / n for i in range(1, n)]
    if not shares:
        return []
    found = df.agg(F.percentile_approx(own, shares, accuracy or 50 * n).alias("cuts"), F.min(own).alias("least")).first()
    # The least value begins the first range anyway: as a cut it would leave an empty one.
    return [c for c in sorted(set(found["cuts"] or [])) if c != found["least"]]


def range_predicates(column: str, cuts: Sequence[object], literal: Callable[[object], str] = sql_literal) -> list[str]:
    """Disjoint WHERE clauses between the ``cuts``; together they hold every row.

    The first takes what lies below the first cut, and the NULL keys; a value
    equal to a cut begins its range. ``column`` and ``literal`` are in the SQL
    of the database that runs them.
    """
    ends = [literal(c) for c in cuts]
    if not ends:
        return ["1 = 1"]
    out = [f"({column} < {ends[0]} OR {column} IS NULL)"]
    out += [f"({column} >= {lo} AND {column} < {hi})" for lo, hi in zip(ends, ends[1:])]
    return [*out, f"({column} >= {ends[-1]})"]


def hash_predicates(column: str, n: int, bucket: str = "pmod(xxhash64({column}), {n})") -> list[str]:
    """Disjoint WHERE clauses that deal a text (or any) key by its hash; NULL keys go to the first.

    ``bucket`` is an expression of 0 to n - 1 in the SQL of the database that runs
    the clauses; the default is Spark's.
    """
    if n < 1:
        raise ValueError("the number of ranges must be >= 1")
    if n == 1:
        return ["1 = 1"]
    own = bucket.format(column=column, n=n)
    first = f"({column} IS NULL OR ({column} IS NOT NULL AND {own} = 0))"
    return [first, *[f"({column} IS NOT NULL AND {own} = {i})" for i in range(1, n)]]
