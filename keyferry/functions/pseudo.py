"""Deterministic pseudo-random values from row ids.

A draw is 32 bits of an md5 digest of the row's id. Four draws are cut from one
digest, which Spark computes once per row, so draws with different salts are
independent of each other, have no short period, and come out the same in Spark
and in any SQL engine that has md5. A draw among as many values as a table has
rows takes 60 bits of a digest of its own. Every value depends only on
the row's id (no seed state, any partitioning, re-runs give the same rows).

Each helper exists twice: as a Spark ``Column`` and as SQL text (used by the
checks that compare Spark output with an independent engine).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 8  # of a draw; a digest holds four
WIDE_DIGITS = 15  # 60 bits stay inside a signed 64-bit integer
# A prime (2^61 - 1) above any row count: steps modulo n with it visit n different values.
PRIME = 2305843009213693951


def _place(salt: int) -> tuple[str, int]:
    """Suffix of the digest's text and first digit of the draw."""
    return f":{salt // 4}", 1 + HEX_DIGITS * (salt % 4)


def mix(x: Column, salt: int) -> Column:
    """A draw for id ``x``: an integer in [0, 2^32)."""
    suffix, at = _place(salt)
    digest = F.md5(F.concat(x.cast("string"), F.lit(suffix)))
    return F.conv(F.substring(digest, at, HEX_DIGITS), 16, 10).cast("bigint")


def mix_sql(x: str, salt: int) -> str:
    suffix, at = _place(salt)
    return f"CAST('0x' || substr(md5(CAST(({x}) AS VARCHAR) || '{suffix}'), {at}, {HEX_DIGITS}) AS BIGINT)"


def mix_wide(x: Column, salt: int) -> Column:
    """A draw for id ``x`` among many values: an integer in [0, 2^60)."""
    digest = F.md5(F.concat(x.cast("string"), F.lit(f":wide{salt}")))
    return F.conv(F.substring(digest, 1, WIDE_DIGITS), 16, 10).cast("bigint")


def mix_wide_sql(x: str, salt: int) -> str:
    return f"CAST('0x' || substr(md5(CAST(({x}) AS VARCHAR) || ':wide{salt}'), 1, {WIDE_DIGITS}) AS BIGINT)"


def between(h: Column, lo: int, hi: int) -> Column:
    """Integer in the closed range [lo, hi]."""
    return F.lit(lo) + h % F.lit(hi - lo + 1)


def between_sql(h: str, lo: int, hi: int) -> str:
    return f"({lo} + ({h}) % {hi - lo + 1})"


def pick(words: Sequence[str], h: Column) -> Column:
    """One element of ``words`` chosen by ``h``, NULL by no draw (``element_at`` takes the last then)."""
    return F.get(F.array(*[F.lit(w) for w in words]), (h % F.lit(len(words))).cast("int"))


def _sql_str(w: str) -> str:
    return "'" + w.replace("'", "''") + "'"


def pick_sql(words: Sequence[str], h: str) -> str:
    arr = "[" + ", ".join(_sql_str(w) for w in words) + "]"
    return f"({arr})[CAST(({h}) % {len(words)} + 1 AS INTEGER)]"


def sql_str(w: str) -> str:
    return _sql_str(w)
