"""Scalar column expressions of the two extraction queries (SQL text + Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_int_sql(col: str, empty_as_zero: bool = False) -> str:
    """String -> INT, NULL when the text is not an integer in range.

    Spark's ANSI ``try_cast`` trims blanks and accepts a sign; decimals,
    exponents, overflow and ``''`` give NULL. ``empty_as_zero`` mimics the
    SQL Server rule that turns a blank string into 0.
    """
    value = f"try_cast({col} AS INT)"
    if empty_as_zero:
        value = f"CASE WHEN trim({col}) = '' THEN 0 ELSE {value} END"
    return value


def grid_ordinal_sql(pos_y: str, pos_x: str, x_size: str) -> str:
    """Row-major 1-based cell number ``(y - 1) * x_size + x``; NULL if any input is."""
    return f"(({pos_y} - 1) * {x_size} + {pos_x})"


def safe_int(col: str, empty_as_zero: bool = False) -> Column:
    return F.expr(safe_int_sql(col, empty_as_zero))


def grid_ordinal(pos_y: str, pos_x: str, x_size: str) -> Column:
    return F.expr(grid_ordinal_sql(pos_y, pos_x, x_size))


def round_half_even(x: Column | str, digits: int = 2) -> Column:
    """Round a double to ``digits`` decimals exactly as Python's ``round`` does.

    Python rounds the exact binary value of ``x``; Spark's ``bround`` rounds
    its shortest decimal text, so the two differ on "false ties" such as
    ``107 / 4000 * 100`` (prints as 2.675, is slightly less: Python 2.67).
    Here ``x * 10**digits`` is formed without error as ``p + e`` (Dekker's
    split of ``x``; plain IEEE double operations, no UDF). Only when ``p``
    lands exactly on a half does ``e`` decide the direction; otherwise
    ``rint(p)`` is already the correctly rounded result.
    """
    x = F.col(x) if isinstance(x, str) else x
    scale = 10.0 ** digits
    c = x * F.lit(134217729.0)  # 2**27 + 1
    hi = c - (c - x)
    lo = x - hi
    p = x * F.lit(scale)
    e = (hi * F.lit(scale) - p) + lo * F.lit(scale)
    f = F.floor(p).cast("double")
    tie = (p - f) == F.lit(0.5)
    n = F.when(tie & (e > 0), f + F.lit(1.0)).when(tie & (e < 0), f).otherwise(F.rint(p))
    return n / F.lit(scale)
