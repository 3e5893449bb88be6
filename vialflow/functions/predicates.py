"""Null-aware predicates and the viability flag.

Spark's three-valued logic differs from the pandas rules the viability flag
was defined with; each expression below is a never-NULL boolean with the
pandas meaning:

* ``x NOT IN list``: a NULL ``x`` is *not* in a list without ``None`` (true),
  and *is* in a list that holds ``None`` (false). Spark's ``NOT IN`` gives
  NULL for the first and NULL for every non-member once the list holds NULL.
* missing: NULL, and for floating types also NaN (Spark orders NaN above all
  numbers, so ``NaN > 0`` is true there).

Each is defined once as SQL text (``*_sql``); the DataFrame helpers wrap it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sqltext import in_list

# The default exclusion lists of the original job.
DEFAULT_EXCLUDE_CONDITIONS = ("SNR", "QNSR", "QNS", "NSI")
DEFAULT_EXCLUDE_MATCODES = ("100x100Box", None)


def not_in_sql(col: str, values: Iterable) -> str:
    """``col`` is not a member of ``values``; never NULL (see module doc)."""
    values = list(values)
    concrete = [v for v in values if v is not None]
    parts = []
    if concrete:
        parts.append(f"NOT coalesce({col} IN {in_list(concrete)}, false)")
    if len(concrete) != len(values):
        parts.append(f"{col} IS NOT NULL")
    return "(" + " AND ".join(parts) + ")" if parts else "true"


def is_missing_sql(col: str, floating: bool) -> str:
    """NULL, or NaN for float/double columns."""
    return f"({col} IS NULL OR isnan({col}))" if floating else f"({col} IS NULL)"


def is_positive_sql(col: str, floating: bool) -> str:
    """Strictly positive and present; NaN and NULL are not positive."""
    nan = f" AND NOT isnan({col})" if floating else ""
    return f"coalesce({col} > 0{nan}, false)"


def viable_sql(
    floating_amount: bool,
    exclude_conditions: Iterable = DEFAULT_EXCLUDE_CONDITIONS,
    exclude_matcodes: Iterable = DEFAULT_EXCLUDE_MATCODES,
) -> str:
    """Viable = box material not excluded and present, neither condition
    excluded, amount present and positive. Never NULL."""
    conds = list(exclude_conditions)
    parts = [
        not_in_sql("MATCODE", exclude_matcodes),
        "MATCODE IS NOT NULL",
        not_in_sql("RECEIVED_CONDITION", conds),
        not_in_sql("SAMPLE_CONDITION", conds),
        f"NOT {is_missing_sql('AMOUNTLEFT', floating_amount)}",
        is_positive_sql("AMOUNTLEFT", floating_amount),
    ]
    return "coalesce(" + " AND ".join(parts) + ", false)"


def reason_sqls(
    floating_amount: bool,
    exclude_conditions: Iterable = DEFAULT_EXCLUDE_CONDITIONS,
    exclude_matcodes: Iterable = DEFAULT_EXCLUDE_MATCODES,
) -> dict[str, str]:
    """One never-NULL boolean per reason a vial is not viable."""
    conds = list(exclude_conditions)
    mats = [m for m in exclude_matcodes if m is not None]
    missing = is_missing_sql("AMOUNTLEFT", floating_amount)
    return {
        "MATCODE_EXCLUDED": f"NOT {not_in_sql('MATCODE', mats)}",
        "MATCODE_MISSING": "MATCODE IS NULL",
        "RECEIVED_CONDITION_EXCLUDED": f"NOT {not_in_sql('RECEIVED_CONDITION', conds)}",
        "SAMPLE_CONDITION_EXCLUDED": f"NOT {not_in_sql('SAMPLE_CONDITION', conds)}",
        "AMOUNT_MISSING": missing,
        "AMOUNT_NOT_POSITIVE": f"(NOT {missing} AND NOT {is_positive_sql('AMOUNTLEFT', floating_amount)})",
    }


def is_floating(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType))


def not_in(col: str, values: Iterable) -> Column:
    return F.expr(not_in_sql(col, values))


def is_missing(col: str, data_type: T.DataType | None = None) -> Column:
    return F.expr(is_missing_sql(col, isinstance(data_type, (T.DoubleType, T.FloatType))))


def is_positive(col: str, data_type: T.DataType | None = None) -> Column:
    return F.expr(is_positive_sql(col, isinstance(data_type, (T.DoubleType, T.FloatType))))


def viability_reasons(
    df: DataFrame,
    exclude_conditions: Iterable = DEFAULT_EXCLUDE_CONDITIONS,
    exclude_matcodes: Iterable = DEFAULT_EXCLUDE_MATCODES,
) -> dict[str, Column]:
    sqls = reason_sqls(is_floating(df, "AMOUNTLEFT"), exclude_conditions, exclude_matcodes)
    return {name: F.expr(sql) for name, sql in sqls.items()}


def viable(
    df: DataFrame,
    exclude_conditions: Iterable = DEFAULT_EXCLUDE_CONDITIONS,
    exclude_matcodes: Iterable = DEFAULT_EXCLUDE_MATCODES,
) -> Column:
    return F.expr(viable_sql(is_floating(df, "AMOUNTLEFT"), exclude_conditions, exclude_matcodes))


def flag_viable(
    df: DataFrame,
    exclude_conditions: Iterable = DEFAULT_EXCLUDE_CONDITIONS,
    exclude_matcodes: Iterable = DEFAULT_EXCLUDE_MATCODES,
) -> DataFrame:
    """Add the boolean ``VIABLE`` column; rows are never dropped."""
    return df.withColumn("VIABLE", viable(df, exclude_conditions, exclude_matcodes))
