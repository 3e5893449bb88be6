"""Small helpers for generating Spark SQL text.

Plans are stated as Spark SQL built from fragments and run with one
``spark.sql`` call: parsing and analysing one statement is far cheaper than
analysing a DataFrame after each of dozens of chained calls. Values that
come from users (trial codes) are bound as named parameters; fixed values
(exclusion lists, regexes) are quoted here.
"""

from __future__ import annotations

import re
import uuid
import weakref
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

_TABLE_REF = re.compile(r"\{(\w+)\}")
# DataFrame (by identity, weakly held) -> the temp view it was registered as.
_VIEWS: dict[int, tuple[weakref.ref, str]] = {}


def quote(text: str) -> str:
    """A Spark SQL string literal for ``text`` (backslash-escaping dialect)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


def spread(key: str, salt_cols: Sequence[str], data_type: str) -> str:
    """``key``, or a per-row hash when ``key`` is NULL (see operators.joins).

    Use together with ``<key> IS NOT NULL`` in the join condition, so the
    hash spreads NULL-key rows over all shuffle partitions but never matches.
    """
    salts = ", ".join(salt_cols)
    if data_type == "bigint":
        return f"coalesce({key}, xxhash64({salts}))"
    if data_type == "int":
        return f"coalesce({key}, hash({salts}))"
    if data_type == "string":
        return f"coalesce({key}, CAST(xxhash64({salts}) AS STRING))"
    if found := re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", data_type):
        digits = min(int(found[1]) - int(found[2]), 18)
        return f"coalesce({key}, CAST(pmod(xxhash64({salts}), {10 ** digits}) AS {data_type}))"
    return key


def hint(names: Iterable[str]) -> str:
    names = [n for n in names if n]
    return f"/*+ BROADCAST({', '.join(names)}) */" if names else ""


def view_name(df: DataFrame) -> str:
    """A session temp view for ``df``, registered the first time it is seen.

    Binding DataFrames through ``spark.sql(text, name=df)`` registers and
    drops a view per DataFrame on every call; the LIMS tables are reused by
    every query, so registering each once saves that work per plan.
    """
    entry = _VIEWS.get(id(df))
    if entry is not None and entry[0]() is df:
        return entry[1]
    name = f"vialflow_{uuid.uuid4().hex[:16]}"
    df.createOrReplaceTempView(name)
    _VIEWS[id(df)] = (weakref.ref(df), name)
    return name


def run(spark: SparkSession, text: str, tables: Mapping[str, DataFrame], args: Mapping | None = None) -> DataFrame:
    """``spark.sql`` with ``{NAME}`` placeholders bound to ``tables``."""
    names = {name: view_name(tables[name]) for name in set(_TABLE_REF.findall(text))}
    bound = _TABLE_REF.sub(lambda m: names[m.group(1)], text)
    return spark.sql(bound, args=dict(args) if args else None)
