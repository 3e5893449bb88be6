"""Size-checked broadcast.

A side is broadcast only when the optimizer's size estimate, inflated for
Parquet compression, is under a limit. Beyond the limit the frame is
returned untouched and the planner shuffles; AQE then still converts the
join to a broadcast at runtime if the *measured* shuffle output is small
(``spark.sql.adaptive.autoBroadcastJoinThreshold``), which is how filtered
fact sides such as one trial's receipts get broadcast without a guess.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import DIMENSION_TABLES, UNKNOWN_SIZE, plan_bytes

# Default limit for an explicit broadcast of a dimension (bytes, in memory).
DEFAULT_LIMIT = 64 * 1024 * 1024
# In-memory rows are several times larger than the compressed file bytes the
# estimate for a file scan is based on.
INFLATION = 8.0
CONF_LIMIT = "vialflow.broadcast.maxBytes"


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (no job is run)."""
    return plan_bytes(df)


def leaf_bytes(df: DataFrame) -> int:
    """Sum of the size estimates of the plan's leaf scans.

    For a dimension built as a chain of key lookups (each row finds at most
    one partner per level), the output is no larger than its inputs; without
    CBO Catalyst would instead estimate a join as the product of its sides.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except Exception:  # noqa: BLE001 - no plan access: treat as large
        return UNKNOWN_SIZE


def broadcast_limit(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get(CONF_LIMIT, None)
    return int(raw) if raw else DEFAULT_LIMIT


def fits_broadcast(df: DataFrame, limit: int | None = None, *, lookup_chain: bool = False) -> bool:
    limit = broadcast_limit(df) if limit is None else limit
    size = leaf_bytes(df) if lookup_chain else estimated_bytes(df)
    return size * INFLATION <= limit


# Row bound of a dimension that may be broadcast, beside its bytes.
DEFAULT_MAX_ROWS = 1_000_000
CONF_MAX_ROWS = "vialflow.broadcast.maxRows"


def tables_fit(t, names, limit: int | None = None, collation: str | None = None) -> bool:
    """Whether a dimension built from the base tables ``names`` may be broadcast.

    A chain of key lookups has at most as many rows as its inputs if each key
    that is looked up occurs once; so dimensions count by their measured bytes,
    and only with unique keys (see :meth:`LimsTables.measure`). Tables that are
    no dimensions count by the optimizer's estimate, inflated for compression.
    """
    frames = [t[n] for n in names]
    limit = broadcast_limit(frames[0]) if limit is None else limit
    others = [n for n in names if n not in DIMENSION_TABLES]
    size = sum(t.table_bytes(n) for n in others) * INFLATION
    if size > limit:
        return False
    found = [t.measure(n, collation) for n in names if n in DIMENSION_TABLES]
    if any(m is None or not m.unique for m in found):
        return False
    raw = frames[0].sparkSession.conf.get(CONF_MAX_ROWS, None)
    cap = int(raw) if raw else DEFAULT_MAX_ROWS
    return sum(m.rows for m in found) <= cap and size + sum(m.bytes for m in found) <= limit


def sized_broadcast(df: DataFrame, limit: int | None = None, *, lookup_chain: bool = False) -> DataFrame:
    """``broadcast(df)`` if its estimated size is within ``limit``, else ``df``.

    ``lookup_chain`` sizes a pre-joined dimension by its inputs (see
    :func:`leaf_bytes`).
    """
    return F.broadcast(df) if fits_broadcast(df, limit, lookup_chain=lookup_chain) else df
