"""Join building blocks for the extraction plans.

* :func:`left_lookup` - left outer equi-join to a dimension (J3/J8), with a
  size-checked broadcast and NULL keys spread over all shuffle partitions.
* :func:`parent_container_join` - the correlated "parent box, not itself"
  lookup (J4) as an equi hash join with a residual ``<>``.
* :func:`expand_fanout` - replays the row multiplication of a join whose
  columns are never selected (J5) from a pre-aggregated count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .broadcast import sized_broadcast


def spread_key(key: Column, salt_cols: Sequence[str], data_type: T.DataType) -> Column:
    """``key``, or for a NULL key a per-row hash of ``salt_cols``.

    A NULL key never matches, but in a shuffle join every NULL-key row lands
    in the same partition; if a third of the rows have no box (or no
    location), that one task would get a third of the data. Replacing the
    NULL by a row hash spreads them evenly; the join condition keeps
    ``key IS NOT NULL`` so a hash that equals a real key matches nothing.
    """
    cols = [F.col(c) for c in salt_cols]
    if isinstance(data_type, T.LongType):
        salt = F.xxhash64(*cols)
    elif isinstance(data_type, T.IntegerType):
        salt = F.hash(*cols)
    elif isinstance(data_type, T.StringType):
        salt = F.xxhash64(*cols).cast("string")
    elif isinstance(data_type, T.DecimalType):
        digits = min(data_type.precision - data_type.scale, 18)
        salt = F.pmod(F.xxhash64(*cols), F.lit(10**digits)).cast(data_type)
    else:
        return key
    return F.coalesce(key, salt)


def left_lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    *,
    salt_cols: Sequence[str] = (),
    extra: Column | None = None,
    broadcast: bool = True,
    keep_key: bool = True,
    lookup_chain: bool = False,
) -> DataFrame:
    """``fact LEFT JOIN dim ON fact_key = dim_key [AND extra]``.

    ``dim`` is broadcast when its size is checked small; otherwise a shuffle
    join runs with NULL fact keys spread by ``salt_cols`` (if given). The
    dimension's key column stays unless ``keep_key=False`` (callers project
    their output columns at the end anyway).
    """
    side = sized_broadcast(dim, lookup_chain=lookup_chain) if broadcast else dim
    key_type = fact.schema[fact_key].dataType
    if salt_cols:
        probe = spread_key(F.col(fact_key), salt_cols, key_type)
        cond = (side[dim_key] == probe) & fact[fact_key].isNotNull()
    else:
        cond = side[dim_key] == fact[fact_key]
    if extra is not None:
        cond = cond & extra
    joined = fact.join(side, cond, "left")
    return joined if keep_key else joined.drop(side[dim_key])


def parent_container_join(
    rows: DataFrame,
    boxes: DataFrame,
    *,
    self_col: str,
    container_col: str = "CONTAINER_INVENTORYID",
    box_id: str = "PARENT_CONTAINER_INV_ID",
    salt_cols: Sequence[str] = (),
    lookup_chain: bool = True,
) -> DataFrame:
    """Attach the containing box, never the row's own inventory item.

    Same rows as ``OUTER APPLY (SELECT .. FROM INVENTORY PI WHERE PI.id =
    row.container AND PI.id <> row.self)``: a left join on the container id
    with a residual ``<>``; the box id stays in the output (NULL when no box).
    """
    key_type = rows.schema[container_col].dataType
    if salt_cols:
        probe = spread_key(F.col(container_col), salt_cols, key_type)
        cond = (boxes[box_id] == probe) & rows[container_col].isNotNull()
    else:
        cond = boxes[box_id] == rows[container_col]
    cond = cond & (boxes[box_id] != rows[self_col])
    return rows.join(sized_broadcast(boxes, lookup_chain=lookup_chain), cond, "left")


def fanout_sql(count_col: str) -> str:
    """Array with ``max(count, 1)`` elements, for ``LATERAL VIEW explode``."""
    n = f"coalesce({count_col}, 0)"
    return f"CASE WHEN {n} > 1 THEN array_repeat(true, CAST({n} AS INT)) ELSE array(true) END"


def expand_fanout(df: DataFrame, count_col: str) -> DataFrame:
    """Repeat each row ``max(count, 1)`` times, then drop ``count_col``.

    A left join to ``k`` matching rows whose columns are never selected
    yields ``k`` identical copies (one when ``k`` is 0). Counting first and
    replaying the copies at the end keeps every upstream join one row per
    key and moves no duplicate through a shuffle.
    """
    return df.withColumn("_COPY", F.explode(F.expr(fanout_sql(count_col)))).drop("_COPY", count_col)
