"""Global order from sketched bounds: one exchange, no sampling pass.

``ORDER BY`` samples its input to find range bounds, so the input runs twice or
is shuffled first. Where the keys were written before (a trial's ledger rows),
a mergeable quantile sketch (KLL) taken during that write gives the bounds; each
row then goes straight to its partition. A first key that fills whole partitions
on its own is cut by quantiles of the second key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of the sketch: ranks are right to about a thousandth.
SKETCH_K = 2048
#: Rows of a partition that are aimed at when there are fewer than the session's shuffle partitions would hold, and otherwise.
SMALL_ROWS, LARGE_ROWS = 50_000, 2_000_000
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class Bounds:
    """Ascending (first, second) keys at which partitions 1, 2, ... begin; ``second`` None is before all others."""

    cuts: tuple[tuple[int, int | None], ...]

    @property
    def partitions(self) -> int:
        return len(self.cuts) + 1


def sketch(column: str) -> Column:
    return F.kll_sketch_agg_bigint(F.col(column).cast("bigint"), SKETCH_K)


def can_sketch(df: DataFrame, *columns: str) -> bool:
    kinds = dict(df.dtypes)
    return all(kinds[c] in _INTEGRAL for c in columns)


def wanted_partitions(rows: int, shuffle_partitions: int) -> int:
    return max(1, min(-(-rows // SMALL_ROWS), max(shuffle_partitions, -(-rows // LARGE_ROWS))))


def _quantiles(spark, packed, ranks: list[float]) -> list[int]:
    listed = ", ".join(f"{r!r}D" for r in ranks)
    return [int(v) for v in spark.sql(f"SELECT kll_sketch_get_quantile_bigint(:s, array({listed})) AS q", args={"s": bytearray(packed)}).first()[0]]


def bounds(keys: DataFrame, first: str, second: str, packed, rows: int, partitions: int) -> Bounds:
    """Cuts for ``partitions`` parts of about equal size; ``packed`` is the sketch of ``first`` over the ``rows`` rows of ``keys``.

    At most two values for each partition come to the driver.
    """
    if partitions < 2 or not rows or packed is None:
        return Bounds(())
    found = _quantiles(keys.sparkSession, packed, [i / partitions for i in range(1, partitions)])
    times = {v: found.count(v) for v in found}
    busy = {v: n for v, n in times.items() if n > 1}
    cuts: set[tuple[int, int | None]] = {(v, None) for v in found}
    if busy:
        per = keys.where(F.col(first).isin(list(busy))).groupBy(first).agg(sketch(second).alias("s"), F.count(F.col(second)).alias("n"))
        for row in per.where("n > 0").collect():
            parts = busy[row[0]] + 1
            cuts |= {(int(row[0]), v) for v in _quantiles(keys.sparkSession, row["s"], [i / parts for i in range(1, parts)])}
        cuts |= {(v + 1, None) for v in busy}  # what follows a busy key begins anew
    return Bounds(tuple(sorted(cuts, key=lambda c: (c[0], c[1] is not None, c[1] or 0))))


def _at_or_below(first: Column, second: Column, cuts) -> Column:
    """How many of the cuts a row's keys are not before."""
    if not cuts:
        return F.lit(0)
    listed = F.array(*[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b")) for a, b in cuts])
    row = F.struct(first.cast("bigint").alias("a"), second.cast("bigint").alias("b"))
    return F.size(F.filter(listed, lambda c: c <= row))


def partition_of(first: Column, second: Column, at: Bounds) -> Column:
    """The partition of a row: found among about the square root of the cuts, then among those up to the next."""
    cuts = at.cuts
    if len(cuts) <= 32:
        return _at_or_below(first, second, cuts).cast("int")
    step = int(len(cuts) ** 0.5)
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    coarse = _at_or_below(first, second, [b[0] for b in blocks])
    kind = "array<array<struct<a:bigint,b:bigint>>>"
    listed = F.array(*[F.array(*[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b")) for a, b in block]) for block in blocks]).cast(kind)
    row = F.struct(first.cast("bigint").alias("a"), second.cast("bigint").alias("b"))
    inner = F.size(F.filter(F.element_at(listed, F.greatest(coarse, F.lit(1))), lambda c: c <= row))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + inner).cast("int")


def ordered(df: DataFrame, first: str, second: str, at: Bounds) -> DataFrame:
    """``df`` in the global order of its two keys, nulls first: partition by partition, one exchange."""
    dealt = df.repartitionById(at.partitions, partition_of(F.col(first), F.col(second), at))
    return dealt.sortWithinPartitions(first, second)
