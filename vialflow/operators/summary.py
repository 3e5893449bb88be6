"""Viability summaries and extraction metrics.

All are single aggregations with map-side partial aggregation: a trial or
site holding a third of all rows costs one partial row per task, never a
hot reducer.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.predicates import DEFAULT_EXCLUDE_CONDITIONS, DEFAULT_EXCLUDE_MATCODES, viability_reasons
from ..functions.scalar import round_half_even


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole * 100`` rounded like Python's ``round`` (half-even on the
    exact double), and 0.0 when ``whole`` is 0."""
    ratio = part.cast("double") / whole.cast("double") * F.lit(100.0)
    return F.when(whole > 0, round_half_even(ratio, digits)).otherwise(F.lit(0.0))


def viability_aggs() -> list[Column]:
    not_viable = F.count_if(~F.col("VIABLE"))
    total = F.count(F.lit(1))
    return [
        not_viable.alias("NOT_VIABLE"),
        total.alias("TOTAL"),
        percent(not_viable, total).alias("PCT_NOT_VIABLE"),
    ]


def viability_summary(flagged: DataFrame) -> DataFrame:
    """One row: non-viable rows, all rows, percent non-viable (2 decimals)."""
    return flagged.agg(*viability_aggs())


def viability_by(
    flagged: DataFrame,
    keys: Sequence[str],
    exclude_conditions: Iterable = DEFAULT_EXCLUDE_CONDITIONS,
    exclude_matcodes: Iterable = DEFAULT_EXCLUDE_MATCODES,
) -> DataFrame:
    """Per-group viability with one count per reason (a row may have several)."""
    reasons = viability_reasons(flagged, exclude_conditions, exclude_matcodes)
    return flagged.groupBy(*keys).agg(
        *viability_aggs(), *[F.count_if(cond).alias(f"N_{name}") for name, cond in reasons.items()]
    )


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("N_ROWS")).select(F.lit(name).alias("DATASET"), "N_ROWS")


def observe_viability(flagged: DataFrame, name: str = "viability") -> tuple[DataFrame, Observation]:
    """Attach row / non-viable counters that fill in while the frame is written.

    No second pass: the counts ride along with the write job.
    """
    obs = Observation(name)
    return flagged.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("VIABLE")).alias("not_viable")), obs


def observe_rows(df: DataFrame, name: str, *more: Column) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *more), obs
