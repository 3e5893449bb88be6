"""Scale properties: hot NULL keys, what may be broadcast, plan shape without broadcasts."""

from __future__ import annotations

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vialflow.functions.predicates import flag_viable
from vialflow.operators.joins import parent_container_join


def _partition_sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_null_keys_spread_over_partitions(spark):
    """A third of the rows have no box; in a shuffle join they must not land in one task."""
    rows = spark.range(0, 30000).select(
        F.col("id").alias("INVENTORYID"),
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("bigint")).otherwise(F.col("id") % 500 + 1_000_000)
        .alias("CONTAINER_INVENTORYID"),
    )
    boxes = spark.range(1_000_000, 1_000_500).select(
        F.col("id").alias("PARENT_CONTAINER_INV_ID"), F.concat(F.lit("B"), F.col("id")).alias("BOX_CODE")
    )
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "vialflow.broadcast.maxBytes": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        spread = parent_container_join(rows, boxes, self_col="INVENTORYID", salt_cols=("INVENTORYID",))
        plain = parent_container_join(rows, boxes, self_col="INVENTORYID")
        spread_sizes, plain_sizes = _partition_sizes(spread), _partition_sizes(plain)
        assert "SortMergeJoin" in spread._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sum(spread_sizes) == sum(plain_sizes) == 30000
    assert max(plain_sizes) >= 10000                    # without spreading: all NULL keys in one task
    assert max(spread_sizes) < 2 * 30000 / len(spread_sizes)  # with spreading: close to even


def test_scale_plan_broadcasts_only_dimensions(spark, tables):
    from vialflow.plans.history import inventory_history
    from vialflow.plans.inventory import trial_extract

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("vialflow.broadcast.maxBytes", str(64 * 1024))
    try:
        for df in (trial_extract(tables, "BUILDING"), inventory_history(tables, "BUILDING")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan
            for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "SinglePartition"):
                assert bad not in plan
            # no broadcast exchange sits directly over a fact-table scan
            lines = plan.splitlines()
            for i, line in enumerate(lines):
                if "BroadcastExchange" in line:
                    below = " ".join(lines[i + 1:i + 4])
                    assert "lineitem" not in below and "o_custkey" not in below
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("vialflow.broadcast.maxBytes")


# --- viability flag against pandas membership / missing rules --------------------------------

MATS = st.sampled_from(["Box", "100x100Box", "box", "Tray", None])
CONDS = st.sampled_from(["Good", "SNR", "snr", "QNS", "QNSR", "NSI", None])
AMOUNTS = st.sampled_from([1.0, 0.0, -2.0, 0.5, float("nan"), None])


def _missing(v) -> bool:
    return v is None or (isinstance(v, float) and math.isnan(v))


def _member(value, values) -> bool:
    # pandas Series.isin: a missing value is a member iff the list holds a missing value
    s = pd.Series([value], dtype=object)
    return bool(s.isin(values).iloc[0])


def _expected(row, conds, mats) -> bool:
    mat, rc, sc, amount = row
    return (not _member(mat, mats) and not _missing(mat) and not _member(rc, conds) and not _member(sc, conds)
            and not _missing(amount) and amount > 0)


@settings(max_examples=25, deadline=None)
@given(
    rows=st.lists(st.tuples(MATS, CONDS, CONDS, AMOUNTS), min_size=1, max_size=12),
    conds=st.lists(CONDS, max_size=4),
    mats=st.lists(MATS, max_size=3),
)
def test_viable_matches_pandas_rules(spark, rows, conds, mats):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, MATCODE string, RECEIVED_CONDITION string, SAMPLE_CONDITION string, AMOUNTLEFT double",
    )
    got = {r.i: r.VIABLE for r in flag_viable(df, conds, mats).collect()}
    assert got == {i: _expected(r, conds, mats) for i, r in enumerate(rows)}


def test_nullable_foreign_keys_shuffle_spread(spark, tables):
    """At scale, shuffles on nullable foreign keys use the spread key.

    (Names such as LOCATIONCODE also occur as a dimension's own key on the
    build side, which is rightly shuffled as is; CONTAINER_INVENTORYID and
    PARENT_LOCATION_CODE occur only on the probe side.)
    """
    import re

    from vialflow.plans.history import inventory_history
    from vialflow.plans.inventory import trial_extract

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("vialflow.broadcast.maxBytes", "1")
    spark.conf.set("vialflow.broadcast.maxRows", "0")
    try:
        expected = {
            "snapshot": ("CONTAINER_INVENTORYID", "LOCATIONCODE", "CONTCODE", "PARENT_LOCATION_CODE", "MATCODE"),
            "history": ("CONTAINER_INVENTORYID", "LOCATIONCODE", "TRANSACTION_ID", "MATCODE"),
        }
        for name, df in (("snapshot", trial_extract(tables, None)), ("history", inventory_history(tables, "BUILDING"))):
            plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
            keys = re.findall(r"Exchange hashpartitioning\(([^\n]*?), \d+\)", plan)
            for fk in expected[name]:
                # rows of a heavy box are spread like rows in no box
                spread = rf"coalesce\((if \(isnull\(PARENT_CONTAINER_INV_ID\)\) )?{fk}(,| else null,)"
                assert any(re.match(spread, k) for k in keys), (name, fk, keys)
            for probe_only in ("CONTAINER_INVENTORYID", "PARENT_LOCATION_CODE"):
                assert probe_only not in keys, (name, probe_only)
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "vialflow.broadcast.maxBytes", "vialflow.broadcast.maxRows"):
            spark.conf.unset(k)
