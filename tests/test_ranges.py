"""Global order from sketched bounds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vialflow.operators.ranges import Bounds, bounds, ordered, partition_of, sketch, wanted_partitions
from vialflow.plans.history import inventory_history
from vialflow.plans.inventory import materialize_trial_vials


def cut(df, parts):
    packed, n = df.agg(sketch("a"), F.count(F.lit(1))).first()
    return bounds(df, "a", "b", packed, n, parts)


@pytest.mark.parametrize("parts", [1, 2, 7, 200])
def test_rows_come_in_order_and_evenly(spark, parts):
    n = 20_000
    even = spark.range(n).select((F.col("id") * 7919 % 10_007 - 5000).alias("a"), F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 977).alias("b"))
    busy = even.withColumn("a", F.when(F.col("b") % 2 == 0, F.lit(17)).otherwise(F.col("a")))  # half of the rows share a first key
    for df in (even, busy):
        at = cut(df, parts)
        assert parts <= at.partitions <= 2 * parts + 1 or parts == 1
        rows = ordered(df, "a", "b", at).withColumn("p", F.spark_partition_id()).collect()
        keys = [(r.a, r.b is not None, r.b or 0) for r in rows]
        assert keys == sorted(keys) and len(keys) == n
        sizes = [sum(1 for r in rows if r.p == p) for p in {r.p for r in rows}]
        if parts <= 7:
            assert max(sizes) < 2 * n / parts + 200


def test_partitions_follow_the_cuts(spark):
    cuts = tuple(sorted({(i * 3, None) for i in range(40)} | {(30, j * 10) for j in range(30)}, key=lambda c: (c[0], c[1] is not None, c[1] or 0)))
    df = spark.range(-5, 130).select(F.col("id").alias("a")).crossJoin(spark.createDataFrame([(None,), (0,), (95,), (1000,)], "b long"))
    got = df.select("a", "b", partition_of(F.col("a"), F.col("b"), Bounds(cuts)).alias("p")).collect()
    order = lambda a, b: (a, b is not None, b or 0)
    assert all(r.p == sum(order(*c) <= order(r.a, r.b) for c in cuts) for r in got)


def test_history_is_shuffled_once(spark, tables):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    v = materialize_trial_vials(tables, "BUILDING")
    df = inventory_history(tables, "BUILDING", vials=v)
    plan = df._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.splitlines() if "Exchange" in x and "Broadcast" not in x and "Reused" not in x]
    # the other shuffles are of ids and dimensions: one alone carries the history's columns
    wide = [x for x in shuffles if "TRANSACTION_TYPE" in x or "REPARTITION_BY_NUM" in x]
    assert len(wide) == 1 and "rangepartitioning" not in plan
    keys = [(r.INVENTORYID, r.TRANSACTION_ID) for r in df.select("INVENTORYID", "TRANSACTION_ID").collect()]
    assert keys == sorted(keys) and len(keys) == 1336


def test_number_of_partitions():
    assert wanted_partitions(0, 200) == 1 and wanted_partitions(1000, 8) == 1
    assert wanted_partitions(10**6, 8) == 8 and wanted_partitions(10**9, 200) == 500 and wanted_partitions(10**6, 20_000) == 20
