"""Bloom reducers and heavy boxes: the same rows, and even tasks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from vialflow.operators.reducers import CONF_MIN_BYTES, CONF_WORDS, bloom_join, bloom_sql, comparable_key, heavy_sql
from vialflow.plans.history import inventory_history
from vialflow.plans.inventory import materialize_trial_vials, parent_fanout, trial_extract, trial_inventory
from vialflow.sources.tables import LimsTables

BIG = {"spark.sql.autoBroadcastJoinThreshold": "-1", "vialflow.broadcast.maxBytes": "1", "vialflow.broadcast.maxRows": "0", CONF_MIN_BYTES: "0"}
BOX = 1_000_000_002


class conf:
    """Session settings inside a block."""

    def __init__(self, spark, values):
        self.spark, self.values = spark, values

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.values}
        for k, v in self.values.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.old.items():
            self.spark.conf.set(k, v) if v is not None else self.spark.conf.unset(k)


def hot(t: LimsTables) -> LimsTables:
    """Half of the ledger points at one box."""
    ledger = t["INVENTORY_TRANSACTIONS_VLA"]
    box = F.when(F.pmod(F.xxhash64("INVENTORYID", "TRANSACTION_ID"), F.lit(2)) == 0, F.lit(BOX)).otherwise(F.col("CONTAINER_INVENTORYID"))
    return LimsTables({**t.frames, "INVENTORY_TRANSACTIONS_VLA": ledger.withColumn("CONTAINER_INVENTORYID", box)})


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


def sizes(df) -> list[int]:
    got = {r["p"]: r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return list(got.values())


@pytest.mark.parametrize("words", [1, 64, 1 << 16])
def test_bloom_keeps_every_member_and_repeats_no_row(spark, words):
    ids = spark.range(0, 2000, 2).select((F.col("id") * 7919).alias("k"))
    ids.union(ids).union(spark.createDataFrame([(None,)], "k long")).createOrReplaceTempView("bloom_ids")
    spark.range(0, 40_000).select((F.col("id") * 7919 % 31_676_000).alias("x")).createOrReplaceTempView("bloom_rows")
    kept = spark.sql(f"WITH f AS ({bloom_sql('k', 'bloom_ids', words)}) SELECT /*+ BROADCAST(b) */ r.x FROM bloom_rows r {bloom_join('f', 'b', 'r.x', words)}")
    got = [r.x for r in kept.collect()]
    want = {r.k for r in ids.collect()}
    every = [r.x for r in spark.table("bloom_rows").collect()]
    assert want <= set(got) and len(got) <= len(every)
    assert sorted(x for x in got if x in want) == sorted(x for x in every if x in want)
    if words > 1000:
        assert len(got) < 1.1 * sum(x in want for x in every)


def test_keys_that_can_be_hashed_alike():
    assert comparable_key("int", "bigint") == "CAST({} AS BIGINT)" and comparable_key("string", "string") == "{}"
    assert comparable_key("decimal(10,0)", "decimal(10,0)") == "{}" and comparable_key("decimal(10,0)", "decimal(12,0)") is None
    assert comparable_key("double", "double") is None and comparable_key("string collate UTF8_LCASE", "string") is None


def test_heavy_keys_are_found_and_few(spark):
    spark.range(0, 100_000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id"))).alias("k")).createOrReplaceTempView("heavy_rows")
    got = [r.BOX_ID for r in spark.sql(heavy_sql("k", "heavy_rows", 16)).collect()]
    assert 7 in got and len(got) == len(set(got)) <= 4 * 16


def test_reduced_plans_give_the_same_rows(spark, tables):
    t = LimsTables(dict(tables.frames))
    plain = [rows_of(trial_extract(t, "BUILDING")), rows_of(inventory_history(t, "BUILDING")), rows_of(trial_inventory(t, None)), rows_of(parent_fanout(t))]
    for words in ("8", "65536"):
        with conf(spark, {**BIG, CONF_WORDS: words}):
            t = LimsTables(dict(tables.frames))  # sizes are remembered by table set
            inline = trial_extract(t, "BUILDING"), inventory_history(t, "BUILDING"), trial_inventory(t, None), parent_fanout(t)
            assert [rows_of(df) for df in inline] == plain
            v = materialize_trial_vials(t, "BUILDING")
            assert not v.broadcastable and not v.ledger_broadcastable
            assert rows_of(trial_extract(t, "BUILDING", vials=v)) == plain[0] and rows_of(inventory_history(t, "BUILDING", vials=v)) == plain[1]


def test_every_large_scan_of_a_trial_is_under_a_reducer(spark, tables):
    """The box inventory, its ledger count, sample containers, metadata and the ledger are cut with and without ``vials``."""
    with conf(spark, BIG):
        t = LimsTables(dict(tables.frames))
        v = materialize_trial_vials(t, "BUILDING")
        for df in (trial_extract(t, "BUILDING"), trial_extract(t, "BUILDING", vials=v)):
            text = df._jdf.queryExecution().analyzed().toString()
            for cut in ("vial_ids_SC", "vial_guids_M", "receipt_guids_M", "box_filter_INV", "box_filter_L"):
                assert f"SubqueryAlias {cut}" in text, cut
            plan = plan_of(df)
            # nothing of a filter is shuffled with a large table: its join is a broadcast on one long
            joins = [x for x in plan.splitlines() if re.search(r"BroadcastHashJoin \[pmod\(xxhash64", x) or "WORD#" in x and "BroadcastHashJoin" in x]
            assert len(joins) >= 5
        for df in (inventory_history(t, "BUILDING"), inventory_history(t, "BUILDING", vials=v)):
            text = df._jdf.queryExecution().analyzed().toString()
            assert "SubqueryAlias box_filter_INV" in text and "SubqueryAlias header_filter_H" in text


@pytest.mark.parametrize("trial", [None, "BUILDING"])
def test_hot_box_spreads(spark, trial):
    from vialflow.sources.fixtures import derive_lims_tables

    base = derive_lims_tables(spark, "/root/testdata/sf0.01")
    t = hot(base)
    want = rows_of(trial_extract(t, trial).select("VIAL_CONTAINER_INV_ID", "PARENT_CONTAINER_INV_ID", "BOX_NAME", "BOX_POS", "MATCODE"))
    # locations and the like may be broadcast, boxes may not: the box join is then the last shuffle
    values = {**BIG, "vialflow.broadcast.maxBytes": "500000", "vialflow.broadcast.maxRows": "20000", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}
    with conf(spark, values):
        t = hot(base)
        df = trial_extract(t, trial)
        assert "heavy_boxes" in df._jdf.queryExecution().analyzed().toString()
        even = sizes(df)
        assert max(even) < 2 * sum(even) / 16
        got = rows_of(df.select("VIAL_CONTAINER_INV_ID", "PARENT_CONTAINER_INV_ID", "BOX_NAME", "BOX_POS", "MATCODE"))
    assert got == want


def test_hot_box_of_the_fanout_spreads(spark):
    from vialflow.sources.fixtures import derive_lims_tables

    base = derive_lims_tables(spark, "/root/testdata/sf0.01")
    want = rows_of(parent_fanout(hot(base)))
    with conf(spark, {**BIG, "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}):
        df = parent_fanout(hot(base))
        even = sizes(df)
        assert max(even) < 2 * sum(even) / 16 and rows_of(df) == want
        # no box row is copied: the heavy ones are a broadcast, the others meet their rows once
        assert "sequence(" not in plan_of(df)
    # the box itself has one current row, so half of the rows are its own
    assert sum(str(BOX) in r for r in want) > 0.4 * len(want)


def hints(df) -> set[str]:
    """What the statement asks to broadcast."""
    return set(re.findall(r"SubqueryAlias (\w+)", "\n".join(re.findall(r"UnresolvedHint|ResolvedHint[^\n]*\n[^\n]*", df._jdf.queryExecution().analyzed().toString()))))


def test_broadcast_needs_measured_bytes_and_unique_keys(spark, tables):
    """A wide dimension, and one whose key repeats, get no hint; whatever their number of rows."""
    from vialflow.operators.broadcast import tables_fit

    locations = tables["LOCATIONS"]
    normal = LimsTables(dict(tables.frames))
    wide = LimsTables({**tables.frames, "LOCATIONS": locations.withColumn("LONGNAME", F.repeat(F.lit("x"), 100_000))})
    twice = LimsTables({**tables.frames, "LOCATIONS": locations.union(locations.limit(1))})
    letters = LimsTables({**tables.frames, "LOCATIONS": locations.union(locations.where("LOCATIONCODE = 'S1'").withColumn("LOCATIONCODE", F.lit("s1 ")))})
    with conf(spark, {"vialflow.broadcast.maxBytes": str(1 << 20)}):
        assert tables_fit(normal, ["LOCATIONS"]) and normal.measure("LOCATIONS").unique
        assert not tables_fit(wide, ["LOCATIONS"]) and wide.measure("LOCATIONS").bytes > 100_000 * locations.count()
        assert not tables_fit(twice, ["LOCATIONS"]) and not twice.measure("LOCATIONS").unique
        assert tables_fit(letters, ["LOCATIONS"]) and not tables_fit(letters, ["LOCATIONS"], collation="UTF8_LCASE_RTRIM")
        for t, broadcast in ((normal, True), (wide, False), (twice, False)):
            for df, alias in ((trial_extract(t, "BUILDING"), "LP"), (inventory_history(t, "BUILDING"), "LOC")):
                assert (alias in hints(df)) == broadcast, alias
    # a repeated key multiplies rows, as in the source's own join
    extra = trial_extract(twice, "BUILDING").count()
    assert extra >= trial_extract(normal, "BUILDING").count()


def test_dimensions_are_measured_once(spark, tables):
    t = LimsTables(dict(tables.frames))
    first = t.measure("ROOMS")
    t.frames = {}  # nothing is read again
    assert t.measure("ROOMS") is first and t.measure("MATERIALS").unique and t.measure("INVENTORY") is None


def box_join_tasks(df) -> set[str]:
    """Partition counts of the exchanges that deal rows by a box's id."""
    return set(re.findall(r"Exchange hashpartitioning\((?:BOX_ID|PARENT_CONTAINER_INV_ID|INVENTORYID)#\d+L?, (\d+)\)", plan_of(df)))


def test_fanout_tasks_follow_the_tables(spark, tables):
    """The box join of larger tables gets more tasks, however few the session's shuffles begin with."""
    want = rows_of(parent_fanout(tables))
    t = LimsTables(dict(tables.frames))
    size = t.table_bytes("INVENTORY") + t.table_bytes("INVENTORY_TRANSACTIONS")
    values = {**BIG, "spark.sql.adaptive.enabled": "false"}
    for tasks in (60, 120):
        with conf(spark, {**values, "vialflow.boxes.taskBytes": str(-(-size // tasks))}):
            df = parent_fanout(t)
            assert len(sizes(df)) > 8 and any(abs(int(n) - tasks) <= 2 for n in box_join_tasks(df))
            # the ids cut whole tables: one join for each, not one for each branch of a union
            assert not re.search("SortMergeJoin .*LeftSemi", plan_of(df)) and rows_of(df) == want


def test_snapshot_box_tasks_follow_the_tables(spark, tables):
    want = rows_of(trial_extract(tables, None))
    t = LimsTables(dict(tables.frames))
    size = t.table_bytes("INVENTORY") + t.table_bytes("INVENTORY_TRANSACTIONS")
    values = {**BIG, "spark.sql.adaptive.enabled": "false"}
    with conf(spark, {**values, "vialflow.boxes.taskBytes": str(-(-size // 60))}):
        df = trial_extract(t, None)
        assert any(abs(int(n) - 60) <= 2 for n in box_join_tasks(df)) and rows_of(df) == want
