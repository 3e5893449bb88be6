"""Extraction plans: golden counts, fan-out, level shift, plan shape."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vialflow.functions.predicates import flag_viable
from vialflow.functions.text import extract_sampleid
from vialflow.operators import dims
from vialflow.plans.history import HISTORY_COLUMNS, inventory_history
from vialflow.plans.inventory import EXTRACT_COLUMNS, SNAPSHOT_COLUMNS, trial_extract, trial_inventory
from vialflow.plans.sql_text import MONTHLY_SQL, run_sql


def _counts(df):
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("VIAL_CONTAINER_INV_ID").alias("vials"),
        F.count_if("VIABLE").alias("viable"), F.count_if(F.col("VIABLE").isNull()).alias("viable_null"),
        F.count("SAMPLEID").alias("sid"), F.count_if(F.col("SAMPLEID") == "").alias("sid_empty"),
        F.count("SAMPLEID2").alias("sid2"), F.count("SEQ_NUM").alias("seq"), F.count("BOX_POS").alias("pos"),
        F.count("FREEZER").alias("freezer"), F.count("SHELF").alias("shelf"), F.count("RACK").alias("rack"),
        F.count("ROOM_NAME").alias("room"), F.count("TE_NAME").alias("te"), F.count("TP_CODE").alias("tp"),
    ).first().asDict()


# Golden values for trial BUILDING on the derived tables (equal in Spark and DuckDB).
GOLDEN = {
    "0.001": dict(rows=216, vials=160, viable=86, viable_null=0, sid=83, sid_empty=47, sid2=85, seq=100, pos=119,
                  freezer=133, shelf=178, rack=92, room=92, te=45, tp=97, history=1336),
    "0.01": dict(rows=1688, vials=1231, viable=746, viable_null=0, sid=677, sid_empty=367, sid2=661, seq=696,
                 pos=945, freezer=1124, shelf=1483, rack=837, room=630, te=682, tp=1084, history=11930),
}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_golden_counts(spark, sf):
    from vialflow.sources.fixtures import derive_lims_tables

    t = derive_lims_tables(spark, f"/root/testdata/sf{sf}")
    got = _counts(trial_extract(t, "BUILDING"))
    got["history"] = inventory_history(t, "BUILDING", sort=False).count()
    assert got == GOLDEN[sf]


def test_output_columns(tables):
    assert tuple(trial_inventory(tables, "BUILDING").columns) == SNAPSHOT_COLUMNS
    assert len(SNAPSHOT_COLUMNS) == 63 and len(set(SNAPSHOT_COLUMNS)) == 63
    assert tuple(trial_extract(tables, "BUILDING").columns) == EXTRACT_COLUMNS
    assert tuple(inventory_history(tables, "BUILDING").columns) == HISTORY_COLUMNS


def test_extract_equals_composed_transforms(tables):
    """The one-statement extraction equals the DataFrame transforms applied to the snapshot."""
    composed = flag_viable(extract_sampleid(trial_inventory(tables, "BUILDING")))
    single = trial_extract(tables, "BUILDING")
    assert composed.select(*EXTRACT_COLUMNS).exceptAll(single).count() == 0
    assert single.exceptAll(composed.select(*EXTRACT_COLUMNS)).count() == 0


def test_fanout_kept(tables):
    """N7: a box with k current ledger rows yields k copies of each vial row."""
    snap = trial_inventory(tables, "BUILDING")
    per_row = snap.groupBy(*SNAPSHOT_COLUMNS).count()
    assert per_row.where("count > 1").count() > 0
    distinct_rows = per_row.count()
    assert distinct_rows < snap.count() == 216


def test_level_shift(tables):
    path = {r.RACK_CODE: r for r in dims.location_path(tables).collect()}
    # supplier s3 (suppkey % 10 == 3) has no parent: FREEZER/SHELF come from the rack itself
    one_level = path["S3"]
    assert one_level.FREEZER is None and one_level.SHELF is not None and one_level.RACK is None
    assert one_level.ROOM_NAME is None
    # a rack under a nation under a region: three levels, no shift
    full = [r for r in path.values() if r.RACK is not None]
    assert full and all(r.FREEZER is not None or r.RACK_CODE for r in full)
    # region R4 has a NULL name but is a real third level: RACK stays the rack name, FREEZER NULL
    assert any(r.RACK is not None and r.FREEZER is None for r in full)


def test_trial_filter_pushed_to_scan(tables):
    plan = trial_inventory(tables, "BUILDING")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_mktsegment,BUILDING)" in plan
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_column_pruning(tables):
    plan = inventory_history(tables, "BUILDING")._jdf.queryExecution().executedPlan().toString()
    # the orders scan for the vial join reads only the two columns it needs
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_unknown_trial_is_empty_blank_trial_fails(tables):
    assert trial_extract(tables, "NO_SUCH_TRIAL").count() == 0
    with pytest.raises(ValueError):
        trial_extract(tables, "  ")


def test_multi_trial_equals_union_of_single(tables):
    both = trial_extract(tables, ["BUILDING", "MACHINERY"])
    single = trial_extract(tables, "BUILDING").unionByName(trial_extract(tables, "MACHINERY"))
    assert both.count() == single.count()
    assert both.exceptAll(single).count() == 0


def test_collation_option(tables):
    assert trial_extract(tables, "building ", collation="UTF8_LCASE_RTRIM").count() == 216


def test_sql_text_counts_the_history(spark, tables):
    moves = run_sql(spark, MONTHLY_SQL, tables, trial_code="BUILDING").agg({"N_MOVES": "sum"}).first()[0]
    assert moves == tables["INVENTORY_TRANSACTIONS_VLA"].join(
        tables["INVENTORY_VLA"].join(tables["CENTRALRECEIVING_VLA"].where("LAST_NAME = 'BUILDING'"), "EXTERNAL_ID"), "INVENTORYID"
    ).count()


def test_headers_reached_grow_with_the_ledger(spark):
    from vialflow.sources.fixtures import derive_lims_tables

    for sf in ("0.001", "0.01"):
        t = derive_lims_tables(spark, f"/root/testdata/sf{sf}")
        ids = t["INVENTORY_TRANSACTIONS_VLA"].select("TRANSACTION_ID").distinct()
        assert t["TRANSACTIONS"].join(ids, "TRANSACTION_ID", "left_semi").count() > 0.9 * t["TRANSACTIONS"].count()


def test_history_sorted(tables):
    rows = inventory_history(tables, "BUILDING").select("INVENTORYID", "TRANSACTION_ID").collect()
    keys = [(r.INVENTORYID, r.TRANSACTION_ID) for r in rows]
    assert keys == sorted(keys)


def test_spread_null_key_never_matches(spark):
    """A NULL container key is replaced by a row hash only to spread the
    shuffle; even a box whose id equals that hash must not match."""
    from vialflow.operators.joins import parent_container_join

    rows = spark.createDataFrame([(1, None), (2, 7)], "INVENTORYID bigint, CONTAINER_INVENTORYID bigint")
    salt = rows.where("INVENTORYID = 1").select(F.xxhash64("INVENTORYID").alias("h")).first().h
    boxes = spark.createDataFrame([(salt, "trap"), (7, "box7")], "PARENT_CONTAINER_INV_ID bigint, BOX_CODE string")
    got = {r.INVENTORYID: r.BOX_CODE for r in parent_container_join(
        rows, boxes, self_col="INVENTORYID", salt_cols=("INVENTORYID",)).collect()}
    assert got == {1: None, 2: "box7"}


def test_fixture_plants_missing_boxes(tables):
    ledger = tables["INVENTORY_TRANSACTIONS_VLA"]
    assert ledger.where("CONTAINER_INVENTORYID IS NULL").count() > 0
    assert trial_inventory(tables, None).where("PARENT_CONTAINER_INV_ID IS NULL").count() > 0


def test_materialized_vials_same_results(tables):
    from vialflow.plans.inventory import materialize_trial_vials

    v = materialize_trial_vials(tables, "BUILDING")
    assert v.rows > 0
    assert v.broadcastable
    for inline, reduced in (
        (trial_extract(tables, "BUILDING"), trial_extract(tables, "BUILDING", vials=v)),
        (inventory_history(tables, "BUILDING"), inventory_history(tables, "BUILDING", vials=v)),
    ):
        assert inline.exceptAll(reduced).count() == 0 and reduced.exceptAll(inline).count() == 0
    assert v.ledger_rows == 1336 and v.ledger_broadcastable
    plan = trial_extract(tables, "BUILDING", vials=v)._jdf.queryExecution().executedPlan().toString()
    # the large vial-keyed tables, the box inventory and its ledger counts are cut by broadcast semi joins
    semis = [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "LeftSemi" in line]
    assert any("VIAL_ID" in x for x in semis) and any("INV_GUID" in x for x in semis)
    assert any("BOX_ID" in x for x in semis)
    hplan = inventory_history(tables, "BUILDING", vials=v)._jdf.queryExecution().executedPlan().toString()
    assert "TX_ID" in hplan and "BOX_ID" in hplan


def test_materialized_vials_not_broadcast_beyond_bound(spark, tables):
    from vialflow.plans.inventory import CONF_MAX_REDUCER_ROWS, materialize_trial_vials

    spark.conf.set(CONF_MAX_REDUCER_ROWS, "10")
    try:
        v = materialize_trial_vials(tables, "BUILDING")
    finally:
        spark.conf.unset(CONF_MAX_REDUCER_ROWS)
    assert not v.broadcastable
    assert trial_extract(tables, "BUILDING", vials=v).count() == 216


def test_snapshot_join_count(tables):
    """Decorrelated plan: 18 plain joins (lookup chains included), no correlated subquery left."""
    plan = trial_inventory(tables, "BUILDING")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 18
    assert "LateralJoin" not in plan and "ScalarSubquery" not in plan and "Exists" not in plan


def test_trial_code_is_bound_not_spliced(tables):
    """A trial code is a bound parameter: quotes in it are data, not SQL."""
    assert trial_extract(tables, "X' OR '1'='1").count() == 0
    assert inventory_history(tables, ["BUILDING' --", "Y"]).count() == 0


def test_snapshot_with_shuffled_boxes_equals_broadcast_boxes(spark, tables):
    """Boxes too big to broadcast are shuffled, heavy ones apart: the same rows, and the ledger count is cut to boxes in use."""
    from vialflow.plans.inventory import trial_inventory

    small = trial_inventory(tables, None).collect()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "vialflow.broadcast.maxBytes": "1", "vialflow.broadcast.maxRows": "0", "vialflow.bloom.minBytes": "0"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = trial_inventory(tables, None)
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffled = df.collect()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "approx_top_k" in plan.lower()
    assert sorted(map(str, shuffled)) == sorted(map(str, small)) and small


def test_jdbc_options():
    from vialflow.sources import tables as src

    assert src.jdbc_range_options("TRANSACTIONS", 5, 900, 8) == {
        "partitionColumn": "TRANSACTION_ID", "lowerBound": "5", "upperBound": "901", "numPartitions": "8"}
    assert src.jdbc_bounds_query("INVENTORY") == "(SELECT MIN(INVENTORYID) AS LO, MAX(INVENTORYID) AS HI FROM INVENTORY) q"
    predicates = src.jdbc_hash_predicates("METADATA", 4)
    assert len(set(predicates)) == 4 and predicates[3] == "(CHECKSUM(ID) & 2147483647) % 4 = 3"
    assert all(column in src.COLUMNS[name] for name, column in {**src.RANGE_COLUMNS, **src.HASH_COLUMNS}.items())
    assert set(src.RANGE_COLUMNS) | set(src.HASH_COLUMNS) | src.DIMENSION_TABLES == set(src.TABLE_NAMES)
