"""Dimensions pre-joined once, then attached to vial rows by one key.

Left joins that hang off a dimension (shelf off rack, room off freezer,
material off box, time point off schedule) only reference that dimension,
so ``fact LEFT JOIN a LEFT JOIN b ON a.x = b.y`` equals ``fact LEFT JOIN
(a LEFT JOIN b ON a.x = b.y)``. Building each chain over the dimension
first means the large vial/ledger side meets it in a single join instead of
three to five, and the per-location CASE columns are computed once per
location instead of once per vial.

Each chain is a Spark SQL fragment (used as a CTE by the plans) and, via
the functions at the bottom, a DataFrame. Broadcast hints are placed only
where the inputs' size check passes (:mod:`.broadcast`); elsewhere the
planner shuffles and AQE may still broadcast from measured sizes. Foreign
keys that can be NULL are spread (``sqltext.spread``) so NULL-key rows do
not pile into one shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.text import collation_key_sql
from ..sources.tables import UNKNOWN_SIZE, LimsTables
from ..sqltext import hint, run, spread
from .broadcast import tables_fit
from .reducers import Reducers, heavy_sql

SCHEDULE_TABLES = ("TRIAL_MASTER_SCHEDULE", "TRIAL", "TRIAL_ELEMENT_TIMEPOINT", "TRIAL_ELEMENT")
LOCATION_TABLES = ("LOCATIONS", "LOCATIONS", "LOCATIONS", "ROOMS", "BUILDINGS")
BOX_TABLES = ("INVENTORY", "MATERIALS")
#: Estimated (compressed) bytes of INVENTORY and its ledger for one task of the box join; about half a million rows.
BOX_TASK_BYTES = 8 * 1024 * 1024
CONF_BOX_TASK_BYTES = "vialflow.boxes.taskBytes"
#: As many partitions as a large cluster's shuffles begin with.
MAX_BOX_PARTITIONS = 20_000


def same(left: str, right: str, collation: str | None) -> str:
    """``left = right`` for two string keys, under ``collation`` if there is one."""
    return f"{collation_key_sql(left, collation)} = {collation_key_sql(right, collation)}"


def schedule_sql(t: LimsTables) -> str:
    """Visit schedule with its trial (inner) and optional time point/element."""
    bc = hint(a for a, n in (("TR", "TRIAL"), ("TP", "TRIAL_ELEMENT_TIMEPOINT"), ("EL", "TRIAL_ELEMENT"))
              if tables_fit(t, [n]))
    salt = ["SCH.TRIAL_MASTER_SCHEDULE_ID"]
    tp_key = spread("SCH.TRIAL_ELEMENT_TP_ID", salt, t.col_type("TRIAL_MASTER_SCHEDULE", "TRIAL_ELEMENT_TP_ID"))
    el_key = spread("TP.TRIAL_ELEMENT_ID", salt, t.col_type("TRIAL_ELEMENT_TIMEPOINT", "TRIAL_ELEMENT_ID"))
    return f"""
        SELECT {bc} SCH.TRIAL_MASTER_SCHEDULE_ID AS TMS_ID, SCH.MSDESCRIPTION AS MS_VISIT, TR.TRIAL_CODE,
               TP.CODE AS TP_CODE, TP.VISIT AS TP_VISIT, TP.DESCRIPTION AS TP_DESC, EL.ELEMENT_NAME AS TE_NAME
        FROM {{TRIAL_MASTER_SCHEDULE}} SCH
        JOIN {{TRIAL}} TR ON TR.TRIAL_ID = SCH.TRIAL_ID
        LEFT JOIN {{TRIAL_ELEMENT_TIMEPOINT}} TP
               ON TP.TRIAL_ELEMENT_TP_ID = {tp_key} AND SCH.TRIAL_ELEMENT_TP_ID IS NOT NULL
        LEFT JOIN {{TRIAL_ELEMENT}} EL
               ON EL.TRIAL_ELEMENT_ID = {el_key} AND TP.TRIAL_ELEMENT_ID IS NOT NULL"""


def location_path_sql(t: LimsTables, collation: str | None = None) -> str:
    """Rack -> shelf -> freezer -> room -> building, one row per rack code.

    Level shift: with a full three-level chain the names read
    FREEZER/SHELF/RACK; when the chain has no third level (no freezer *key*),
    the two names move up one level and RACK is NULL. Codes, sort keys and
    long names are never shifted; room and building hang off the third level
    only.
    """
    names = (["L2", "L3"] if tables_fit(t, ["LOCATIONS"], collation=collation) else []) + (
        ["RM", "BL"] if tables_fit(t, ["ROOMS", "BUILDINGS"]) else []
    )
    salt = ["L1.LOCATIONCODE"]
    code = t.col_type("LOCATIONS", "LOCATIONCODE")
    shelf_key = spread("L1.PARENT_LOCATION_CODE", salt, code)
    freezer_key = spread("L2.PARENT_LOCATION_CODE", salt, code)
    room_key = spread("L3.ROOM_ID", salt, t.col_type("LOCATIONS", "ROOM_ID"))
    bldg_key = spread("RM.BUILDING_ID", salt, t.col_type("ROOMS", "BUILDING_ID"))
    three = "L3.LOCATIONCODE IS NOT NULL"
    return f"""
        SELECT {hint(names)} L1.LOCATIONCODE AS RACK_CODE,
               IF({three}, L3.LOCATION_NAME, L2.LOCATION_NAME) AS FREEZER,
               IF({three}, L2.LOCATION_NAME, L1.LOCATION_NAME) AS SHELF,
               IF({three}, L1.LOCATION_NAME, NULL) AS RACK,
               L2.SORTER AS SHELF_SORT, L1.SORTER AS RACK_SORT, L1.LONGNAME, L1.LONGCODE,
               RM.ROOM_NAME, RM.ROOM_CODE, BL.BUILDING_NAME, BL.BUILDING_CODE
        FROM {{LOCATIONS}} L1
        LEFT JOIN {{LOCATIONS}} L2 ON {same("L2.LOCATIONCODE", shelf_key, collation)} AND L1.PARENT_LOCATION_CODE IS NOT NULL
        LEFT JOIN {{LOCATIONS}} L3 ON {same("L3.LOCATIONCODE", freezer_key, collation)} AND L2.PARENT_LOCATION_CODE IS NOT NULL
        LEFT JOIN {{ROOMS}} RM ON RM.ROOM_ID = {room_key} AND L3.ROOM_ID IS NOT NULL
        LEFT JOIN {{BUILDINGS}} BL ON BL.BUILDING_ID = {bldg_key} AND RM.BUILDING_ID IS NOT NULL"""


def boxes_sql(
    t: LimsTables,
    with_current_rows: bool,
    box_ids: str | None = None,
    broadcast_ids: bool = False,
    reduce: tuple[Reducers, str] | None = None,
    collation: str | None = None,
) -> str:
    """Inventory items as parent boxes, with their material geometry.

    ``with_current_rows`` adds ``_CURRENT_ROWS``, the number of the box's
    current ledger rows: the snapshot repeats each vial row that many times
    (see :func:`~vialflow.operators.joins.expand_fanout`). It is a grouped
    count (map-side partial aggregation), so the ledger shrinks to one row
    per item before it is shuffled; AQE broadcasts it when the measured
    result is small.

    ``box_ids`` names a relation (CTE) of distinct ``BOX_ID``: INVENTORY and
    the ledger count are then cut to those boxes by joins, broadcast
    when ``broadcast_ids`` (the caller has proven the set small). ``reduce``
    (filters, name) cuts both by a Bloom filter of box ids instead, which fits
    a set of any size.
    """
    bc = hint(["MT"] if tables_fit(t, ["MATERIALS"], collation=collation) else [])
    inv_hint = hint(["BI"]) if box_ids and broadcast_ids else ""
    # ids are distinct, so an inner join keeps the same rows; unlike a semi join it is not sorted once for each branch of a union
    cut = "LEFT SEMI JOIN" if broadcast_ids else "JOIN"
    inv_semi = f" {cut} {box_ids} BI ON INV.INVENTORYID = BI.BOX_ID" if box_ids else ""
    cur_hint = hint(["BC"]) if box_ids and broadcast_ids else ""
    cur_semi = f" {cut} {box_ids} BC ON L.INVENTORYID = BC.BOX_ID" if box_ids else ""
    if reduce and not box_ids:
        inv_hint, inv_semi = reduce[0].keep("INVENTORY", "INVENTORYID", reduce[1], "INV")
        cur_hint, cur_semi = reduce[0].keep("INVENTORY_TRANSACTIONS", "INVENTORYID", reduce[1], "L")
        inv_semi, cur_semi = f" {inv_semi}", f" {cur_semi}"
    mat_key = spread("INV.MATCODE", ["INV.INVENTORYID"], t.col_type("INVENTORY", "MATCODE"))
    counts_col = ", CUR.N AS _CURRENT_ROWS" if with_current_rows else ""
    counts_join = (
        f"""
        LEFT JOIN (SELECT {cur_hint} L.INVENTORYID AS CUR_ID, count(1) AS N FROM {{INVENTORY_TRANSACTIONS}} L{cur_semi}
                   WHERE L.FLAG_CURRENT = 1 GROUP BY L.INVENTORYID) CUR ON CUR.CUR_ID = INV.INVENTORYID"""
        if with_current_rows else ""
    )
    return f"""
        SELECT {bc} INV.INVENTORYID AS PARENT_CONTAINER_INV_ID, INV.INVENTORY_CODE AS BOX_CODE,
               INV.EXTERNAL_CODE AS BOX_NAME, INV.MATCODE,
               MT.CONTAINER_AXIS_Y_SIZE, MT.CONTAINER_AXIS_X_SIZE{counts_col}
        FROM (SELECT {inv_hint} INV.* FROM {{INVENTORY}} INV{inv_semi}) INV
        LEFT JOIN {{MATERIALS}} MT ON {same("MT.MATCODE", mat_key, collation)} AND INV.MATCODE IS NOT NULL{counts_join}"""


def box_ids_sql(t: LimsTables, source: str, small: bool = False) -> str:
    """``(BOX_ID)``: the containers that rows of ``source`` point at, once each.

    The box join puts its sorts and counts, all on the box's id, into one stage.
    By the size of shuffled data alone that stage would have too few tasks, as
    narrow rows compress well and take up far more when sorted. So the ids are
    dealt by the size of the tables, and what is joined to them follows;
    ``small`` ids are broadcast and stay as they are.
    """
    n = 0 if small else box_partitions(t)
    deal = f"/*+ REPARTITION({n}, BOX_ID) */ " if n else ""
    return f"SELECT {deal}DISTINCT B.CONTAINER_INVENTORYID AS BOX_ID FROM {source} B WHERE B.CONTAINER_INVENTORYID IS NOT NULL"


def box_partitions(t: LimsTables) -> int:
    """Partitions of the box join, a task for each ``BOX_TASK_BYTES``; 0 where the session's cores are more, or sizes unknown."""
    size = t.table_bytes("INVENTORY") + t.table_bytes("INVENTORY_TRANSACTIONS")
    if size >= UNKNOWN_SIZE // 2:
        return 0
    raw = t.spark.conf.get(CONF_BOX_TASK_BYTES, None)
    n = min(-(-size // (int(raw) if raw else BOX_TASK_BYTES)), MAX_BOX_PARTITIONS)
    return n if n > t.spark.sparkContext.defaultParallelism else 0


def heavy_boxes_ctes(t: LimsTables, with_current_rows: bool, container: str, source: str, collation: str | None = None) -> str:
    """CTEs ``heavy`` and ``heavy_boxes``: the boxes that many rows of ``source`` point at by ``container``.

    A sketch names them, so they are few (see :func:`~.reducers.heavy_sql`)
    and their box rows are broadcast. Each CTE is followed by a comma.
    """
    partitions = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return f"""heavy AS ({heavy_sql(container, source, partitions)}),
heavy_boxes AS ({boxes_sql(t, with_current_rows, "heavy", True, collation=collation)}),
"""


def parent_box_join(container: str, data_type: str, self_key: str, salt: list[str], heavy: bool) -> str:
    """``LEFT JOIN`` to ``boxes PC``: the containing box, never the row's own item.

    With ``heavy`` rows in a heavy box take it from the broadcast ``heavy_boxes HB``
    and go through the shuffle join spread and without a match, like rows in no
    box at all. Whichever boxes the sketch has named, each row finds its box once.
    """
    if not heavy:
        return f"""LEFT JOIN boxes PC ON PC.PARENT_CONTAINER_INV_ID = {spread(container, salt, data_type)}
       AND {container} IS NOT NULL AND PC.PARENT_CONTAINER_INV_ID <> {self_key}"""
    left = f"IF(HB.PARENT_CONTAINER_INV_ID IS NULL, {container}, NULL)"
    return f"""LEFT JOIN heavy_boxes HB ON HB.PARENT_CONTAINER_INV_ID = {container} AND HB.PARENT_CONTAINER_INV_ID <> {self_key}
LEFT JOIN boxes PC ON PC.PARENT_CONTAINER_INV_ID = {spread(left, salt, data_type)}
       AND {container} IS NOT NULL AND HB.PARENT_CONTAINER_INV_ID IS NULL AND PC.PARENT_CONTAINER_INV_ID <> {self_key}"""


def box_column(name: str, heavy: bool) -> str:
    """A column of the box that :func:`parent_box_join` found."""
    return f"coalesce(HB.{name}, PC.{name})" if heavy else f"PC.{name}"


def boxes_fit(t: LimsTables, with_current_rows: bool, collation: str | None = None) -> bool:
    return tables_fit(t, BOX_TABLES + (("INVENTORY_TRANSACTIONS",) if with_current_rows else ()), collation=collation)


def location_path(t: LimsTables) -> DataFrame:
    return run(t.spark, location_path_sql(t), t)


def schedule(t: LimsTables) -> DataFrame:
    return run(t.spark, schedule_sql(t), t)


def boxes(t: LimsTables, with_current_rows: bool) -> DataFrame:
    return run(t.spark, boxes_sql(t, with_current_rows), t)
