"""Movement history of a trial's vials (16 columns, sorted by vial, transaction).

Plan shape: the trial's vial ids (receipts ⋈ INVENTORY_VLA) reduce the
full ledger first (inner joins commute with the header's left join, which
only references the ledger row), then header, parent box with material and
direct location are attached. The sort is a range partition plus an
in-partition sort, so the written files are globally ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.scalar import grid_ordinal_sql
from ..operators import dims
from ..operators.broadcast import tables_fit
from ..operators.ranges import ordered
from ..operators.reducers import Reducers, worth_reducing
from ..sources.tables import LimsTables
from ..sqltext import hint, run, spread
from .inventory import TrialCodes, TrialVials, inline_reducers, trial_where

# The history's output contract (column names, order, sort keys).
HISTORY_COLUMNS: tuple[str, ...] = (
    "INVENTORYID", "TRANSACTION_ID", "TRANSACTION_DT", "USRNAM", "AMOUNTLEFT", "AMOUNT_UNIT_CODE",
    "TRANSACTION_TYPE", "COMMENTS", "CONTAINER_POS_Y", "CONTAINER_POS_X", "FLAG_CURRENT", "BOX_NAME",
    "BOX_CODE", "BOX_POS", "LOCATION_NAME", "LONGNAME",
)
HISTORY_ORDER = ("INVENTORYID", "TRANSACTION_ID")
#: The large tables that a trial's ids cut.
HISTORY_TABLES = ("INVENTORY_VLA", "INVENTORY_TRANSACTIONS_VLA", "INVENTORY", "TRANSACTIONS")


def history_sql(
    t: LimsTables,
    trial_pred: str,
    *,
    with_trial: bool = False,
    sort: bool = True,
    vials_table: bool = False,
    broadcast_vials: bool = False,
    reduce_ledger: bool = False,
    streamed: bool = False,
    vial_ledger: bool = False,
    locations: bool = True,
    collation: str | None = None,
) -> str:
    """History as one statement; ``with_trial`` adds ``LAST_NAME`` (for partitioned output).

    ``vials_table`` takes the trial's vials and ledger rows from the bound
    ``{TRIAL_VIALS}`` / ``{TRIAL_LEDGER}`` tables (written once, see
    :func:`~vialflow.plans.inventory.materialize_trial_vials`);
    ``broadcast_vials`` (size checked by the caller) broadcasts the vials.

    The box inventory and the transaction headers are cut to the ids that the
    trial's ledger rows reference: by broadcast semi joins with
    ``reduce_ledger`` (the caller has proven the ledger rows few), else by Bloom
    filters; a trial stated inline also cuts the ledger so. Boxes that many
    rows point at are broadcast apart, as in the snapshot.

    A ``streamed`` ledger is cut by the trial's vials, which are static, and
    nothing is cut by the ledger: a filter or sketch over a stream would be a
    streaming aggregation, which an appended history can't have.

    ``vial_ledger`` says that ``{TRIAL_LEDGER}`` carries the trial and has a row for each vial
    row already, so the vials are not joined. Without ``locations`` the
    rows keep ``LOCATIONCODE`` in place of the location's columns (see :func:`located_sql`).
    """
    salt = ["IT.INVENTORYID", "IT.TRANSACTION_ID", "IT.CONTAINER_POS_X"]
    boxes_small = reduce_ledger or dims.boxes_fit(t, False, collation)
    heavy = not boxes_small and not streamed and worth_reducing(t, HISTORY_TABLES)
    box_names = (["V"] if broadcast_vials else []) + (["PC"] if boxes_small else ["HB"] if heavy else [])
    names = (
        # headers cut to the ids of the (proven small) trial ledger are small too
        (["T"] if reduce_ledger or tables_fit(t, ["TRANSACTIONS"]) else [])
        + (["LOC"] if locations and tables_fit(t, ["LOCATIONS"], collation=collation) else [])
    )
    ledger_type = lambda column: t.col_type("INVENTORY_TRANSACTIONS_VLA", column)
    tx_key = spread("IT.TRANSACTION_ID", salt, ledger_type("TRANSACTION_ID"))
    loc_key = spread("IT.LOCATIONCODE", salt, ledger_type("LOCATIONCODE"))
    box_pos = grid_ordinal_sql("IT.CONTAINER_POS_Y", "IT.CONTAINER_POS_X", dims.box_column("CONTAINER_AXIS_X_SIZE", heavy))
    trial_out = "" if not with_trial else ", IT.LAST_NAME" if vial_ledger else ", V.LAST_NAME"
    inline = not vials_table and trial_pred != "TRUE" and worth_reducing(t, HISTORY_TABLES)
    reducers, base = inline_reducers(t, trial_pred, collation) if inline else (None, "")
    inv_hint, inv_cut = reducers.keep("INVENTORY_VLA", "EXTERNAL_ID", "receipt_ids", "I") if reducers else ("", "")
    vials = (
        f"SELECT VIAL_ID{', LAST_NAME' if with_trial else ''} FROM {{TRIAL_VIALS}}"
        if vials_table else
        f"""SELECT INV.INVENTORYID AS VIAL_ID{', CR.LAST_NAME' if with_trial else ''}
        FROM (SELECT {inv_hint} I.* FROM {{INVENTORY_VLA}} I {inv_cut}) INV
        JOIN {{CENTRALRECEIVING_VLA}} CR ON CR.EXTERNAL_ID = INV.EXTERNAL_ID
        WHERE {trial_pred}"""
    )
    it_hint, it_cut = reducers.keep("INVENTORY_TRANSACTIONS_VLA", "INVENTORYID", "vial_ids", "L") if reducers else ("", "")
    ledger = "{TRIAL_LEDGER}" if vials_table else f"(SELECT {it_hint} L.* FROM {{INVENTORY_TRANSACTIONS_VLA}} L {it_cut})"
    ids, headers, box_ids, box_reduce = "", "{TRANSACTIONS}", None, None
    if reduce_ledger:
        ids = """box_ids AS (SELECT DISTINCT CONTAINER_INVENTORYID AS BOX_ID FROM {TRIAL_LEDGER} WHERE CONTAINER_INVENTORYID IS NOT NULL),
tx_ids AS (SELECT DISTINCT TRANSACTION_ID AS TX_ID FROM {TRIAL_LEDGER} WHERE TRANSACTION_ID IS NOT NULL),
"""
        headers = f"(SELECT {hint(['TI'])} H.* FROM {{TRANSACTIONS}} H LEFT SEMI JOIN tx_ids TI ON H.TRANSACTION_ID = TI.TX_ID)"
        box_ids = "box_ids"
    elif (vials_table or reducers) and not streamed:
        used = Reducers(t)
        used.add("box_filter", "CONTAINER_INVENTORYID", ledger_type("CONTAINER_INVENTORYID"), "ledger")
        used.add("header_filter", "TRANSACTION_ID", ledger_type("TRANSACTION_ID"), "ledger")
        tx_hint, tx_cut = used.keep("TRANSACTIONS", "TRANSACTION_ID", "header_filter", "H")
        ids, box_reduce = used.ctes(), (used, "box_filter")
        headers = f"(SELECT {tx_hint} H.* FROM {{TRANSACTIONS}} H {tx_cut})"
    heavy_ctes = dims.heavy_boxes_ctes(t, False, "CONTAINER_INVENTORYID", "ledger", collation) if heavy else ""
    vials_cte, vials_join = ("", "") if vial_ledger else (f"vials AS ({vials}),\n", "JOIN vials V ON V.VIAL_ID = IT.INVENTORYID")
    place, place_join = ("LOC.LOCATION_NAME, LOC.LONGNAME", _location_join("IT", loc_key, collation)) if locations else ("IT.LOCATIONCODE", "")
    # the box first: its columns come finished to the join of the headers
    carried = ", ".join(f"IT.{c}" for c in (
        "AMOUNT_UNIT_CODE", "COMMENTS", "FLAG_CURRENT", "CONTAINER_POS_Y", "CONTAINER_POS_X", "AMOUNTLEFT", "LOCATIONCODE"))
    body = f"""
WITH {base}{vials_cte}ledger AS (SELECT * FROM {ledger}),
{ids}{heavy_ctes}boxes AS ({dims.boxes_sql(t, False, box_ids, reduce_ledger, box_reduce, collation)}),
boxed AS (
SELECT {hint(box_names)} {carried}, {dims.box_column("BOX_NAME", heavy)} AS BOX_NAME, {dims.box_column("BOX_CODE", heavy)} AS BOX_CODE,
       {box_pos} AS BOX_POS, IT.INVENTORYID, IT.TRANSACTION_ID{trial_out}
FROM ledger IT
{vials_join}
{dims.parent_box_join("IT.CONTAINER_INVENTORYID", ledger_type("CONTAINER_INVENTORYID"), "IT.INVENTORYID", salt, heavy)})
SELECT {hint(names)} IT.INVENTORYID, IT.TRANSACTION_ID, T.TRANSACTION_DT, T.USRNAM, IT.AMOUNTLEFT,
       IT.AMOUNT_UNIT_CODE, T.TRANSACTION_TYPE, IT.COMMENTS, IT.CONTAINER_POS_Y, IT.CONTAINER_POS_X,
       IT.FLAG_CURRENT, IT.BOX_NAME, IT.BOX_CODE, IT.BOX_POS, {place}{", IT.LAST_NAME" if with_trial else ""}
FROM boxed IT
LEFT JOIN {headers} T ON T.TRANSACTION_ID = {tx_key} AND IT.TRANSACTION_ID IS NOT NULL
{place_join}"""
    if not sort:
        return body
    # Hash-distribute first so the range partitioner samples the shuffled
    # rows instead of re-running the ledger scan and joins to find bounds;
    # both order keys go into the hash, so one busy vial spreads too.
    return (f"SELECT * FROM (SELECT * FROM ({body}) h DISTRIBUTE BY {', '.join(HISTORY_ORDER)}) s "
            f"ORDER BY {', '.join(HISTORY_ORDER)}")


def _location_join(alias: str, key: str, collation: str | None) -> str:
    return f"LEFT JOIN {{LOCATIONS}} LOC ON {dims.same('LOC.LOCATIONCODE', key, collation)} AND {alias}.LOCATIONCODE IS NOT NULL"


def located_sql(collation: str | None = None) -> str:
    """The bound ``{ROWS}`` of a history without locations, with the (broadcast) location's columns."""
    cols = ", ".join(f"LOC.{c}" if c in ("LOCATION_NAME", "LONGNAME") else f"R.{c}" for c in HISTORY_COLUMNS)
    return f"SELECT {hint(['LOC'])} {cols}, R.LAST_NAME FROM {{ROWS}} R {_location_join('R', 'R.LOCATIONCODE', collation)}"


def locations_last(t: LimsTables, vials: TrialVials | None, collation: str | None = None) -> bool:
    """Whether locations are joined by :func:`by_trial`, after the last shuffle: where they may be broadcast."""
    return vials is not None and tables_fit(t, ["LOCATIONS"], collation=collation)


def by_trial(t: LimsTables, rows: DataFrame, collation: str | None = None) -> DataFrame:
    """``rows`` of a history with trials, range-sorted by (trial, vial, transaction); locations are joined where missing."""
    keys = ("LAST_NAME", *HISTORY_ORDER)
    # the columns with few values together; hash shuffle first: the range partitioner then samples shuffled rows, not the ledger scan
    dealt = rows.select(*[c for c in rows.columns if c not in keys], *keys).repartition(*HISTORY_ORDER).repartitionByRange(*keys)
    if "LOCATIONCODE" in rows.columns:
        dealt = run(t.spark, located_sql(collation), {**t.frames, "ROWS": dealt})
    return dealt.select(*HISTORY_COLUMNS, "LAST_NAME").sortWithinPartitions(*keys)


def inventory_history(
    t: LimsTables,
    trial_codes: TrialCodes,
    *,
    collation: str | None = None,
    sort: bool = True,
    with_trial: bool = False,
    vials: TrialVials | None = None,
    locations: bool = True,
) -> DataFrame:
    """The 16-column movement history of the trial(s)' vials, sorted by
    (INVENTORYID, TRANSACTION_ID) unless ``sort=False``. ``vials`` (from
    :func:`~vialflow.plans.inventory.materialize_trial_vials`) replaces the
    receipt join by the already written vial table, and brings the bounds of the
    order, so that the rows are shuffled for it once."""
    if vials is not None:
        sketched = sort and vials.order is not None
        text = history_sql(t, "TRUE", with_trial=with_trial, sort=sort and not sketched, vials_table=True,
                           broadcast_vials=vials.broadcastable, reduce_ledger=vials.ledger_broadcastable,
                           vial_ledger=vials.vial_ledger, locations=locations, collation=collation)
        rows = run(t.spark, text, vials.tables(t))
        return ordered(rows, *HISTORY_ORDER, vials.order) if sketched else rows
    pred, args = trial_where(t, "CR.LAST_NAME", trial_codes, collation)
    return run(t.spark, history_sql(t, pred, with_trial=with_trial, sort=sort, collation=collation), t, args)
