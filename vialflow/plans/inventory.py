"""Current-inventory snapshot of one or more trials (63 columns, +3 derived).

Plan shape (all joins declared; Catalyst/AQE choose the physical form):

1. receipts = CENTRALRECEIVING filtered by trial (pushed into the scan)
   ⋈ METADATA (receipt role) ⋈ schedule (TMS ⋈ TRIAL ⟕ time point ⟕ element).
   The receipt side is finished before it meets any vial; AQE broadcasts
   it when the trial's receipts turn out small.
2. vials = INVENTORY_VLA ⋈ receipts, then the three INVENTORYID-keyed
   inputs (sample container, current ledger rows) back to back, so one
   hash partitioning on INVENTORYID serves both joins.
3. ⋈ METADATA (vial role) ⟕ container condition ⟕ parent box (with its
   material and its current-row count) ⟕ location path.
4. Row multiplication by the box's current ledger rows is replayed last.

For one trial every large input is cut in its scan by the trial's ids, whatever
their number (see :func:`snapshot_sql`). The job materialises the trial's
vials and ledger rows first (:func:`materialize_trial_vials`), so that the
snapshot and the history share them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import DEFAULT_EXCLUDE_CONDITIONS, DEFAULT_EXCLUDE_MATCODES, viable_sql
from ..functions.scalar import grid_ordinal_sql, safe_int_sql
from ..functions.text import sampleid_sqls
from ..operators import dims
from ..operators.broadcast import fits_broadcast, sized_broadcast, tables_fit
from ..operators.joins import fanout_sql
from ..operators.ranges import Bounds, bounds, can_sketch, sketch, wanted_partitions
from ..operators.reducers import Reducers, worth_reducing
from ..operators.summary import observe_rows
from ..session import delete_path, scratch_path
from ..sources.tables import LimsTables
from ..sqltext import hint, quote, run, spread

# The snapshot's output contract (column names and order).
SNAPSHOT_COLUMNS: tuple[str, ...] = (
    "TRIAL_CODE", "SUBJECTID", "LABID", "CID", "SAMPLETYPE", "PRESERVATIVE", "AMOUNTLEFT",
    "AMOUNT_UNIT_CODE", "THAWCOUNT", "SEQ", "SEQ_NUM", "FREEZER", "SHELF", "RACK", "BOX_CODE",
    "BOX_NAME", "BOX_POS", "ACCESSION", "DATE_COLLECTED", "DATE_RECEIVED", "RECEIVED_CONDITION",
    "SAMPLE_CONDITION", "COMMENTS", "MS_VISIT", "TMS_ID", "TP_CODE", "TP_VISIT", "TP_DESC", "TE_NAME",
    "CR_VISIT", "NICKNAME", "CPT", "EDTA1", "EDTA2", "PAXGENE", "SST1", "SST2", "SST3", "EDTA1_VOLUME",
    "ORASURE", "BARCODE", "CONSENT_TYPE", "RACK_CODE", "SHELF_SORT", "RACK_SORT", "CONTAINERMATCODE",
    "MATCODE", "CONTAINER_POS_Y", "CONTAINER_AXIS_Y_SIZE", "CONTAINER_POS_X", "CONTAINER_AXIS_X_SIZE",
    "LAST_NAME", "STUDY_SITE", "LONGNAME", "LONGCODE", "ROOM_NAME", "ROOM_CODE", "BUILDING_NAME",
    "BUILDING_CODE", "ARCHIVE_STATUS", "VIAL_CONTAINER_INV_ID", "PARENT_CONTAINER_INV_ID", "CR_ORIGREC",
)

EXTRACT_COLUMNS = SNAPSHOT_COLUMNS + ("SAMPLEID", "SAMPLEID2", "VIABLE")

# Receipt-role meaning of the generic METADATA fields.
RECEIPT_METADATA_ROLES = {
    "FIELD02": "CR_VISIT",
    "FIELD03": "NICKNAME",
    "FIELD12": "CPT",
    "FIELD14": "EDTA1",
    "FIELD15": "EDTA2",
    "FIELD16": "PAXGENE",
    "FIELD13": "SST1",
    "FIELD17": "SST2",
    "FIELD18": "SST3",
    "FIELD20": "EDTA1_VOLUME",
    "FIELD22": "ORASURE",
}
# Vial-role meaning of the generic METADATA fields.
VIAL_METADATA_ROLES = {
    "FIELD16": "SAMPLE_CONDITION",
    "FIELD01": "COMMENTS",
    "FIELD28": "BARCODE",
}

TrialCodes = str | Sequence[str] | None


def trial_predicate(col: Column, trial_codes: TrialCodes, collation: str | None = None) -> Column | None:
    """Equality (one code) or membership (several); ``None`` selects all trials.

    A blank code is an error, as in the original job. ``collation`` (e.g.
    ``"UTF8_LCASE_RTRIM"``) reproduces a case-insensitive, blank-padded
    source collation; the default binary compare is pushed to the scan.
    """
    if trial_codes is None:
        return None
    codes = [trial_codes] if isinstance(trial_codes, str) else list(trial_codes)
    if not codes or any(c is None or not str(c).strip() for c in codes):
        raise ValueError("trial code must be a non-blank string")
    if collation:
        col = F.collate(col, collation)
        codes_c = [F.collate(F.lit(c), collation) for c in codes]
        return col == codes_c[0] if len(codes_c) == 1 else col.isin(codes_c)
    return col == F.lit(codes[0]) if len(codes) == 1 else col.isin(codes)


def trial_receipts(t: LimsTables, trial_codes: TrialCodes, collation: str | None = None) -> DataFrame:
    """CENTRALRECEIVING rows of the trial(s), columns renamed to output names."""
    cr = t["CENTRALRECEIVING_VLA"]
    pred = trial_predicate(F.col("LAST_NAME"), trial_codes, collation)
    if pred is not None:
        cr = cr.where(pred)
    return cr.select(
        F.col("EXTERNAL_ID").alias("_CR_EXT"),
        "SUBJECTID",
        F.col("FIRST_NAME").alias("LABID"),
        F.col("FOLDERNO").alias("ACCESSION"),
        "DATE_COLLECTED",
        "DATE_RECEIVED",
        F.col("METADATA_GUID").alias("_CR_GUID"),
        F.col("TRIAL_MASTER_SCHEDULE_ID").alias("_CR_TMS"),
        "LAST_NAME",
        F.col("RASCLIENTID").alias("STUDY_SITE"),
        F.col("ARCSTATUS").alias("ARCHIVE_STATUS"),
        F.col("ORIGREC").alias("CR_ORIGREC"),
    )


def metadata_role(t: LimsTables, key_alias: str, roles: dict[str, str]) -> DataFrame:
    """METADATA projected to one role: ``ID`` as ``key_alias`` + renamed fields."""
    return t["METADATA"].select(F.col("ID").alias(key_alias), *[F.col(f).alias(n) for f, n in roles.items()])


def receipts_with_schedule(t: LimsTables, trial_codes: TrialCodes, collation: str | None = None) -> DataFrame:
    cr = trial_receipts(t, trial_codes, collation)
    cr = cr.join(metadata_role(t, "_CR_META_ID", RECEIPT_METADATA_ROLES), F.col("_CR_GUID") == F.col("_CR_META_ID"))
    sched = sized_broadcast(dims.schedule(t), lookup_chain=True)
    return cr.join(sched, F.col("_CR_TMS") == sched["TMS_ID"])


def current_ledger(t: LimsTables) -> DataFrame:
    return (
        t["INVENTORY_TRANSACTIONS_VLA"]
        .where(F.col("FLAG_CURRENT") == F.lit(1))
        .select(
            F.col("INVENTORYID").alias("_IT_ID"),
            "AMOUNTLEFT",
            "AMOUNT_UNIT_CODE",
            "THAWCOUNT",
            "CONSENT_TYPE",
            F.col("LOCATIONCODE").alias("_IT_LOC"),
            "CONTAINER_POS_Y",
            "CONTAINER_POS_X",
            "CONTAINER_INVENTORYID",
        )
    )


def sample_containers(t: LimsTables) -> DataFrame:
    return t["SAMPLECONTAINERS_VLA"].select(
        F.col("INVENTORYID").alias("_SC_ID"),
        F.col("CONTAINERID").alias("CID"),
        "SAMPLETYPE",
        F.col("RECEIVEDCONDITION").alias("RECEIVED_CONDITION"),
        F.col("CONTCODE").alias("_SC_CONTCODE"),
        "CONTAINERMATCODE",
    )


def trial_vials(t: LimsTables, receipts: DataFrame) -> DataFrame:
    """INVENTORY_VLA joined to the given receipts (inner, on EXTERNAL_ID)."""
    inv = t["INVENTORY_VLA"].select(
        F.col("INVENTORYID").alias("VIAL_CONTAINER_INV_ID"),
        F.col("EXTERNAL_ID").alias("_INV_EXT"),
        F.col("EXTERNAL_CODE").alias("SEQ"),
        F.col("METADATA_GUID").alias("_INV_GUID"),
    )
    return inv.join(receipts, F.col("_INV_EXT") == F.col("_CR_EXT"))


def trial_filter_sql(column: str, trial_codes: TrialCodes, collation: str | None = None) -> tuple[str, dict]:
    """SQL predicate + bound parameters for the trial filter (``TRUE`` for all)."""
    if trial_codes is None:
        return "TRUE", {}
    codes = [trial_codes] if isinstance(trial_codes, str) else list(trial_codes)
    if not codes or any(c is None or not str(c).strip() for c in codes):
        raise ValueError("trial code must be a non-blank string")
    args = {f"trial_code_{i}": c for i, c in enumerate(codes)}
    if collation:
        col = f"collate({column}, {quote(collation)})"
        refs = [f"collate(:{k}, {quote(collation)})" for k in args]
    else:
        col, refs = column, [f":{k}" for k in args]
    pred = f"{col} = {refs[0]}" if len(refs) == 1 else f"{col} IN ({', '.join(refs)})"
    return pred, args


#: Spellings of the asked trials up to which they are listed in the filter.
MAX_SPELLINGS = 1000


def trial_where(t: LimsTables, column: str, trial_codes: TrialCodes, collation: str | None = None) -> tuple[str, dict]:
    """The trial filter on receipts, in a form that the scans can push down.

    A collated comparison reads every row of every file. So the spellings of the
    asked trials that occur are looked up first (one narrow column), and the
    statement lists them; more than ``MAX_SPELLINGS`` stay a collated filter.
    """
    pred, args = trial_filter_sql("LAST_NAME", trial_codes, collation)
    if collation and trial_codes is not None:
        found = run(t.spark, f"SELECT DISTINCT LAST_NAME FROM {{CENTRALRECEIVING_VLA}} WHERE {pred} LIMIT {MAX_SPELLINGS + 1}", t, args).collect()
        if 0 < len(found) <= MAX_SPELLINGS:
            return trial_filter_sql(column, sorted(r[0] for r in found))
    return trial_filter_sql(column, trial_codes, collation)


# Columns of the trial-vial relation (vial + its receipt + schedule), the
# reduced input every vial-keyed join starts from.
VIAL_COLUMNS = (
    "VIAL_ID", "SEQ", "INV_GUID", "SUBJECTID", "LABID", "ACCESSION", "DATE_COLLECTED", "DATE_RECEIVED",
    "LAST_NAME", "STUDY_SITE", "ARCHIVE_STATUS", "CR_ORIGREC", *RECEIPT_METADATA_ROLES.values(),
    "TMS_ID", "MS_VISIT", "TRIAL_CODE", "TP_CODE", "TP_VISIT", "TP_DESC", "TE_NAME",
)

# Snapshot output columns as SQL over the aliases of ``snapshot_sql``.
_SNAPSHOT_EXPR = {
    **{c: f"V.{c}" for c in VIAL_COLUMNS},
    "CID": "SC.CONTAINERID", "SAMPLETYPE": "SC.SAMPLETYPE", "PRESERVATIVE": "CC.PRESERVATIVE",
    "AMOUNTLEFT": "IT.AMOUNTLEFT", "AMOUNT_UNIT_CODE": "IT.AMOUNT_UNIT_CODE", "THAWCOUNT": "IT.THAWCOUNT",
    "FREEZER": "LP.FREEZER", "SHELF": "LP.SHELF", "RACK": "LP.RACK", "BOX_CODE": "PC.BOX_CODE",
    "BOX_NAME": "PC.BOX_NAME", "RECEIVED_CONDITION": "SC.RECEIVEDCONDITION",
    "SAMPLE_CONDITION": "IVM.SAMPLE_CONDITION", "COMMENTS": "IVM.COMMENTS", "BARCODE": "IVM.BARCODE",
    "CONSENT_TYPE": "IT.CONSENT_TYPE", "RACK_CODE": "LP.RACK_CODE", "SHELF_SORT": "LP.SHELF_SORT",
    "RACK_SORT": "LP.RACK_SORT", "CONTAINERMATCODE": "SC.CONTAINERMATCODE", "MATCODE": "PC.MATCODE",
    "CONTAINER_POS_Y": "IT.CONTAINER_POS_Y", "CONTAINER_AXIS_Y_SIZE": "PC.CONTAINER_AXIS_Y_SIZE",
    "CONTAINER_POS_X": "IT.CONTAINER_POS_X", "CONTAINER_AXIS_X_SIZE": "PC.CONTAINER_AXIS_X_SIZE",
    "LONGNAME": "LP.LONGNAME", "LONGCODE": "LP.LONGCODE", "ROOM_NAME": "LP.ROOM_NAME", "ROOM_CODE": "LP.ROOM_CODE",
    "BUILDING_NAME": "LP.BUILDING_NAME", "BUILDING_CODE": "LP.BUILDING_CODE",
    "VIAL_CONTAINER_INV_ID": "V.VIAL_ID", "PARENT_CONTAINER_INV_ID": "PC.PARENT_CONTAINER_INV_ID",
}


#: The large tables that a trial's ids cut.
REDUCED_TABLES = ("INVENTORY_VLA", "SAMPLECONTAINERS_VLA", "METADATA", "INVENTORY_TRANSACTIONS_VLA", "INVENTORY", "INVENTORY_TRANSACTIONS")


def inline_reducers(t: LimsTables, trial_pred: str, collation: str | None = None) -> tuple[Reducers, str]:
    """Bloom filters of a trial stated inline, and the CTE ``base`` that they are built from.

    ``receipt_ids`` and ``receipt_guids`` come from the trial's receipts,
    ``vial_ids`` and ``vial_guids`` from its vials.
    """
    receipts = f"(SELECT CR.EXTERNAL_ID, CR.METADATA_GUID FROM {{CENTRALRECEIVING_VLA}} CR WHERE {trial_pred}) r"
    early = Reducers(t, collation)
    early.add("receipt_ids", "EXTERNAL_ID", t.col_type("CENTRALRECEIVING_VLA", "EXTERNAL_ID"), receipts)
    early.add("receipt_guids", "METADATA_GUID", t.col_type("CENTRALRECEIVING_VLA", "METADATA_GUID"), receipts)
    inv_hint, inv_cut = early.keep("INVENTORY_VLA", "EXTERNAL_ID", "receipt_ids", "INV")
    base = f"""base AS (
        SELECT INV.INVENTORYID AS VIAL_ID, INV.METADATA_GUID AS INV_GUID
        FROM (SELECT {inv_hint} INV.* FROM {{INVENTORY_VLA}} INV {inv_cut}) INV
        JOIN {{CENTRALRECEIVING_VLA}} CR ON CR.EXTERNAL_ID = INV.EXTERNAL_ID
        WHERE {trial_pred}),
"""
    late = Reducers(t, collation)
    late.add("vial_ids", "VIAL_ID", t.col_type("INVENTORY_VLA", "INVENTORYID"), "base")
    late.add("vial_guids", "INV_GUID", t.col_type("INVENTORY_VLA", "METADATA_GUID"), "base")
    text = early.ctes() + base + late.ctes()
    early.extend(late)
    return early, text


def vials_ctes(t: LimsTables, trial_pred: str, reducers: Reducers | None = None, collation: str | None = None) -> str:
    """CTEs ``sched``, ``receipts`` and ``vials`` (INVENTORY_VLA ⋈ trial receipts)."""
    receipts_hint = hint(["S"] if tables_fit(t, dims.SCHEDULE_TABLES) else [])
    cr_roles = ", ".join(f"CRM.{f} AS {n}" for f, n in RECEIPT_METADATA_ROLES.items())
    receipt_cols = ", ".join(f"R.{c}" for c in VIAL_COLUMNS[3:])
    metadata, inventory = "{METADATA}", "{INVENTORY_VLA}"
    if reducers:
        meta_hint, meta_cut = reducers.keep("METADATA", "ID", "receipt_guids", "M")
        inv_hint, inv_cut = reducers.keep("INVENTORY_VLA", "EXTERNAL_ID", "receipt_ids", "I")
        metadata = f"(SELECT {meta_hint} M.* FROM {{METADATA}} M {meta_cut})"
        inventory = f"(SELECT {inv_hint} I.* FROM {{INVENTORY_VLA}} I {inv_cut})"
    return f"""sched AS ({dims.schedule_sql(t)}),
receipts AS (
        SELECT {receipts_hint} CR.EXTERNAL_ID AS CR_EXT, CR.SUBJECTID, CR.FIRST_NAME AS LABID,
               CR.FOLDERNO AS ACCESSION, CR.DATE_COLLECTED, CR.DATE_RECEIVED, CR.LAST_NAME,
               CR.RASCLIENTID AS STUDY_SITE, CR.ARCSTATUS AS ARCHIVE_STATUS, CR.ORIGREC AS CR_ORIGREC,
               {cr_roles}, S.TMS_ID, S.MS_VISIT, S.TRIAL_CODE, S.TP_CODE, S.TP_VISIT, S.TP_DESC, S.TE_NAME
        FROM {{CENTRALRECEIVING_VLA}} CR
        JOIN {metadata} CRM ON {dims.same("CRM.ID", "CR.METADATA_GUID", collation)}
        JOIN sched S ON S.TMS_ID = CR.TRIAL_MASTER_SCHEDULE_ID
        WHERE {trial_pred}),
vials AS (
        SELECT INV.INVENTORYID AS VIAL_ID, INV.EXTERNAL_CODE AS SEQ, INV.METADATA_GUID AS INV_GUID, {receipt_cols}
        FROM {inventory} INV
        JOIN receipts R ON R.CR_EXT = INV.EXTERNAL_ID)"""


# Columns of the materialised trial-vial table: the vial, its receipt, and
# the receipt's metadata / schedule keys (joined later, inner, as in the query).
BASE_VIAL_COLUMNS = VIAL_COLUMNS[:12] + ("CR_GUID", "CR_TMS")
# Columns of the receipts that large tables write apart: numbered rows, so that a vial row names its receipt by one long.
RECEIPT_COLUMNS = ("RECEIPT_ID", "CR_EXT", *BASE_VIAL_COLUMNS[3:])


def trial_receipts_sql(trial_pred: str) -> str:
    """The trial's receipts, one row each, numbered."""
    return f"""
SELECT monotonically_increasing_id() AS RECEIPT_ID, CR.EXTERNAL_ID AS CR_EXT,
       CR.SUBJECTID, CR.FIRST_NAME AS LABID, CR.FOLDERNO AS ACCESSION, CR.DATE_COLLECTED, CR.DATE_RECEIVED,
       CR.LAST_NAME, CR.RASCLIENTID AS STUDY_SITE, CR.ARCSTATUS AS ARCHIVE_STATUS, CR.ORIGREC AS CR_ORIGREC,
       CR.METADATA_GUID AS CR_GUID, CR.TRIAL_MASTER_SCHEDULE_ID AS CR_TMS
FROM {{CENTRALRECEIVING_VLA}} CR
WHERE {trial_pred}"""


def trial_vials_sql(t: LimsTables, trial_pred: str, receipts_table: bool = False) -> str:
    """``INVENTORY_VLA ⋈ CENTRALRECEIVING`` for the trial: the vial set both
    the snapshot and the history start from (one row per match).
    ``receipts_table`` takes the receipts from the bound ``{TRIAL_RECEIPTS}``."""
    if receipts_table:
        cols = ", ".join(f"R.{c}" for c in (*BASE_VIAL_COLUMNS[3:], "RECEIPT_ID"))
        return f"""
SELECT INV.INVENTORYID AS VIAL_ID, INV.EXTERNAL_CODE AS SEQ, INV.METADATA_GUID AS INV_GUID, {cols}
FROM {{INVENTORY_VLA}} INV
JOIN {{TRIAL_RECEIPTS}} R ON R.CR_EXT = INV.EXTERNAL_ID"""
    return f"""
SELECT INV.INVENTORYID AS VIAL_ID, INV.EXTERNAL_CODE AS SEQ, INV.METADATA_GUID AS INV_GUID,
       CR.SUBJECTID, CR.FIRST_NAME AS LABID, CR.FOLDERNO AS ACCESSION, CR.DATE_COLLECTED, CR.DATE_RECEIVED,
       CR.LAST_NAME, CR.RASCLIENTID AS STUDY_SITE, CR.ARCSTATUS AS ARCHIVE_STATUS, CR.ORIGREC AS CR_ORIGREC,
       CR.METADATA_GUID AS CR_GUID, CR.TRIAL_MASTER_SCHEDULE_ID AS CR_TMS
FROM {{INVENTORY_VLA}} INV
JOIN {{CENTRALRECEIVING_VLA}} CR ON CR.EXTERNAL_ID = INV.EXTERNAL_ID
WHERE {trial_pred}"""


def table_reducers(t: LimsTables, collation: str | None = None) -> Reducers:
    """Bloom filters of the materialised trial: its receipts' and vials' keys, from the bound ``{TRIAL_VIALS}``."""
    made = Reducers(t, collation)
    made.add("receipt_guids", "CR_GUID", t.col_type("CENTRALRECEIVING_VLA", "METADATA_GUID"), "{TRIAL_VIALS}")
    made.add("vial_ids", "VIAL_ID", t.col_type("INVENTORY_VLA", "INVENTORYID"), "{TRIAL_VIALS}")
    made.add("vial_guids", "INV_GUID", t.col_type("INVENTORY_VLA", "METADATA_GUID"), "{TRIAL_VIALS}")
    return made


def vials_from_table_ctes(t: LimsTables, reducers: Reducers | None, collation: str | None = None) -> str:
    """CTEs ``base`` (the bound ``{TRIAL_VIALS}``) and ``vials`` (+ receipt
    metadata and schedule, inner). The receipt-role METADATA is first cut to
    the trial's receipts: by a Bloom filter, or with no ``reducers`` (the set
    is proven small) by a broadcast semi join."""
    sched_hint = hint(["S"] if tables_fit(t, dims.SCHEDULE_TABLES) else [])
    cr_roles = ", ".join(f"M.{f} AS {n}" for f, n in RECEIPT_METADATA_ROLES.items())
    meta_hint, meta_cut = reducers.keep("METADATA", "ID", "receipt_guids", "M") if reducers else (
        hint(["RB"]), f"LEFT SEMI JOIN base RB ON {dims.same('M.ID', 'RB.CR_GUID', collation)}")
    base_cols = ", ".join(f"B.{c}" for c in VIAL_COLUMNS[:12])
    roles = ", ".join(f"CRM.{n}" for n in RECEIPT_METADATA_ROLES.values())
    return f"""sched AS ({dims.schedule_sql(t)}),
base AS (SELECT * FROM {{TRIAL_VIALS}}),
crm AS (SELECT {meta_hint} M.ID, {cr_roles} FROM {{METADATA}} M {meta_cut}),
vials AS (
        SELECT {sched_hint} {base_cols}, {roles},
               S.TMS_ID, S.MS_VISIT, S.TRIAL_CODE, S.TP_CODE, S.TP_VISIT, S.TP_DESC, S.TE_NAME
        FROM base B
        JOIN crm CRM ON {dims.same("CRM.ID", "B.CR_GUID", collation)}
        JOIN sched S ON S.TMS_ID = B.CR_TMS)"""


def receipts_from_table_ctes(t: LimsTables, reducers: Reducers, collation: str | None = None) -> str:
    """CTE ``receipts``: the bound ``{TRIAL_RECEIPTS}`` with their metadata and schedule (inner)."""
    cr_roles = ", ".join(f"M.{f} AS {n}" for f, n in RECEIPT_METADATA_ROLES.items())
    meta_hint, meta_cut = reducers.keep("METADATA", "ID", "receipt_guids", "M")
    cols = ", ".join([*(f"R.{c}" for c in VIAL_COLUMNS[3:12]), *(f"CRM.{n}" for n in RECEIPT_METADATA_ROLES.values())])
    return f"""sched AS ({dims.schedule_sql(t)}),
crm AS (SELECT {meta_hint} M.ID, {cr_roles} FROM {{METADATA}} M {meta_cut}),
receipts AS (
        SELECT {hint(["S"] if tables_fit(t, dims.SCHEDULE_TABLES) else [])} R.RECEIPT_ID, {cols},
               S.TMS_ID, S.MS_VISIT, S.TRIAL_CODE, S.TP_CODE, S.TP_VISIT, S.TP_DESC, S.TE_NAME
        FROM {{TRIAL_RECEIPTS}} R
        JOIN crm CRM ON {dims.same("CRM.ID", "R.CR_GUID", collation)}
        JOIN sched S ON S.TMS_ID = R.CR_TMS)"""


def snapshot_sql(
    t: LimsTables,
    trial_pred: str,
    *,
    seq_empty_as_zero: bool = False,
    extra: dict | None = None,
    vials_table: bool = False,
    broadcast_vials: bool = False,
    broadcast_ledger: bool = False,
    vial_ledger: bool = False,
    spread_by: str | None = None,
    collation: str | None = None,
) -> str:
    """The snapshot as one statement (see module doc for the join order).

    ``extra`` adds computed output columns ({name: SQL over snapshot names}).
    ``vials_table`` reads the trial's vials from the bound table
    ``{TRIAL_VIALS}`` and their ledger rows from ``{TRIAL_LEDGER}`` instead of
    joining them inline.

    One trial cuts every large table in its scan before anything is shuffled:
    SAMPLECONTAINERS, METADATA and the ledger by the trial's receipts and
    vials, INVENTORY and the box ledger count by the boxes that its current
    ledger rows point at. Sets that the flags say are proven small do so by
    broadcast semi joins; all others, of any size, by Bloom filters. For all
    trials there is nothing to cut but the boxes, by a shuffled semi join.

    Boxes that are not broadcast are joined by shuffle; in large tables the few
    that hold many of the rows are broadcast apart (:func:`~vialflow.operators.dims.parent_box_join`).
    With ``collation`` all string keys match under it.

    ``vial_ledger`` says that ``{TRIAL_LEDGER}`` carries the vial of each row and the number
    of its receipt in ``{TRIAL_RECEIPTS}``: the rows are then shuffled narrow, and the many
    columns of the receipt come last (see :func:`_receipts_last_sql`). ``spread_by``
    deals the rows of such a snapshot by that column.
    """
    vial_salt = ["V.VIAL_ID"]
    boxes_small = broadcast_ledger or dims.boxes_fit(t, True, collation)
    large = worth_reducing(t, REDUCED_TABLES)
    heavy = large and not boxes_small
    all_trials = not vials_table and trial_pred == "TRUE"
    reducers, base = None, ""
    if vials_table and not (broadcast_vials and broadcast_ledger):
        reducers = table_reducers(t, collation)
        base = reducers.ctes()
    elif not vials_table and not all_trials and large:
        reducers, base = inline_reducers(t, trial_pred, collation)
    main_hint = hint(
        (["CC"] if tables_fit(t, ["CONTAINERS_CONDITION"], collation=collation) else [])
        # the counted trial ledger, and boxes cut to those it references, are small too
        + (["IT", "PC"] if broadcast_ledger else ["PC"] if boxes_small else ["HB"] if heavy else [])
        + (["LP"] if tables_fit(t, dims.LOCATION_TABLES, collation=collation) else [])
    )
    iv_roles = ", ".join(f"{f} AS {n}" for f, n in VIAL_METADATA_ROLES.items())
    exprs = {c: dims.box_column(e[3:], heavy) if e.startswith("PC.") else e for c, e in _SNAPSHOT_EXPR.items()}
    exprs["SEQ_NUM"] = safe_int_sql("V.SEQ", seq_empty_as_zero)
    exprs["BOX_POS"] = grid_ordinal_sql("IT.CONTAINER_POS_Y", "IT.CONTAINER_POS_X", dims.box_column("CONTAINER_AXIS_X_SIZE", heavy))
    select = ",\n               ".join(f"{exprs[c]} AS {c}" for c in SNAPSHOT_COLUMNS)
    cc_key = spread("SC.CONTCODE", vial_salt, t.col_type("SAMPLECONTAINERS_VLA", "CONTCODE"))
    loc_key = spread("IT.LOCATIONCODE", vial_salt, t.col_type("INVENTORY_TRANSACTIONS_VLA", "LOCATIONCODE"))
    box_type = t.col_type("INVENTORY_TRANSACTIONS_VLA", "CONTAINER_INVENTORYID")
    outer = ", ".join(SNAPSHOT_COLUMNS)
    if extra:
        outer += ", " + ", ".join(f"{sql} AS {name}" for name, sql in extra.items())

    def cut(table: str, column: str, name: str, alias: str, base_column: str) -> tuple[str, str]:
        if vials_table and broadcast_vials:
            key = dims.same(f"{alias}.{column}", f"RV.{base_column}", collation if column == "ID" else None)
            return hint(["RV"]), f"LEFT SEMI JOIN base RV ON {key}"
        return reducers.keep(table, column, name, alias) if reducers else ("", "")

    vials = vials_from_table_ctes(t, None if broadcast_vials else reducers, collation) if vials_table else vials_ctes(t, trial_pred, reducers, collation)
    sc_hint, sc_cut = cut("SAMPLECONTAINERS_VLA", "INVENTORYID", "vial_ids", "SC", "VIAL_ID")
    meta_hint, meta_cut = cut("METADATA", "ID", "vial_guids", "M", "INV_GUID")
    ledger = "{TRIAL_LEDGER}" if vials_table else "{INVENTORY_TRANSACTIONS_VLA}"
    # the materialised ledger is the trial's already
    it_hint, it_cut = ("", "") if vials_table or not reducers else reducers.keep("INVENTORY_TRANSACTIONS_VLA", "INVENTORYID", "vial_ids", "IT")
    box_cte, box_ids, box_reduce = "", None, None
    if all_trials or broadcast_ledger:
        box_ids = "box_ids"
        box_cte = f"box_ids AS ({dims.box_ids_sql(t, 'it', boxes_small)}),\n"
    elif reducers:
        in_use = Reducers(t)
        in_use.add("box_filter", "CONTAINER_INVENTORYID", box_type, "it")
        box_cte, box_reduce = in_use.ctes(), (in_use, "box_filter")
    heavy_cte = dims.heavy_boxes_ctes(t, True, "CONTAINER_INVENTORYID", "it", collation) if heavy else ""
    vial_cols, tail = "", f"""snap AS (
        SELECT {main_hint}
               {select},
               {dims.box_column("_CURRENT_ROWS", heavy)} AS _CURRENT_ROWS
        FROM vials V
        JOIN sc SC ON SC.INVENTORYID = V.VIAL_ID
        JOIN it IT ON IT.INVENTORYID = V.VIAL_ID
        JOIN vial_meta IVM ON {dims.same("IVM.ID", "V.INV_GUID", collation)}
        LEFT JOIN {{CONTAINERS_CONDITION}} CC ON {dims.same("CC.CONTCODE", cc_key, collation)} AND SC.CONTCODE IS NOT NULL
        {dims.parent_box_join("IT.CONTAINER_INVENTORYID", box_type, "V.VIAL_ID", vial_salt, heavy)}
        LEFT JOIN locs LP ON {dims.same("LP.RACK_CODE", loc_key, collation)} AND IT.LOCATIONCODE IS NOT NULL)
SELECT {outer}
FROM snap
LATERAL VIEW explode({fanout_sql("_CURRENT_ROWS")}) copies AS _COPY"""
    if vial_ledger:
        vials = receipts_from_table_ctes(t, reducers, collation)
        vial_cols = ", IT.SEQ, IT.INV_GUID, IT.RECEIPT_ID"
        tail = _receipts_last_sql(t, seq_empty_as_zero, outer, box_type, heavy, boxes_small, broadcast_ledger, spread_by, collation)
    return f"""
WITH {base}{vials},
sc AS (SELECT {sc_hint} SC.INVENTORYID, SC.CONTAINERID, SC.SAMPLETYPE, SC.RECEIVEDCONDITION, SC.CONTCODE,
               SC.CONTAINERMATCODE
        FROM {{SAMPLECONTAINERS_VLA}} SC {sc_cut}),
it AS (SELECT {it_hint} IT.INVENTORYID, IT.AMOUNTLEFT, IT.AMOUNT_UNIT_CODE, IT.THAWCOUNT, IT.CONSENT_TYPE,
               IT.LOCATIONCODE, IT.CONTAINER_POS_Y, IT.CONTAINER_POS_X, IT.CONTAINER_INVENTORYID{vial_cols}
        FROM {ledger} IT {it_cut}
        WHERE IT.FLAG_CURRENT = 1),
{box_cte}vial_meta AS (SELECT {meta_hint} M.ID, {iv_roles} FROM {{METADATA}} M {meta_cut}),
boxes AS ({dims.boxes_sql(t, True, box_ids, broadcast_ledger, box_reduce, collation)}),
{heavy_cte}locs AS ({dims.location_path_sql(t, collation)}),
{tail}"""


def _receipts_last_sql(t, seq_empty_as_zero, outer, box_type, heavy, boxes_small, broadcast_ledger, spread_by, collation) -> str:
    """The joins of a snapshot whose ledger rows carry their vial.

    Rows are shuffled by vial, metadata and box with the vial's few columns alone. The receipt
    comes last: its rows are then together, and dealing them by ``spread_by`` repeats little.
    Conditions and locations that may be broadcast are joined after that.
    """
    salt = ["IT.INVENTORYID"]
    small = {"CC": tables_fit(t, ["CONTAINERS_CONDITION"], collation=collation),
             "LP": tables_fit(t, dims.LOCATION_TABLES, collation=collation)}

    def lookups(names: Iterable[str], key: dict[str, str], at: list[str]) -> str:
        cc = spread(key["CC"], at, t.col_type("SAMPLECONTAINERS_VLA", "CONTCODE"))
        loc = spread(key["LP"], at, t.col_type("INVENTORY_TRANSACTIONS_VLA", "LOCATIONCODE"))
        text = {"CC": f"LEFT JOIN {{CONTAINERS_CONDITION}} CC ON {dims.same('CC.CONTCODE', cc, collation)} AND {key['CC']} IS NOT NULL",
                "LP": f"LEFT JOIN locs LP ON {dims.same('LP.RACK_CODE', loc, collation)} AND {key['LP']} IS NOT NULL"}
        return "\n        ".join(text[n] for n in names)

    early, late = [n for n in small if not small[n]], [n for n in small if small[n]]
    exprs = {c: e for c, e in _SNAPSHOT_EXPR.items() if c in SNAPSHOT_COLUMNS}
    of = lambda *sides: {c: e for c, e in exprs.items() if e.split(".")[0] in sides}
    vial = {"SEQ": "IT.SEQ", "VIAL_CONTAINER_INV_ID": "IT.INVENTORYID"}
    receipt = [c for c in of("V") if c not in vial]
    boxes = {c: dims.box_column(e[3:], heavy) for c, e in {**of("PC"), "_CURRENT_ROWS": "PC._CURRENT_ROWS"}.items()}
    rows = {**of("IT", "SC", "IVM", *early), **boxes, **vial,
            **({"_LOC": "IT.LOCATIONCODE"} if small["LP"] else {}), **({"_CONT": "SC.CONTCODE"} if small["CC"] else {})}
    names = (["IT", "PC"] if broadcast_ledger else ["PC"] if boxes_small else ["HB"] if heavy else [])
    spread_hint = f"/*+ REBALANCE({spread_by}) */" if spread_by else ""
    derived = {"SEQ_NUM": safe_int_sql("B.SEQ", seq_empty_as_zero), **of(*late),
               "BOX_POS": grid_ordinal_sql("B.CONTAINER_POS_Y", "B.CONTAINER_POS_X", "B.CONTAINER_AXIS_X_SIZE")}
    listed = lambda d: ", ".join(f"{e} AS {c}" for c, e in d.items())
    return f"""boxed AS (
        SELECT {hint(names)} {listed(rows)}, IT.RECEIPT_ID AS _RECEIPT
        FROM it IT
        JOIN sc SC ON SC.INVENTORYID = IT.INVENTORYID
        JOIN vial_meta IVM ON {dims.same("IVM.ID", "IT.INV_GUID", collation)}
        {dims.parent_box_join("IT.CONTAINER_INVENTORYID", box_type, "IT.INVENTORYID", salt, heavy)}
        {lookups(early, {"CC": "SC.CONTCODE", "LP": "IT.LOCATIONCODE"}, salt)}),
received AS (
        SELECT {", ".join(f"V.{c}" for c in receipt)}, {", ".join(f"X.{c}" for c in rows)}
        FROM boxed X
        JOIN receipts V ON V.RECEIPT_ID = X._RECEIPT),
dealt AS (
        SELECT {spread_hint} {", ".join([*receipt, *(c for c in rows if c != "_CURRENT_ROWS")])}
        FROM received
        LATERAL VIEW explode({fanout_sql("_CURRENT_ROWS")}) copies AS _COPY),
snap AS (
        SELECT {hint(late)} {", ".join(f"{derived[c]} AS {c}" if c in derived else f"B.{c}" for c in SNAPSHOT_COLUMNS)}
        FROM dealt B
        {lookups(late, {"CC": "B._CONT", "LP": "B._LOC"}, ["B.VIAL_CONTAINER_INV_ID"])})
SELECT {outer}
FROM snap"""


def parent_fanout(t: LimsTables) -> DataFrame:
    """(INVENTORYID, PARENT_CONTAINER_INV_ID): every current ledger row, once for each current row of its box.

    The snapshot's box join on its own, for the items of all trials: boxes and
    their ledger counts are cut to those in use, and boxes that hold many of
    the rows are broadcast apart.
    """
    boxes_small = dims.boxes_fit(t, True)
    heavy = not boxes_small and worth_reducing(t, REDUCED_TABLES)
    box_type = t.col_type("INVENTORY_TRANSACTIONS_VLA", "CONTAINER_INVENTORYID")
    heavy_cte = dims.heavy_boxes_ctes(t, True, "CONTAINER_INVENTORYID", "it") if heavy else ""
    text = f"""
WITH it AS (SELECT INVENTORYID, CONTAINER_INVENTORYID FROM {{INVENTORY_TRANSACTIONS_VLA}} WHERE FLAG_CURRENT = 1),
box_ids AS ({dims.box_ids_sql(t, "it", boxes_small)}),
{heavy_cte}boxes AS ({dims.boxes_sql(t, True, "box_ids")}),
rows AS (
        SELECT {hint(["HB"] if heavy else ["PC"] if boxes_small else [])} IT.INVENTORYID, {dims.box_column("PARENT_CONTAINER_INV_ID", heavy)} AS PARENT_CONTAINER_INV_ID,
               {dims.box_column("_CURRENT_ROWS", heavy)} AS _CURRENT_ROWS
        FROM it IT
        {dims.parent_box_join("IT.CONTAINER_INVENTORYID", box_type, "IT.INVENTORYID", ["IT.INVENTORYID"], heavy)})
SELECT INVENTORYID, PARENT_CONTAINER_INV_ID
FROM rows
LATERAL VIEW explode({fanout_sql("_CURRENT_ROWS")}) copies AS _COPY"""
    return run(t.spark, text, t)


@dataclass
class TrialVials:
    """A trial's vials and their ledger rows, written to the shared scratch
    folder, each with an exact row count and a broadcast verdict."""

    frame: DataFrame
    rows: int
    path: str
    broadcastable: bool
    ledger: DataFrame
    ledger_rows: int
    ledger_path: str
    ledger_broadcastable: bool
    order: Bounds | None = None
    receipts: DataFrame | None = None
    receipts_path: str | None = None
    #: Whether each ledger row carries its vial (once for each of several): then nothing is joined to the vials again.
    vial_ledger: bool = False

    @property
    def paths(self) -> tuple[str, ...]:
        return (self.path, self.ledger_path, *([self.receipts_path] if self.receipts_path else []))

    def tables(self, t: LimsTables) -> dict[str, DataFrame]:
        more = {} if self.receipts is None else {"TRIAL_RECEIPTS": self.receipts}
        return {**t.frames, "TRIAL_VIALS": self.frame, "TRIAL_LEDGER": self.ledger, **more}


# Columns with few values stand together: shuffled rows then repeat each other's bytes and compress.
LEDGER_COLUMNS = (
    "AMOUNT_UNIT_CODE", "CONSENT_TYPE", "COMMENTS", "FLAG_CURRENT", "THAWCOUNT", "CONTAINER_POS_Y", "CONTAINER_POS_X",
    "AMOUNTLEFT", "LOCATIONCODE", "INVENTORYID", "TRANSACTION_ID", "CONTAINER_INVENTORYID",
)


MAX_REDUCER_ROWS = 2_000_000
CONF_MAX_REDUCER_ROWS = "vialflow.semijoin.maxRows"


def materialize_trial_vials(t: LimsTables, trial_codes: TrialCodes, collation: str | None = None) -> TrialVials:
    """Write the trial's vials (vial + receipt + schedule columns) once.

    The write cuts the lineage (a lost executor later recomputes from this
    table, not from the receipt joins), gives an exact row count and a true
    file size, and lets snapshot and history share one scan of the vial and
    receipt tables. It is broadcast into semi joins only if both the row
    count and the file-size estimate are within bounds. Vials of large tables
    that are not are joined to the ledger here and not again: each ledger row is
    written with its trial, current rows also with the vial's other columns.
    """
    spark = t.spark
    raw = spark.conf.get(CONF_MAX_REDUCER_ROWS, None)
    max_rows = int(raw) if raw else MAX_REDUCER_ROWS

    def write(df: DataFrame, name: str, *seen: Column) -> tuple[tuple[DataFrame, int, str, bool], dict]:
        observed, obs = observe_rows(df, name, *seen)
        path = scratch_path(spark, name)
        observed.write.mode("overwrite").parquet(path)
        rows = int(obs.get.get("rows", 0))
        frame = spark.read.parquet(path)
        return (frame, rows, path, rows <= max_rows and fits_broadcast(frame)), obs.get

    pred, args = trial_where(t, "CR.LAST_NAME", trial_codes, collation)
    made: list[str] = []
    receipts = None
    try:
        if worth_reducing(t, REDUCED_TABLES):
            (receipts, *_, path, _), _ = write(run(spark, trial_receipts_sql(pred), t, args).select(*RECEIPT_COLUMNS), "trial_receipts")
            made.append(path)
            text = trial_vials_sql(t, pred, receipts_table=True)
            rows = run(spark, text, {**t.frames, "TRIAL_RECEIPTS": receipts}).select(*BASE_VIAL_COLUMNS, "RECEIPT_ID")
        else:
            rows = run(spark, trial_vials_sql(t, pred), t, args).select(*BASE_VIAL_COLUMNS)
        vials, _ = write(rows, "trial_vials")
        made.append(vials[2])
        joined = receipts is not None and not vials[3]
        more = {"receipts": receipts, "receipts_path": made[0] if receipts is not None else None, "vial_ledger": joined}
        rows = run(spark, ledger_sql(vials[3], joined), {**t.frames, "TRIAL_VIALS": vials[0]})
        if not can_sketch(rows, "INVENTORYID", "TRANSACTION_ID"):
            return TrialVials(*vials, *write(rows, "trial_ledger")[0], **more)
        # the history's order: bounds from a sketch taken during the write
        ledger, seen = write(rows, "trial_ledger", sketch("INVENTORYID").alias("ids"))
        parts = wanted_partitions(ledger[1], int(spark.conf.get("spark.sql.shuffle.partitions")))
        order = bounds(ledger[0], "INVENTORYID", "TRANSACTION_ID", seen.get("ids"), ledger[1], parts)
        return TrialVials(*vials, *ledger, order, **more)
    except BaseException:
        for path in made:
            delete_path(spark, path)
        raise


def ledger_sql(broadcast_vials: bool, joined: bool) -> str:
    """The trial's ledger rows: the ledger is scanned once here, cut map-side by the
    broadcast vial set when that set is small. ``joined`` rows come with their vial, once for each row of it."""
    cols = ", ".join("IT." + c for c in LEDGER_COLUMNS)
    source = f"(SELECT {', '.join(LEDGER_COLUMNS)} FROM {{INVENTORY_TRANSACTIONS_VLA}}) IT"
    if not joined:
        return f"""
SELECT {hint(["V"]) if broadcast_vials else ""} {cols}
FROM {source} LEFT SEMI JOIN {{TRIAL_VIALS}} V ON IT.INVENTORYID = V.VIAL_ID"""
    vial = ", ".join(f"IF(IT.FLAG_CURRENT = 1, V.{c}, NULL) AS {c}" for c in ("SEQ", "INV_GUID", "RECEIPT_ID"))
    return f"""
SELECT V.LAST_NAME, {cols}, {vial}
FROM {source} JOIN (SELECT LAST_NAME, SEQ, INV_GUID, RECEIPT_ID, VIAL_ID FROM {{TRIAL_VIALS}}) V ON IT.INVENTORYID = V.VIAL_ID"""


def trial_inventory(
    t: LimsTables,
    trial_codes: TrialCodes,
    *,
    collation: str | None = None,
    seq_empty_as_zero: bool = False,
    vials: TrialVials | None = None,
) -> DataFrame:
    """The 63-column current-inventory snapshot (see module doc for the plan).

    With ``vials`` (from :func:`materialize_trial_vials`) the plan starts from
    that table and, when it is small enough, reduces the large vial-keyed
    tables by it before they shuffle.
    """
    return _snapshot(t, trial_codes, collation, vials, seq_empty_as_zero=seq_empty_as_zero)


def trial_extract(
    t: LimsTables,
    trial_codes: TrialCodes,
    *,
    no_viable: bool = False,
    exclude_conditions: Iterable = DEFAULT_EXCLUDE_CONDITIONS,
    exclude_matcodes: Iterable = DEFAULT_EXCLUDE_MATCODES,
    collation: str | None = None,
    seq_empty_as_zero: bool = False,
    vials: TrialVials | None = None,
    spread_by: str | None = None,
) -> DataFrame:
    """Snapshot + ``SAMPLEID``/``SAMPLEID2`` from comments + ``VIABLE`` flag.

    Same columns and values as ``flag_viable(extract_sampleid(trial_inventory(..)))``,
    stated in the same statement so it is analysed once. ``spread_by`` deals the rows by
    that column for a partitioned write (``REBALANCE`` hint: AQE splits a hot value over several tasks and merges small ones).
    """
    extra = sampleid_sqls("COMMENTS")
    if not no_viable:
        floating = t.col_type("INVENTORY_TRANSACTIONS_VLA", "AMOUNTLEFT") in ("double", "float")
        extra["VIABLE"] = viable_sql(floating, exclude_conditions, exclude_matcodes)
    inside = spread_by if vials is not None and vials.vial_ledger else None
    rows = _snapshot(t, trial_codes, collation, vials, seq_empty_as_zero=seq_empty_as_zero, extra=extra, spread_by=inside)
    return rebalance(rows, spread_by) if spread_by and not inside else rows


def rebalance(df: DataFrame, *cols: str) -> DataFrame:
    """Hash-partition by ``cols`` for a partitioned write, letting AQE split a
    hot value over several tasks and merge small ones (``REBALANCE`` hint).

    Without it every task writes a file into every trial folder it touches;
    a plain hash repartition would put a trial with a third of all rows into
    one task.
    """
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({', '.join(cols)}) */ * FROM {{df}}", df=df)


def _snapshot(t, trial_codes, collation, vials, **kw) -> DataFrame:
    if vials is None:
        pred, args = trial_where(t, "CR.LAST_NAME", trial_codes, collation)
        return run(t.spark, snapshot_sql(t, pred, collation=collation, **kw), t, args)
    text = snapshot_sql(t, "TRUE", vials_table=True, broadcast_vials=vials.broadcastable,
                        broadcast_ledger=vials.ledger_broadcastable, vial_ledger=vials.vial_ledger, collation=collation, **kw)
    return run(t.spark, text, vials.tables(t))
