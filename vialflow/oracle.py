"""DuckDB oracle SQL, one statement per registered query.

Stated independently of the Spark plans: the correlated parent-box lookups
stay ``LEFT JOIN LATERAL`` (DuckDB decorrelates them itself), the storage
levels are three plain left joins with the level shift as CASE columns, and
every dimension is joined where it is used, not pre-joined. The derived LIMS
tables come from the shared fixture SQL as CTEs; only the 14 driver tables
are assumed to be registered as views.

Dialect guards: DuckDB's ``TRY_CAST('1.5' AS INTEGER)`` rounds where Spark's
returns NULL, so the integer cast is guarded by a full match on an integer
literal; sums are cast to BIGINT (DuckDB widens them to HUGEINT).
"""

from __future__ import annotations

from .plans.history import HISTORY_COLUMNS
from .plans.inventory import SNAPSHOT_COLUMNS
from .sources.fixtures import oracle_ctes
from .sources.tables import TABLE_NAMES

TRIAL = "BUILDING"
CONDS = "('SNR', 'QNSR', 'QNS', 'NSI')"
MATS = "('100x100Box')"


def slug_sql(x: str) -> str:
    ascii_ = f"strip_accents({x})"
    for src, dst in (("ß", "ss"), ("Æ", "AE"), ("æ", "ae"), ("Œ", "OE"), ("œ", "oe"), ("Ø", "O"), ("ø", "o"),
                     ("Đ", "D"), ("đ", "d"), ("Þ", "TH"), ("þ", "th"), ("Ł", "L"), ("ł", "l")):
        ascii_ = f"replace({ascii_}, '{src}', '{dst}')"
    no_comma = f"regexp_replace({ascii_}, '([0-9]),([0-9])', '\\1\\2', 'g')"
    return f"regexp_replace(regexp_replace({no_comma}, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


def first_match_sql(x: str, rx: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{rx}') THEN regexp_extract({x}, '{rx}', 1) END"


def safe_int_sql(x: str) -> str:
    return (
        f"CAST(CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') "
        f"THEN TRY_CAST(trim({x}) AS INTEGER) END AS INTEGER)"
    )


def ordinal_sql(ledger: str, material: str) -> str:
    return f"CAST(({ledger}.CONTAINER_POS_Y - 1) * {material}.CONTAINER_AXIS_X_SIZE + {ledger}.CONTAINER_POS_X AS INTEGER)"


def box_lateral(ledger: str, self_id: str) -> str:
    """The ledger row's containing box, never the item itself (correlated)."""
    return f"""LEFT JOIN LATERAL (
        SELECT b.INVENTORYID, b.MATCODE, b.EXTERNAL_CODE, b.INVENTORY_CODE FROM INVENTORY b
        WHERE b.INVENTORYID = {ledger}.CONTAINER_INVENTORYID AND b.INVENTORYID <> {self_id}) box ON TRUE"""


# Each current ledger row of the box joins (columns unused): one copy per row.
BOX_LEDGER_LATERAL = """LEFT JOIN LATERAL (
        SELECT bl.INVENTORYID FROM INVENTORY_TRANSACTIONS bl
        WHERE bl.INVENTORYID = box.INVENTORYID AND bl.FLAG_CURRENT = 1) box_led ON TRUE"""

STORAGE_JOINS = """
    LEFT JOIN LOCATIONS lv1 ON lv1.LOCATIONCODE = led.LOCATIONCODE
    LEFT JOIN LOCATIONS lv2 ON lv2.LOCATIONCODE = lv1.PARENT_LOCATION_CODE
    LEFT JOIN LOCATIONS lv3 ON lv3.LOCATIONCODE = lv2.PARENT_LOCATION_CODE
    LEFT JOIN ROOMS room ON room.ROOM_ID = lv3.ROOM_ID
    LEFT JOIN BUILDINGS bldg ON bldg.BUILDING_ID = room.BUILDING_ID"""

# The level shift. With a third level the names are those of levels 3, 2 and 1;
# without one those of levels 2 and 1, and no rack.
STORAGE_COLUMNS = {
    "FREEZER": "CASE WHEN lv3.LOCATIONCODE IS NOT NULL THEN lv3.LOCATION_NAME ELSE lv2.LOCATION_NAME END",
    "SHELF": "CASE WHEN lv3.LOCATIONCODE IS NOT NULL THEN lv2.LOCATION_NAME ELSE lv1.LOCATION_NAME END",
    "RACK": "CASE WHEN lv3.LOCATIONCODE IS NOT NULL THEN lv1.LOCATION_NAME END",
}

# Output column -> source, over the aliases of ``snapshot_sql``.
SNAPSHOT_SOURCES = {
    "TRIAL_CODE": "study.TRIAL_CODE", "SUBJECTID": "rcpt.SUBJECTID", "LABID": "rcpt.FIRST_NAME",
    "CID": "tube.CONTAINERID", "SAMPLETYPE": "tube.SAMPLETYPE", "PRESERVATIVE": "cond.PRESERVATIVE",
    "AMOUNTLEFT": "led.AMOUNTLEFT", "AMOUNT_UNIT_CODE": "led.AMOUNT_UNIT_CODE", "THAWCOUNT": "led.THAWCOUNT",
    "SEQ": "vial.EXTERNAL_CODE", "SEQ_NUM": safe_int_sql("vial.EXTERNAL_CODE"), **STORAGE_COLUMNS,
    "BOX_CODE": "box.INVENTORY_CODE", "BOX_NAME": "box.EXTERNAL_CODE", "BOX_POS": ordinal_sql("led", "mat"),
    "ACCESSION": "rcpt.FOLDERNO", "DATE_COLLECTED": "rcpt.DATE_COLLECTED", "DATE_RECEIVED": "rcpt.DATE_RECEIVED",
    "RECEIVED_CONDITION": "tube.RECEIVEDCONDITION", "SAMPLE_CONDITION": "vmeta.FIELD16",
    "COMMENTS": "vmeta.FIELD01", "MS_VISIT": "visit.MSDESCRIPTION", "TMS_ID": "visit.TRIAL_MASTER_SCHEDULE_ID",
    "TP_CODE": "tp.CODE", "TP_VISIT": "tp.VISIT", "TP_DESC": "tp.DESCRIPTION", "TE_NAME": "elem.ELEMENT_NAME",
    "CR_VISIT": "rmeta.FIELD02", "NICKNAME": "rmeta.FIELD03", "CPT": "rmeta.FIELD12", "EDTA1": "rmeta.FIELD14",
    "EDTA2": "rmeta.FIELD15", "PAXGENE": "rmeta.FIELD16", "SST1": "rmeta.FIELD13", "SST2": "rmeta.FIELD17",
    "SST3": "rmeta.FIELD18", "EDTA1_VOLUME": "rmeta.FIELD20", "ORASURE": "rmeta.FIELD22",
    "BARCODE": "vmeta.FIELD28", "CONSENT_TYPE": "led.CONSENT_TYPE", "RACK_CODE": "lv1.LOCATIONCODE",
    "SHELF_SORT": "lv2.SORTER", "RACK_SORT": "lv1.SORTER", "CONTAINERMATCODE": "tube.CONTAINERMATCODE",
    "MATCODE": "box.MATCODE", "CONTAINER_POS_Y": "led.CONTAINER_POS_Y",
    "CONTAINER_AXIS_Y_SIZE": "mat.CONTAINER_AXIS_Y_SIZE", "CONTAINER_POS_X": "led.CONTAINER_POS_X",
    "CONTAINER_AXIS_X_SIZE": "mat.CONTAINER_AXIS_X_SIZE", "LAST_NAME": "rcpt.LAST_NAME",
    "STUDY_SITE": "rcpt.RASCLIENTID", "LONGNAME": "lv1.LONGNAME", "LONGCODE": "lv1.LONGCODE",
    "ROOM_NAME": "room.ROOM_NAME", "ROOM_CODE": "room.ROOM_CODE", "BUILDING_NAME": "bldg.BUILDING_NAME",
    "BUILDING_CODE": "bldg.BUILDING_CODE", "ARCHIVE_STATUS": "rcpt.ARCSTATUS",
    "VIAL_CONTAINER_INV_ID": "vial.INVENTORYID", "PARENT_CONTAINER_INV_ID": "box.INVENTORYID",
    "CR_ORIGREC": "rcpt.ORIGREC",
}

HISTORY_SOURCES = {
    "INVENTORYID": "led.INVENTORYID", "TRANSACTION_ID": "led.TRANSACTION_ID", "TRANSACTION_DT": "hdr.TRANSACTION_DT",
    "USRNAM": "hdr.USRNAM", "AMOUNTLEFT": "led.AMOUNTLEFT", "AMOUNT_UNIT_CODE": "led.AMOUNT_UNIT_CODE",
    "TRANSACTION_TYPE": "hdr.TRANSACTION_TYPE", "COMMENTS": "led.COMMENTS", "CONTAINER_POS_Y": "led.CONTAINER_POS_Y",
    "CONTAINER_POS_X": "led.CONTAINER_POS_X", "FLAG_CURRENT": "led.FLAG_CURRENT", "BOX_NAME": "box.EXTERNAL_CODE",
    "BOX_CODE": "box.INVENTORY_CODE", "BOX_POS": ordinal_sql("led", "mat"), "LOCATION_NAME": "loc.LOCATION_NAME",
    "LONGNAME": "loc.LONGNAME",
}


def _select(sources: dict[str, str], columns) -> str:
    return ",\n    ".join(f"{sources[c]} AS {c}" for c in columns)


def snapshot_sql(where: str) -> str:
    return f"""
SELECT {_select(SNAPSHOT_SOURCES, SNAPSHOT_COLUMNS)}
FROM INVENTORY_VLA vial
    JOIN CENTRALRECEIVING_VLA rcpt ON rcpt.EXTERNAL_ID = vial.EXTERNAL_ID
    JOIN SAMPLECONTAINERS_VLA tube ON tube.INVENTORYID = vial.INVENTORYID
    JOIN INVENTORY_TRANSACTIONS_VLA led ON led.INVENTORYID = vial.INVENTORYID AND led.FLAG_CURRENT = 1
    JOIN METADATA rmeta ON rmeta.ID = rcpt.METADATA_GUID
    JOIN METADATA vmeta ON vmeta.ID = vial.METADATA_GUID
    JOIN TRIAL_MASTER_SCHEDULE visit ON visit.TRIAL_MASTER_SCHEDULE_ID = rcpt.TRIAL_MASTER_SCHEDULE_ID
    JOIN TRIAL study ON study.TRIAL_ID = visit.TRIAL_ID
    LEFT JOIN TRIAL_ELEMENT_TIMEPOINT tp ON tp.TRIAL_ELEMENT_TP_ID = visit.TRIAL_ELEMENT_TP_ID
    LEFT JOIN TRIAL_ELEMENT elem ON elem.TRIAL_ELEMENT_ID = tp.TRIAL_ELEMENT_ID
    LEFT JOIN CONTAINERS_CONDITION cond ON cond.CONTCODE = tube.CONTCODE
    {box_lateral("led", "vial.INVENTORYID")}
    {BOX_LEDGER_LATERAL}
    LEFT JOIN MATERIALS mat ON mat.MATCODE = box.MATCODE
    {STORAGE_JOINS}
{where}"""


VIABLE_SQL = f"""COALESCE(
        MATCODE IS NOT NULL AND MATCODE NOT IN {MATS}
        AND COALESCE(RECEIVED_CONDITION NOT IN {CONDS}, TRUE)
        AND COALESCE(SAMPLE_CONDITION NOT IN {CONDS}, TRUE)
        AND AMOUNTLEFT IS NOT NULL AND NOT isnan(AMOUNTLEFT) AND AMOUNTLEFT > 0, FALSE)"""


def extract_sql(where: str) -> str:
    return f"""
SELECT s.*,
    {first_match_sql("COMMENTS", "SAMPLEID:(.*?),")} AS SAMPLEID,
    {first_match_sql("COMMENTS", r"LAB_ID:(\d+)")} AS SAMPLEID2,
    {VIABLE_SQL} AS VIABLE
FROM ({snapshot_sql(where)}) s"""


def history_sql(where: str) -> str:
    return f"""
SELECT {_select(HISTORY_SOURCES, HISTORY_COLUMNS)}
FROM INVENTORY_TRANSACTIONS_VLA led
    JOIN INVENTORY_VLA vial ON vial.INVENTORYID = led.INVENTORYID
    JOIN CENTRALRECEIVING_VLA rcpt ON rcpt.EXTERNAL_ID = vial.EXTERNAL_ID
    LEFT JOIN TRANSACTIONS hdr ON hdr.TRANSACTION_ID = led.TRANSACTION_ID
    {box_lateral("led", "led.INVENTORYID")}
    LEFT JOIN MATERIALS mat ON mat.MATCODE = box.MATCODE
    LEFT JOIN LOCATIONS loc ON loc.LOCATIONCODE = led.LOCATIONCODE
{where}"""


# String keys that match whatever their letters and blanks at the end, in the collated queries.
COLLATED_KEYS = (
    ("rmeta.ID", "rcpt.METADATA_GUID"), ("vmeta.ID", "vial.METADATA_GUID"), ("cond.CONTCODE", "tube.CONTCODE"),
    ("mat.MATCODE", "box.MATCODE"), ("lv1.LOCATIONCODE", "led.LOCATIONCODE"), ("lv2.LOCATIONCODE", "lv1.PARENT_LOCATION_CODE"),
    ("lv3.LOCATIONCODE", "lv2.PARENT_LOCATION_CODE"), ("loc.LOCATIONCODE", "led.LOCATIONCODE"), ("rcpt.LAST_NAME", f"'{TRIAL.lower()}'"),
)


def collated(statement: str) -> str:
    """``statement`` with its string keys compared in lower case and without blanks at the end."""
    for left, right in COLLATED_KEYS:
        statement = statement.replace(f"{left} = {right}", f"lower(rtrim({left})) = lower(rtrim({right}))")
    return statement


TRIAL_WHERE = f"WHERE rcpt.LAST_NAME = '{TRIAL}'"


def _pct(bad: str, total: str) -> str:
    return (
        f"CASE WHEN {total} > 0 THEN round_even(CAST({bad} AS DOUBLE) / CAST({total} AS DOUBLE) * 100.0, 2) "
        "ELSE CAST(0 AS DOUBLE) END"
    )


BODIES: dict[str, str] = {
    "scan_specimen_tables": "\nUNION ALL\n".join(
        f"SELECT '{n}' AS TABLE_NAME, count(*) AS N_ROWS FROM {n}" for n in TABLE_NAMES
    ),
    "param_query": f"""
SELECT led.LOCATIONCODE, CAST(date_trunc('month', rcpt.DATE_RECEIVED) AS DATE) AS RECEIVED_MONTH,
    count(*) AS N_MOVES, sum(led.AMOUNTLEFT) AS AMOUNT
FROM CENTRALRECEIVING_VLA rcpt JOIN INVENTORY_VLA vial ON vial.EXTERNAL_ID = rcpt.EXTERNAL_ID
    JOIN INVENTORY_TRANSACTIONS_VLA led ON led.INVENTORYID = vial.INVENTORYID
{TRIAL_WHERE} GROUP BY 1, 2""",
    "history_stream": history_sql(TRIAL_WHERE),
    "history_kept": history_sql(TRIAL_WHERE),
    "sink_roundtrip": extract_sql(TRIAL_WHERE),
    "trial_slug": f"""
SELECT TRIAL_CODE, {slug_sql("TRIAL_CODE")} AS TRIAL_SLUG,
    {slug_sql("TRIAL_CODE")} || '.parquet' AS FILE_NAME,
    {slug_sql("TRIAL_CODE || '_PROD'")} || '.parquet' AS PROD_FILE_NAME,
    {slug_sql("TRIAL_CODE")} || '_history.parquet' AS HISTORY_FILE_NAME
FROM (SELECT DISTINCT LAST_NAME AS TRIAL_CODE FROM CENTRALRECEIVING_VLA) q""",
    "history_row_counts": f"""
SELECT INVENTORYID, count(*) AS N_ROWS, CAST(sum(FLAG_CURRENT) AS BIGINT) AS N_CURRENT
FROM ({history_sql(TRIAL_WHERE)}) h GROUP BY INVENTORYID""",
    "trial_inventory": snapshot_sql(TRIAL_WHERE),
    "trial_extract": extract_sql(TRIAL_WHERE),
    "inventory_history": history_sql(TRIAL_WHERE) + "\nORDER BY 1, 2",
    "trial_filter": f"SELECT * FROM CENTRALRECEIVING_VLA WHERE LAST_NAME = '{TRIAL}'",
    "storage_path": f"""
SELECT led.INVENTORYID, led.TRANSACTION_ID, led.LOCATIONCODE, lv1.LOCATIONCODE AS RACK_CODE,
    {", ".join(f"{sql} AS {name}" for name, sql in STORAGE_COLUMNS.items())},
    lv2.SORTER AS SHELF_SORT, lv1.SORTER AS RACK_SORT, lv1.LONGNAME AS LONGNAME,
    room.ROOM_NAME AS ROOM_NAME, bldg.BUILDING_NAME AS BUILDING_NAME
FROM INVENTORY_TRANSACTIONS_VLA led {STORAGE_JOINS}""",
    "seq_num": f"""
SELECT INVENTORYID, EXTERNAL_CODE AS SEQ, {safe_int_sql("EXTERNAL_CODE")} AS SEQ_NUM FROM INVENTORY_VLA""",
    "box_position": f"""
SELECT led.INVENTORYID, led.TRANSACTION_ID, led.CONTAINER_INVENTORYID, box.INVENTORYID AS PARENT_CONTAINER_INV_ID,
    box.MATCODE AS MATCODE, {ordinal_sql("led", "mat")} AS BOX_POS
FROM INVENTORY_TRANSACTIONS_VLA led
    {box_lateral("led", "led.INVENTORYID")}
    LEFT JOIN MATERIALS mat ON mat.MATCODE = box.MATCODE""",
    "metadata_roles": f"""
SELECT vial.INVENTORYID AS VIAL_CONTAINER_INV_ID, rcpt.LAST_NAME AS LAST_NAME,
    {_select(SNAPSHOT_SOURCES, ("CR_VISIT", "NICKNAME", "CPT", "EDTA1", "EDTA2", "PAXGENE", "SST1", "SST2", "SST3",
                                "EDTA1_VOLUME", "ORASURE", "SAMPLE_CONDITION", "COMMENTS", "BARCODE"))}
FROM INVENTORY_VLA vial
    JOIN CENTRALRECEIVING_VLA rcpt ON rcpt.EXTERNAL_ID = vial.EXTERNAL_ID
    JOIN METADATA rmeta ON rmeta.ID = rcpt.METADATA_GUID
    JOIN METADATA vmeta ON vmeta.ID = vial.METADATA_GUID""",
    "not_in_nullsafe": f"""
SELECT INVENTORYID, RECEIVEDCONDITION AS RECEIVED_CONDITION,
    COALESCE(RECEIVEDCONDITION NOT IN {CONDS}, TRUE) AS NOT_EXCLUDED,
    (RECEIVEDCONDITION IS NOT NULL AND RECEIVEDCONDITION NOT IN {CONDS}) AS NOT_EXCLUDED_NOR_NULL
FROM SAMPLECONTAINERS_VLA""",
    "missing_amount": """
SELECT INVENTORYID, TRANSACTION_ID, AMOUNTLEFT,
    (AMOUNTLEFT IS NULL OR isnan(AMOUNTLEFT)) AS AMOUNT_MISSING,
    COALESCE(AMOUNTLEFT > 0 AND NOT isnan(AMOUNTLEFT), FALSE) AS AMOUNT_POSITIVE
FROM INVENTORY_TRANSACTIONS_VLA""",
    "flag_viable": f"""
SELECT VIAL_CONTAINER_INV_ID, PARENT_CONTAINER_INV_ID, LAST_NAME, MATCODE, RECEIVED_CONDITION,
    SAMPLE_CONDITION, AMOUNTLEFT, VIABLE
FROM ({extract_sql("")}) e""",
    "inner_receipt": """
SELECT vial.INVENTORYID AS VIAL_CONTAINER_INV_ID, rcpt.EXTERNAL_ID AS EXTERNAL_ID, rcpt.LAST_NAME AS LAST_NAME,
    rcpt.SUBJECTID AS SUBJECTID
FROM INVENTORY_VLA vial JOIN CENTRALRECEIVING_VLA rcpt ON rcpt.EXTERNAL_ID = vial.EXTERNAL_ID""",
    "current_transaction": """
SELECT vial.INVENTORYID AS VIAL_CONTAINER_INV_ID, led.LOCATIONCODE AS LOCATIONCODE,
    led.CONTAINER_INVENTORYID AS CONTAINER_INVENTORYID, led.AMOUNTLEFT AS AMOUNTLEFT, led.THAWCOUNT AS THAWCOUNT
FROM INVENTORY_VLA vial
    JOIN INVENTORY_TRANSACTIONS_VLA led ON led.INVENTORYID = vial.INVENTORYID AND led.FLAG_CURRENT = 1""",
    "left_lookups": f"""
SELECT vial.INVENTORYID AS VIAL_CONTAINER_INV_ID,
    {_select(SNAPSHOT_SOURCES, ("TMS_ID", "MS_VISIT", "TRIAL_CODE", "TP_CODE", "TP_VISIT", "TP_DESC", "TE_NAME",
                                "PRESERVATIVE"))}
FROM INVENTORY_VLA vial
    JOIN CENTRALRECEIVING_VLA rcpt ON rcpt.EXTERNAL_ID = vial.EXTERNAL_ID
    JOIN METADATA rmeta ON rmeta.ID = rcpt.METADATA_GUID
    JOIN SAMPLECONTAINERS_VLA tube ON tube.INVENTORYID = vial.INVENTORYID
    JOIN TRIAL_MASTER_SCHEDULE visit ON visit.TRIAL_MASTER_SCHEDULE_ID = rcpt.TRIAL_MASTER_SCHEDULE_ID
    JOIN TRIAL study ON study.TRIAL_ID = visit.TRIAL_ID
    LEFT JOIN TRIAL_ELEMENT_TIMEPOINT tp ON tp.TRIAL_ELEMENT_TP_ID = visit.TRIAL_ELEMENT_TP_ID
    LEFT JOIN TRIAL_ELEMENT elem ON elem.TRIAL_ELEMENT_ID = tp.TRIAL_ELEMENT_ID
    LEFT JOIN CONTAINERS_CONDITION cond ON cond.CONTCODE = tube.CONTCODE""",
    "parent_container": f"""
SELECT led.INVENTORYID, led.CONTAINER_INVENTORYID, box.INVENTORYID AS PARENT_CONTAINER_INV_ID,
    box.INVENTORY_CODE AS BOX_CODE, box.EXTERNAL_CODE AS BOX_NAME, box.MATCODE AS MATCODE
FROM INVENTORY_TRANSACTIONS_VLA led
    {box_lateral("led", "led.INVENTORYID")}
WHERE led.FLAG_CURRENT = 1""",
    "parent_fanout": f"""
SELECT led.INVENTORYID, box.INVENTORYID AS PARENT_CONTAINER_INV_ID
FROM INVENTORY_TRANSACTIONS_VLA led
    {box_lateral("led", "led.INVENTORYID")}
    {BOX_LEDGER_LATERAL}
WHERE led.FLAG_CURRENT = 1""",
    "viability_summary": f"""
SELECT count(*) FILTER (WHERE NOT VIABLE) AS NOT_VIABLE, count(*) AS TOTAL,
    {_pct("count(*) FILTER (WHERE NOT VIABLE)", "count(*)")} AS PCT_NOT_VIABLE
FROM ({extract_sql(TRIAL_WHERE)}) e""",
    "extract_metrics": f"""
SELECT 'snapshot' AS DATASET, count(*) AS N_ROWS FROM ({extract_sql(TRIAL_WHERE)}) e
UNION ALL
SELECT 'history' AS DATASET, count(*) AS N_ROWS FROM ({history_sql(TRIAL_WHERE)}) h""",
    "extract_sampleid": f"""
SELECT ID, FIELD01 AS COMMENTS,
    {first_match_sql("FIELD01", "SAMPLEID:(.*?),")} AS SAMPLEID,
    {first_match_sql("FIELD01", r"LAB_ID:(\d+)")} AS SAMPLEID2
FROM METADATA""",
    "redact_text": """
SELECT doc_id, regexp_replace(text, '(?i)(token = ")[^"]*', '\\1****', 'g') AS text,
    regexp_replace(text, '(?i)(token = ")[^"]*', '\\1****', 'g') <> text AS changed
FROM documents""",
    "multi_trial_counts": f"""
SELECT LAST_NAME, count(*) AS N_ROWS, count(DISTINCT VIAL_CONTAINER_INV_ID) AS N_VIALS,
    count(*) FILTER (WHERE VIABLE) AS N_VIABLE, count(SAMPLEID) AS N_SAMPLEID
FROM ({extract_sql("")}) e GROUP BY LAST_NAME""",
    "multi_trial_roundtrip": f"""
SELECT s.LAST_NAME AS LAST_NAME, N_ROWS, N_NOT_VIABLE, N_SAMPLEID, N_HISTORY, N_CURRENT,
    N_ROWS AS TOLD_ROWS, N_NOT_VIABLE AS TOLD_NOT_VIABLE, N_HISTORY AS TOLD_HISTORY
FROM (SELECT LAST_NAME, count(*) AS N_ROWS, count(*) FILTER (WHERE NOT VIABLE) AS N_NOT_VIABLE, count(SAMPLEID) AS N_SAMPLEID
      FROM ({extract_sql("")}) e GROUP BY LAST_NAME) s
    JOIN (SELECT rcpt.LAST_NAME AS LAST_NAME, count(*) AS N_HISTORY, CAST(sum(led.FLAG_CURRENT) AS BIGINT) AS N_CURRENT
          FROM INVENTORY_TRANSACTIONS_VLA led JOIN INVENTORY_VLA vial ON vial.INVENTORYID = led.INVENTORYID
              JOIN CENTRALRECEIVING_VLA rcpt ON rcpt.EXTERNAL_ID = vial.EXTERNAL_ID GROUP BY rcpt.LAST_NAME) h ON h.LAST_NAME = s.LAST_NAME""",
    "collated_extract": collated(extract_sql(f"WHERE rcpt.LAST_NAME = '{TRIAL.lower()}'")),
    "collated_history": collated(history_sql(f"WHERE rcpt.LAST_NAME = '{TRIAL.lower()}'")),
    "slug_collisions": f"""
SELECT TRIAL_CODE, TRIAL_SLUG, count(*) OVER (PARTITION BY TRIAL_SLUG) AS N_SHARING
FROM (SELECT TRIAL_CODE, {slug_sql("TRIAL_CODE")} AS TRIAL_SLUG
      FROM (SELECT DISTINCT TRIAL_CODE FROM (
            SELECT LAST_NAME AS TRIAL_CODE FROM CENTRALRECEIVING_VLA
            UNION ALL SELECT TRIAL_CODE FROM TRIAL) u WHERE TRIAL_CODE IS NOT NULL) d) s""",
    "extract_labels": f"""
SELECT page_id, url, {first_match_sql("url", r"page=(\d+)")} AS PAGE,
    {first_match_sql("url", r"://(.*?)\.example")} AS HOST
FROM pages""",
    "viability_by_site": f"""
SELECT LAST_NAME, STUDY_SITE, count(*) FILTER (WHERE NOT VIABLE) AS NOT_VIABLE, count(*) AS TOTAL,
    {_pct("count(*) FILTER (WHERE NOT VIABLE)", "count(*)")} AS PCT_NOT_VIABLE,
    count(*) FILTER (WHERE MATCODE IN {MATS}) AS N_MATCODE_EXCLUDED,
    count(*) FILTER (WHERE MATCODE IS NULL) AS N_MATCODE_MISSING,
    count(*) FILTER (WHERE RECEIVED_CONDITION IN {CONDS}) AS N_RECEIVED_CONDITION_EXCLUDED,
    count(*) FILTER (WHERE SAMPLE_CONDITION IN {CONDS}) AS N_SAMPLE_CONDITION_EXCLUDED,
    count(*) FILTER (WHERE AMOUNTLEFT IS NULL OR isnan(AMOUNTLEFT)) AS N_AMOUNT_MISSING,
    count(*) FILTER (WHERE AMOUNTLEFT IS NOT NULL AND NOT isnan(AMOUNTLEFT) AND AMOUNTLEFT <= 0)
        AS N_AMOUNT_NOT_POSITIVE
FROM ({extract_sql("")}) e GROUP BY LAST_NAME, STUDY_SITE""",
}


def oracle_sql() -> dict[str, str]:
    """Full statements: the fixture CTEs followed by each query body."""
    ctes, respelled = oracle_ctes(TABLE_NAMES), oracle_ctes(TABLE_NAMES, respell=True)
    return {name: f"{respelled if name.startswith('collated_') else ctes}\n{body.strip()}" for name, body in BODIES.items()}
