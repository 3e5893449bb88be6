"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` through the derived LIMS
tables, over whole tables. Trial-level queries use the trial filter of the
original job (``CENTRALRECEIVING.LAST_NAME = trial``), which is the feature
under test; the operator-level queries run across all trials.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.predicates import DEFAULT_EXCLUDE_CONDITIONS, flag_viable, is_missing, is_positive, not_in
from .functions.scalar import grid_ordinal, safe_int
from .functions.text import extract_labels, extract_sampleid, redact_labelled
from .operators import dims
from .operators.joins import parent_container_join
from .operators.summary import row_count, viability_by, viability_summary
from .plans.history import inventory_history
from .plans.inventory import (
    RECEIPT_METADATA_ROLES, VIAL_METADATA_ROLES, current_ledger, metadata_role, receipts_with_schedule,
    parent_fanout, sample_containers, trial_extract, trial_inventory, trial_receipts, trial_vials,
)
from .plans.sql_text import MONTHLY_SQL, run_sql
from .session import scratch_path
from .sinks.parquet import HISTORY_SUFFIX, PARQUET_EXT, PROD_SUFFIX, extract_trial, extract_trials, read_trials, slug_report
from .functions.text import slug_sql
from .sqltext import quote
from .sources.fixtures import derive_lims_tables, respelled
from .sources.tables import TABLE_NAMES, LimsTables

TRIAL = "BUILDING"
#: Case-insensitive, blanks at the end ignored, like the source database.
COLLATION = "UTF8_LCASE_RTRIM"

# Patterns for the label-extraction and redaction queries on driver text.
PAGE_LABELS = {"PAGE": r"page=(\d+)", "HOST": r"://(.*?)\.example"}
TOKEN_LABEL = 'token = "'


def _tables(spark: SparkSession, sf_dir: str) -> LimsTables:
    return derive_lims_tables(spark, sf_dir)


def q_scan_specimen_tables(spark, sf_dir):
    t = _tables(spark, sf_dir)
    parts = [t[n].agg(F.count(F.lit(1)).alias("N_ROWS")).select(F.lit(n).alias("TABLE_NAME"), "N_ROWS") for n in TABLE_NAMES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_param_query(spark, sf_dir):
    return run_sql(spark, MONTHLY_SQL, _tables(spark, sf_dir), trial_code=TRIAL)


def q_sink_roundtrip(spark, sf_dir):
    """The whole single-trial job (materialised vial set, semi-join reduction,
    observed metrics, zstd Parquet), read back from what it wrote."""
    result = extract_trial(_tables(spark, sf_dir), TRIAL, scratch_path(spark, "extract"), parquet_compression="zstd")
    return spark.read.parquet(result.snapshot_path)


def q_trial_slug(spark, sf_dir):
    t = _tables(spark, sf_dir)
    codes = t["CENTRALRECEIVING_VLA"].select(F.col("LAST_NAME").alias("TRIAL_CODE")).distinct()
    s = slug_sql("TRIAL_CODE")
    prod = slug_sql(f"concat(TRIAL_CODE, {quote(PROD_SUFFIX)})")
    return codes.selectExpr(
        "TRIAL_CODE",
        f"{s} AS TRIAL_SLUG",
        f"concat({s}, {quote(PARQUET_EXT)}) AS FILE_NAME",
        f"concat({prod}, {quote(PARQUET_EXT)}) AS PROD_FILE_NAME",
        f"concat({s}, {quote(HISTORY_SUFFIX + PARQUET_EXT)}) AS HISTORY_FILE_NAME",
    )


def q_history_row_counts(spark, sf_dir):
    h = inventory_history(_tables(spark, sf_dir), TRIAL, sort=False)
    return h.groupBy("INVENTORYID").agg(
        F.count(F.lit(1)).alias("N_ROWS"), F.sum("FLAG_CURRENT").cast("bigint").alias("N_CURRENT")
    )


def q_trial_inventory(spark, sf_dir):
    return trial_inventory(_tables(spark, sf_dir), TRIAL)


def q_trial_extract(spark, sf_dir):
    return trial_extract(_tables(spark, sf_dir), TRIAL)


def q_inventory_history(spark, sf_dir):
    return inventory_history(_tables(spark, sf_dir), TRIAL)


def q_trial_filter(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return t["CENTRALRECEIVING_VLA"].where(F.col("LAST_NAME") == F.lit(TRIAL))


def q_storage_path(spark, sf_dir):
    t = _tables(spark, sf_dir)
    it = t["INVENTORY_TRANSACTIONS_VLA"].select("INVENTORYID", "TRANSACTION_ID", "LOCATIONCODE")
    from .operators.joins import left_lookup

    out = left_lookup(
        it, dims.location_path(t), "LOCATIONCODE", "RACK_CODE", salt_cols=("INVENTORYID", "TRANSACTION_ID"),
        lookup_chain=True,
    )
    return out.select(
        "INVENTORYID", "TRANSACTION_ID", "LOCATIONCODE", "RACK_CODE", "FREEZER", "SHELF", "RACK",
        "SHELF_SORT", "RACK_SORT", "LONGNAME", "ROOM_NAME", "BUILDING_NAME",
    )


def q_seq_num(spark, sf_dir):
    inv = _tables(spark, sf_dir)["INVENTORY_VLA"]
    return inv.select("INVENTORYID", F.col("EXTERNAL_CODE").alias("SEQ"), safe_int("EXTERNAL_CODE").alias("SEQ_NUM"))


def _ledger_with_box(t: LimsTables, with_counts: bool):
    it = t["INVENTORY_TRANSACTIONS_VLA"].select(
        "INVENTORYID", "TRANSACTION_ID", "FLAG_CURRENT", "CONTAINER_INVENTORYID", "CONTAINER_POS_Y", "CONTAINER_POS_X"
    )
    return parent_container_join(
        it, dims.boxes(t, with_current_rows=with_counts), self_col="INVENTORYID",
        salt_cols=("INVENTORYID", "TRANSACTION_ID"),
    )


def q_box_position(spark, sf_dir):
    rows = _ledger_with_box(_tables(spark, sf_dir), False)
    return rows.select(
        "INVENTORYID", "TRANSACTION_ID", "CONTAINER_INVENTORYID", "PARENT_CONTAINER_INV_ID", "MATCODE",
        grid_ordinal("CONTAINER_POS_Y", "CONTAINER_POS_X", "CONTAINER_AXIS_X_SIZE").alias("BOX_POS"),
    )


def q_metadata_roles(spark, sf_dir):
    t = _tables(spark, sf_dir)
    cr = trial_receipts(t, None).select("_CR_EXT", "LAST_NAME", "_CR_GUID")
    cr = cr.join(metadata_role(t, "_CR_META_ID", RECEIPT_METADATA_ROLES), F.col("_CR_GUID") == F.col("_CR_META_ID"))
    rows = trial_vials(t, cr)
    rows = rows.join(metadata_role(t, "_INV_META_ID", VIAL_METADATA_ROLES), F.col("_INV_GUID") == F.col("_INV_META_ID"))
    return rows.select(
        "VIAL_CONTAINER_INV_ID", "LAST_NAME", *RECEIPT_METADATA_ROLES.values(), *VIAL_METADATA_ROLES.values()
    )


def q_not_in_nullsafe(spark, sf_dir):
    sc = _tables(spark, sf_dir)["SAMPLECONTAINERS_VLA"]
    conds = list(DEFAULT_EXCLUDE_CONDITIONS)
    return sc.select(
        "INVENTORYID",
        F.col("RECEIVEDCONDITION").alias("RECEIVED_CONDITION"),
        not_in("RECEIVEDCONDITION", conds).alias("NOT_EXCLUDED"),
        not_in("RECEIVEDCONDITION", conds + [None]).alias("NOT_EXCLUDED_NOR_NULL"),
    )


def q_missing_amount(spark, sf_dir):
    it = _tables(spark, sf_dir)["INVENTORY_TRANSACTIONS_VLA"]
    dt = it.schema["AMOUNTLEFT"].dataType
    return it.select(
        "INVENTORYID", "TRANSACTION_ID", "AMOUNTLEFT",
        is_missing("AMOUNTLEFT", dt).alias("AMOUNT_MISSING"),
        is_positive("AMOUNTLEFT", dt).alias("AMOUNT_POSITIVE"),
    )


def q_flag_viable(spark, sf_dir):
    snap = flag_viable(trial_inventory(_tables(spark, sf_dir), None))
    return snap.select(
        "VIAL_CONTAINER_INV_ID", "PARENT_CONTAINER_INV_ID", "LAST_NAME", "MATCODE", "RECEIVED_CONDITION",
        "SAMPLE_CONDITION", "AMOUNTLEFT", "VIABLE",
    )


def q_inner_receipt(spark, sf_dir):
    t = _tables(spark, sf_dir)
    cr = trial_receipts(t, None).select("_CR_EXT", F.col("_CR_EXT").alias("EXTERNAL_ID"), "LAST_NAME", "SUBJECTID")
    return trial_vials(t, cr).select("VIAL_CONTAINER_INV_ID", "EXTERNAL_ID", "LAST_NAME", "SUBJECTID")


def q_current_transaction(spark, sf_dir):
    t = _tables(spark, sf_dir)
    inv = t["INVENTORY_VLA"].select(F.col("INVENTORYID").alias("VIAL_CONTAINER_INV_ID"))
    it = current_ledger(t)
    return inv.join(it, F.col("VIAL_CONTAINER_INV_ID") == F.col("_IT_ID")).select(
        "VIAL_CONTAINER_INV_ID", F.col("_IT_LOC").alias("LOCATIONCODE"), "CONTAINER_INVENTORYID", "AMOUNTLEFT", "THAWCOUNT"
    )


def q_left_lookups(spark, sf_dir):
    t = _tables(spark, sf_dir)
    rows = trial_vials(t, receipts_with_schedule(t, None))
    rows = rows.join(sample_containers(t), F.col("VIAL_CONTAINER_INV_ID") == F.col("_SC_ID"))
    from .operators.joins import left_lookup

    cc = t["CONTAINERS_CONDITION"].select(F.col("CONTCODE").alias("_CC_CODE"), "PRESERVATIVE")
    rows = left_lookup(rows, cc, "_SC_CONTCODE", "_CC_CODE", salt_cols=("VIAL_CONTAINER_INV_ID",))
    return rows.select(
        "VIAL_CONTAINER_INV_ID", "TMS_ID", "MS_VISIT", "TRIAL_CODE", "TP_CODE", "TP_VISIT", "TP_DESC", "TE_NAME",
        "PRESERVATIVE",
    )


def _current_with_box(t: LimsTables, with_counts: bool):
    it = current_ledger(t).select(F.col("_IT_ID").alias("INVENTORYID"), "CONTAINER_INVENTORYID")
    return parent_container_join(
        it, dims.boxes(t, with_current_rows=with_counts), self_col="INVENTORYID", salt_cols=("INVENTORYID",)
    )


def q_parent_container(spark, sf_dir):
    rows = _current_with_box(_tables(spark, sf_dir), False)
    return rows.select("INVENTORYID", "CONTAINER_INVENTORYID", "PARENT_CONTAINER_INV_ID", "BOX_CODE", "BOX_NAME", "MATCODE")


def q_parent_fanout(spark, sf_dir):
    return parent_fanout(_tables(spark, sf_dir))


def q_viability_summary(spark, sf_dir):
    return viability_summary(trial_extract(_tables(spark, sf_dir), TRIAL))


def q_extract_metrics(spark, sf_dir):
    t = _tables(spark, sf_dir)
    snap = row_count(trial_extract(t, TRIAL), "snapshot")
    hist = row_count(inventory_history(t, TRIAL, sort=False), "history")
    return snap.unionByName(hist)


def q_extract_sampleid(spark, sf_dir):
    meta = _tables(spark, sf_dir)["METADATA"].select("ID", F.col("FIELD01").alias("COMMENTS"))
    return extract_sampleid(meta)


def q_redact_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text")
    red = redact_labelled("text", TOKEN_LABEL, '"')
    return docs.select("doc_id", red.alias("text"), (red != F.col("text")).alias("changed"))


def q_multi_trial_counts(spark, sf_dir):
    snap = trial_extract(_tables(spark, sf_dir), None)
    return snap.groupBy("LAST_NAME").agg(
        F.count(F.lit(1)).alias("N_ROWS"),
        F.count_distinct("VIAL_CONTAINER_INV_ID").alias("N_VIALS"),
        F.count_if("VIABLE").alias("N_VIABLE"),
        F.count("SAMPLEID").alias("N_SAMPLEID"),
    )


def q_multi_trial_roundtrip(spark, sf_dir):
    """The whole job for all trials (snapshot and history, one folder a trial, published together), read back: one row a trial."""
    t = _tables(spark, sf_dir)
    codes = [r[0] for r in t["CENTRALRECEIVING_VLA"].select("LAST_NAME").distinct().collect()]
    done = extract_trials(t, codes, scratch_path(spark, "trials"), download_history=True)
    snap = read_trials(spark, done["snapshot"]).groupBy("LAST_NAME").agg(
        F.count(F.lit(1)).alias("N_ROWS"), F.count_if(~F.col("VIABLE")).alias("N_NOT_VIABLE"), F.count("SAMPLEID").alias("N_SAMPLEID"))
    hist = read_trials(spark, done["history"]).groupBy("LAST_NAME").agg(
        F.count(F.lit(1)).alias("N_HISTORY"), F.sum("FLAG_CURRENT").cast("bigint").alias("N_CURRENT"))
    told = [(c, r["rows"], r["not_viable"], r["history_rows"]) for c, r in done["trials"].items()]
    told = spark.createDataFrame(told, "LAST_NAME string, TOLD_ROWS long, TOLD_NOT_VIABLE long, TOLD_HISTORY long")
    return snap.join(hist, "LAST_NAME").join(told, "LAST_NAME")


def q_collated_extract(spark, sf_dir):
    """The extraction under the source's collation: trial codes and string keys spelled in other letters, with blanks."""
    return trial_extract(respelled(_tables(spark, sf_dir)), f"{TRIAL.lower()} ", collation=COLLATION)


def q_collated_history(spark, sf_dir):
    return inventory_history(respelled(_tables(spark, sf_dir)), f"{TRIAL.lower()} ", collation=COLLATION, sort=False)


def q_slug_collisions(spark, sf_dir):
    t = _tables(spark, sf_dir)
    codes = (
        t["CENTRALRECEIVING_VLA"].select(F.col("LAST_NAME").alias("TRIAL_CODE"))
        .unionByName(t["TRIAL"].select("TRIAL_CODE"))
    )
    return slug_report(codes)


def q_extract_labels(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet").select("page_id", "url")
    return extract_labels(pages, "url", PAGE_LABELS)


def q_viability_by_site(spark, sf_dir):
    snap = trial_extract(_tables(spark, sf_dir), None)
    return viability_by(snap, ["LAST_NAME", "STUDY_SITE"])


def q_history_stream(spark, sf_dir):
    """History maintained by a stream over the ledger files (stream-static joins)."""
    from .streaming.history import run_history_stream

    return run_history_stream(_tables(spark, sf_dir), f"{sf_dir.rstrip('/')}/lineitem*.parquet", TRIAL)


def q_history_kept(spark, sf_dir):
    """History kept by a stream when half of the vials become known only after their ledger rows."""
    from .streaming.kept import KeptLedger, versioned_fixture_stream

    t = _tables(spark, sf_dir)
    early = LimsTables({**t.frames, "INVENTORY_VLA": t["INVENTORY_VLA"].where("INVENTORYID % 2 = 0")})
    now = [early]
    kept = KeptLedger(lambda: now[0], TRIAL, scratch_path(spark, "kept"), key=("INVENTORYID", "TRANSACTION_ID", "THAWCOUNT"))
    kept.follow(versioned_fixture_stream(spark, f"{sf_dir.rstrip('/')}/lineitem*.parquet"), scratch_path(spark, "kept_ckpt"))
    now[0] = t
    kept.settle()
    return kept.history(sort=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
