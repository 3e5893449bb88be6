"""Parquet sinks: per-trial datasets, multi-trial partitioned datasets.

Output naming (fixed rule of the original job): the file stem is the slug
of the trial code, or of ``<code>_PROD`` with the DSN flag; the history
sits beside it as ``<stem>_history``; with ``add_trial_to_path`` both go
into a sub-folder named by the raw trial code. Spark writes a directory
per dataset at that path.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import DEFAULT_EXCLUDE_CONDITIONS, DEFAULT_EXCLUDE_MATCODES
from ..functions.text import DIGIT_COMMA, LATIN_FROM, LATIN_PAIRS, LATIN_TO, slug
from ..operators.summary import observe_rows, observe_viability
from ..plans.history import by_trial, inventory_history, locations_last
from ..plans.inventory import materialize_trial_vials, trial_extract
from ..functions.text import collation_key_sql
from ..session import delete_path
from ..sources.tables import LimsTables
from .publish import Publication, Store, check_owner, recover, write_owner

log = logging.getLogger(__name__)

DEFAULT_COMPRESSION = "zstd"
# Parquet codecs Spark writes without extra libraries (brotli needs a codec jar that is not bundled).
SUPPORTED_CODECS = frozenset({"zstd", "snappy", "gzip", "lz4", "lz4_raw", "none", "uncompressed"})


def check_codec(codec: str) -> str:
    c = (codec or "none").lower()
    if c not in SUPPORTED_CODECS:
        raise ValueError(f"parquet compression {codec!r} is not available; use one of {sorted(SUPPORTED_CODECS)}")
    return c
# The suffixes of the original job's file names.
PROD_SUFFIX = "_PROD"
HISTORY_SUFFIX = "_history"
PARQUET_EXT = ".parquet"


_LATIN = str.maketrans(LATIN_FROM, LATIN_TO)


def slug_text(text: str, separator: str = "_") -> str:
    """Driver-side twin of :func:`vialflow.functions.text.slug` for one path."""
    text = text.translate(_LATIN)
    for src, dst in LATIN_PAIRS.items():
        text = text.replace(src, dst)
    text = re.sub(DIGIT_COMMA, "", text)
    return re.sub(r"[^A-Za-z0-9]+", separator, text).strip(separator)


def parquet_path(trial_code: str, output_dir: str, include_dsn_in_filename: bool, add_trial_to_path: bool) -> str:
    stem = f"{trial_code}{PROD_SUFFIX}" if include_dsn_in_filename else trial_code
    base = output_dir.rstrip("/")
    if add_trial_to_path:
        base = f"{base}/{trial_code}"
    name = slug_text(stem)
    if not name:  # a name that begins with a dot is hidden from every reader
        raise ValueError(f"trial code {trial_code!r} has no letter or digit to name a file by")
    return f"{base}/{name}{PARQUET_EXT}"


def history_path(snapshot_path: str) -> str:
    head, _, name = snapshot_path.rpartition("/")
    stem = name[: -len(PARQUET_EXT)] if name.endswith(PARQUET_EXT) else name
    return f"{head}/{stem}{HISTORY_SUFFIX}{PARQUET_EXT}"


def write_parquet(
    df: DataFrame,
    path: str,
    compression: str = DEFAULT_COMPRESSION,
    *,
    partition_by: Sequence[str] = (),
    max_records_per_file: int = 5_000_000,
) -> None:
    """Overwrite ``path`` with ``df``; with ``partition_by`` only the written
    partitions are replaced (dynamic partition overwrite)."""
    writer = (
        df.write.mode("overwrite")
        .option("compression", check_codec(compression))
        .option("maxRecordsPerFile", max_records_per_file)
    )
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


@dataclass
class ExtractResult:
    snapshot_path: str
    snapshot_rows: int
    not_viable: int | None = None
    percent_not_viable: float | None = None
    history_path: str | None = None
    history_rows: int | None = None
    extra: dict = field(default_factory=dict)


def extract_trial(
    t: LimsTables,
    trial_code: str,
    output_dir: str,
    *,
    add_trial_to_path: bool = False,
    include_dsn_in_filename: bool = False,
    no_viable: bool = False,
    exclude_conditions: Iterable = DEFAULT_EXCLUDE_CONDITIONS,
    exclude_matcodes: Iterable = DEFAULT_EXCLUDE_MATCODES,
    parquet_compression: str = DEFAULT_COMPRESSION,
    download_history: bool = False,
    collation: str | None = None,
    seq_empty_as_zero: bool = False,
    semi_join_reduction: bool = True,
) -> ExtractResult:
    """The whole job for one trial: snapshot (+ optional history) to Parquet.

    With ``semi_join_reduction`` the trial's vials are first written to the
    shared scratch folder (``spark.checkpoint.dir``) with an exact count; a
    small enough set is broadcast into the large vial-keyed joins, and both
    datasets start from it instead of re-joining receipts. Counts are
    gathered by observation during each write, so no dataset is computed
    twice. Errors propagate. Snapshot and history are staged and published
    together when both are complete, so a failed run leaves the earlier pair as
    it was (see :mod:`.publish`). A dataset that another trial with the same file
    name has published is not replaced.
    """
    if not trial_code or not trial_code.strip():
        raise ValueError("trial code must be a non-blank string")
    check_codec(parquet_compression)  # fail before any work is done
    vials = materialize_trial_vials(t, trial_code, collation) if semi_join_reduction else None
    try:
        return _extract_trial(
            t, trial_code, output_dir, vials, add_trial_to_path=add_trial_to_path,
            include_dsn_in_filename=include_dsn_in_filename, no_viable=no_viable,
            exclude_conditions=exclude_conditions, exclude_matcodes=exclude_matcodes,
            parquet_compression=parquet_compression, download_history=download_history, collation=collation,
            seq_empty_as_zero=seq_empty_as_zero,
        )
    finally:
        if vials is not None:
            for path in vials.paths:
                delete_path(t.spark, path)


def _extract_trial(
    t, trial_code, output_dir, vials, *, add_trial_to_path, include_dsn_in_filename, no_viable,
    exclude_conditions, exclude_matcodes, parquet_compression, download_history, collation, seq_empty_as_zero,
) -> ExtractResult:
    snapshot = trial_extract(
        t, trial_code, no_viable=no_viable, exclude_conditions=exclude_conditions,
        exclude_matcodes=exclude_matcodes, collation=collation, seq_empty_as_zero=seq_empty_as_zero, vials=vials,
    )
    path = parquet_path(trial_code, output_dir, include_dsn_in_filename, add_trial_to_path)
    folder, store = path.rpartition("/")[0], Store(t.spark)
    recover(t.spark, folder)
    check_owner(store, path, trial_code)
    run = Publication(t.spark, folder)
    try:
        result = _staged(t, trial_code, run, snapshot, path, vials, no_viable, parquet_compression, download_history, collation)
        for staged, _ in run.moves:
            write_owner(store, staged, trial_code)
    except BaseException:
        run.abandon()
        raise
    run.commit()
    return result


def _staged(t, trial_code, run, snapshot, path, vials, no_viable, parquet_compression, download_history, collation) -> ExtractResult:
    if no_viable:
        observed, obs = observe_rows(snapshot, "snapshot")
    else:
        observed, obs = observe_viability(snapshot, "snapshot")
    write_parquet(observed, run.stage(path), parquet_compression)
    metrics = obs.get
    result = ExtractResult(snapshot_path=path, snapshot_rows=int(metrics.get("rows", 0)))
    if not no_viable:
        bad = int(metrics.get("not_viable", 0))
        result.not_viable = bad
        rows = result.snapshot_rows
        result.percent_not_viable = round(bad / rows * 100, 2) if rows > 0 else 0.0
        log.info("trial %s: %d rows not viable, %s%%", trial_code, bad, result.percent_not_viable)
    log.info("trial %s: wrote %d snapshot rows, path=%s codec=%s", trial_code, result.snapshot_rows, path, parquet_compression)
    if download_history:
        hist, hobs = observe_rows(inventory_history(t, trial_code, collation=collation, vials=vials), "history")
        hpath = history_path(path)
        write_parquet(hist, run.stage(hpath), parquet_compression)
        result.history_path = hpath
        result.history_rows = int(hobs.get.get("rows", 0))
        log.info("trial %s: wrote %d history rows, path=%s", trial_code, result.history_rows, hpath)
    return result


#: Folder key of a multi-trial dataset; the code itself stays in the files, as a string.
TRIAL_KEY = "TRIAL_PARTITION"


def _trial_folder(spark, path: str, code: str) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{path}/{TRIAL_KEY}={escape(code)}"


def _trial_folders(spark, path: str) -> list[str]:
    """The trial codes that have a folder below ``path``."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(root) if f.isDirectory()]
    return [utils.unescapePathName(n.partition("=")[2]) for n in names if n.startswith(f"{TRIAL_KEY}=")]


def read_trials(spark, path: str) -> DataFrame:
    """A multi-trial dataset as written: codes are strings whatever they look like."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def _write_trials(df: DataFrame, path: str, run: Publication, codes: list[str] | None, collation: str | None, compression: str, viable: bool) -> dict[str, dict]:
    """Stage ``df`` by trial; once published, ``path`` holds this run's rows for every trial asked for.

    Counts are read from the files staged (two narrow columns, one row for each
    trial), so the plan is the same for one code and for ten thousand. Folders
    of the asked trials that got no row in this run are dropped, and a code
    without rows gets an empty dataset with the full schema. For all trials
    (``codes`` None) every folder not written is old.
    """
    spark = df.sparkSession
    staged = f"{run.staging}/{path.rpartition('/')[2]}"
    write_parquet(df.withColumn(TRIAL_KEY, F.col("LAST_NAME")), staged, compression, partition_by=(TRIAL_KEY,))
    written = _trial_folders(spark, staged)
    counts: dict[str, dict] = {}
    if written:
        aggs = [F.count(F.lit(1)).alias("rows"), *([F.count_if(~F.col("VIABLE")).alias("not_viable")] if viable else [])]
        counts = {r["LAST_NAME"]: r.asDict() for r in read_trials(spark, staged).groupBy("LAST_NAME").agg(*aggs).collect()}
    old = [c for c in _trial_folders(spark, path) if c not in set(written)]
    found = counts
    if codes is not None:
        asked, stored = _spellings(spark, codes, collation), _spellings(spark, sorted({*counts, *old}), collation)
        old = [c for c in old if stored[c] in set(asked.values())]
        by_key: dict[str, list[str]] = {}
        for raw in counts:
            by_key.setdefault(stored[raw], []).append(raw)
        zero = {"rows": 0, **({"not_viable": 0} if viable else {})}
        found = {c: {"LAST_NAME": c, **{k: sum(counts[raw][k] for raw in by_key.get(asked[c], [])) for k in zero}} for c in codes}
        empty = [c for c in codes if not found[c]["rows"]]
        if empty:  # one small write for all of them
            none = spark.createDataFrame([], df.schema).coalesce(1)
            for code in empty:
                none.write.mode("overwrite").option("compression", check_codec(compression)).parquet(_trial_folder(spark, staged, code))
            written = [*written, *empty]
    for code in old:
        run.drop(_trial_folder(spark, path, code))
    run.moves += [[_trial_folder(spark, staged, c), _trial_folder(spark, path, c)] for c in written]
    return found


def _spellings(spark, codes: list[str], collation: str | None) -> dict[str, str]:
    """Each code with the key that codes equal under ``collation`` share."""
    if not collation:
        return {c: c for c in codes}
    frame = spark.createDataFrame([(c,) for c in codes], "c string")
    keyed = frame.selectExpr("c", f"min(c) OVER (PARTITION BY {collation_key_sql('c', collation)}) AS first")
    first = {r.c: r["first"] for r in keyed.collect()}
    plain = {r.c: r.k for r in frame.selectExpr("c", f"CAST({collation_key_sql('c', collation)} AS STRING) AS k").collect()}
    return {c: plain[first[c]] for c in codes}


def extract_trials(
    t: LimsTables,
    trial_codes: Sequence[str] | None,
    output_dir: str,
    *,
    no_viable: bool = False,
    exclude_conditions: Iterable = DEFAULT_EXCLUDE_CONDITIONS,
    exclude_matcodes: Iterable = DEFAULT_EXCLUDE_MATCODES,
    parquet_compression: str = DEFAULT_COMPRESSION,
    download_history: bool = False,
    collation: str | None = None,
    seq_empty_as_zero: bool = False,
    semi_join_reduction: bool = True,
) -> dict:
    """Many trials in one job per dataset, one folder per trial.

    A re-run replaces the folders of the trials asked for and no others; a
    trial without rows ends up as an empty dataset with the full schema. Read
    the result with :func:`read_trials`, or with any Parquet reader by the
    ``LAST_NAME`` column, which is in the files. Returns the paths and, by
    code, the rows, the rows not viable and the history rows. History is
    range-sorted on its order keys within each trial's files.
    """
    codes = None if trial_codes is None else list(dict.fromkeys(trial_codes))
    check_codec(parquet_compression)
    vials = materialize_trial_vials(t, codes, collation) if semi_join_reduction and codes is not None else None
    out = output_dir.rstrip("/")
    recover(t.spark, out)
    run = Publication(t.spark, out)
    try:
        snapshot = trial_extract(
            t, codes, no_viable=no_viable, exclude_conditions=exclude_conditions,
            exclude_matcodes=exclude_matcodes, collation=collation, seq_empty_as_zero=seq_empty_as_zero, vials=vials,
            spread_by="LAST_NAME",
        )
        paths: dict = {"snapshot": f"{out}/inventory"}
        paths["trials"] = _write_trials(snapshot, paths["snapshot"], run, codes, collation, parquet_compression, not no_viable)
        if download_history:
            late = locations_last(t, vials, collation)
            hist = inventory_history(t, codes, collation=collation, sort=False, with_trial=True, vials=vials, locations=not late)
            hist = by_trial(t, hist, collation)
            paths["history"] = f"{out}/history"
            counted = _write_trials(hist, paths["history"], run, codes, collation, parquet_compression, False)
            for code, row in counted.items():
                paths["trials"].setdefault(code, {"LAST_NAME": code, "rows": 0})["history_rows"] = row["rows"]
    except BaseException:
        run.abandon()
        raise
    else:
        run.commit()
        for code, row in sorted(paths["trials"].items()):
            log.info("trial %s: %s", code, ", ".join(f"{k}={v}" for k, v in row.items() if k != "LAST_NAME"))
        return paths
    finally:
        if vials is not None:
            for path in vials.paths:
                delete_path(t.spark, path)


def slug_report(codes: DataFrame, code_col: str = "TRIAL_CODE") -> DataFrame:
    """Each distinct code with its slug and how many distinct codes share it.

    ``N_SHARING > 1`` marks a collision: those trials would be written to
    the same file name and overwrite each other.
    """
    distinct = codes.select(F.col(code_col).alias("TRIAL_CODE")).where(F.col("TRIAL_CODE").isNotNull()).distinct()
    slugged = distinct.withColumn("TRIAL_SLUG", slug("TRIAL_CODE"))
    sharing = slugged.groupBy(F.col("TRIAL_SLUG").alias("_SLUG")).agg(F.count(F.lit(1)).alias("N_SHARING"))
    return slugged.join(sharing, F.col("TRIAL_SLUG") == F.col("_SLUG")).drop("_SLUG")
