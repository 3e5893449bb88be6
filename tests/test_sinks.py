"""Parquet sinks: the whole job for one trial, and many trials partitioned."""

from __future__ import annotations

import os
import tempfile

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from vialflow.plans.inventory import EXTRACT_COLUMNS
from vialflow.sinks.parquet import extract_trial, extract_trials, slug_report


def _fresh_dir() -> str:
    return tempfile.mkdtemp(prefix="vialflow-sink-")


def test_extract_trial_writes_snapshot_and_history(spark, tables):
    out = _fresh_dir()
    res = extract_trial(tables, "BUILDING", out, download_history=True, add_trial_to_path=True,
                        include_dsn_in_filename=True)
    assert res.snapshot_path == f"{out}/BUILDING/BUILDING_PROD.parquet"
    assert res.history_path == f"{out}/BUILDING/BUILDING_PROD_history.parquet"
    assert (res.snapshot_rows, res.not_viable, res.history_rows) == (216, 130, 1336)
    assert res.percent_not_viable == round(130 / 216 * 100, 2)
    snap = spark.read.parquet(res.snapshot_path)
    assert tuple(snap.columns) == EXTRACT_COLUMNS and snap.count() == 216
    files = sorted(f for f in os.listdir(res.snapshot_path) if f.endswith(".parquet"))
    assert files and all(pq.ParquetFile(os.path.join(res.snapshot_path, f)).metadata.row_group(0).column(0)
                         .compression == "ZSTD" for f in files)
    # history files are globally ordered by (INVENTORYID, TRANSACTION_ID) in part-file order
    keys = []
    for f in sorted(f for f in os.listdir(res.history_path) if f.endswith(".parquet")):
        t = pq.read_table(os.path.join(res.history_path, f), columns=["INVENTORYID", "TRANSACTION_ID"])
        keys += list(zip(t.column(0).to_pylist(), t.column(1).to_pylist()))
    assert len(keys) == 1336 and keys == sorted(keys)


def test_rewrite_replaces_earlier_file(spark, tables):
    out = _fresh_dir()
    extract_trial(tables, "BUILDING", out, parquet_compression="snappy")
    res = extract_trial(tables, "BUILDING", out, no_viable=True)
    df = spark.read.parquet(res.snapshot_path)
    assert "VIABLE" not in df.columns and df.count() == 216


def test_unknown_trial_writes_empty_full_schema(spark, tables):
    res = extract_trial(tables, "NOPE", _fresh_dir())
    df = spark.read.parquet(res.snapshot_path)
    assert df.count() == 0 and tuple(df.columns) == EXTRACT_COLUMNS
    assert res.percent_not_viable == 0.0


def test_multi_trial_dynamic_overwrite(spark, tables):
    out = _fresh_dir()
    paths = extract_trials(tables, ["BUILDING", "MACHINERY"], out, download_history=True)
    assert paths["trials"]["BUILDING"]["rows"] == 216 and paths["trials"]["BUILDING"]["not_viable"] == 130
    first = spark.read.parquet(paths["snapshot"]).groupBy("LAST_NAME").count().collect()
    assert {r.LAST_NAME: r["count"] for r in first}["BUILDING"] == 216
    # re-running one trial replaces only that trial's partition
    extract_trials(tables, ["BUILDING"], out)
    again = {r.LAST_NAME: r["count"] for r in spark.read.parquet(paths["snapshot"]).groupBy("LAST_NAME").count().collect()}
    assert set(again) == {"BUILDING", "MACHINERY"} and again["BUILDING"] == 216
    hist = spark.read.parquet(paths["history"])
    assert hist.where(F.col("LAST_NAME") == "BUILDING").count() == 1336


def test_slug_collision_report(spark):
    codes = spark.createDataFrame([("A-B",), ("A_B",), ("C",), ("C",), (None,)], "TRIAL_CODE string")
    got = {(r.TRIAL_CODE, r.TRIAL_SLUG, r.N_SHARING) for r in slug_report(codes).collect()}
    assert got == {("A-B", "A_B", 2), ("A_B", "A_B", 2), ("C", "C", 1)}


def test_parquet_table_source(spark, tables):
    """Production input path: one Parquet dataset per LIMS table, column-pruned reads."""
    from vialflow.plans.inventory import trial_extract as extract
    from vialflow.sources.tables import TABLE_NAMES, read_parquet_tables

    base = _fresh_dir()
    for name in TABLE_NAMES:
        tables[name].write.mode("overwrite").parquet(f"{base}/{name}")
    t = read_parquet_tables(spark, base)
    assert extract(t, "BUILDING").count() == 216
    plan = extract(t, "BUILDING")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(LAST_NAME,BUILDING)" in plan


def test_command_line_job(spark):
    from vialflow.job import main

    before = set(spark.conf.getAll)
    out = _fresh_dir()
    summary = main(["--fixture-dir", "/root/testdata/sf0.001", "--trial-code", "BUILDING", "--output-dir", out,
                    "--download-history", "--exclude-matcodes", "100x100Box", "None"], spark=spark)
    assert summary["snapshot_rows"] == 216 and summary["history_rows"] == 1336 and summary["not_viable"] == 130
    assert spark.read.parquet(summary["snapshot_path"]).count() == 216
    multi = main(["--fixture-dir", "/root/testdata/sf0.001", "--trial-code", "BUILDING", "--trial-code", "MACHINERY",
                  "--output-dir", out + "/multi"], spark=spark)
    assert spark.read.parquet(multi["snapshot"]).select("LAST_NAME").distinct().count() == 2
    assert set(spark.conf.getAll) == before  # a local run leaves the session's settings alone


def test_unsupported_codec_fails_early(tables):
    import pytest

    with pytest.raises(ValueError, match="brotli"):
        extract_trial(tables, "BUILDING", _fresh_dir(), parquet_compression="brotli")


def test_multi_trial_rerun_unknown_and_collation(spark, tables):
    import pytest

    from vialflow.job import main
    from vialflow.sinks.parquet import read_trials
    from vialflow.sources.tables import LimsTables

    out = _fresh_dir()
    first = extract_trials(tables, ["BUILDING", "MACHINERY", "NOPE"], out, download_history=True)
    assert first["trials"]["BUILDING"]["rows"] == 216 and first["trials"]["BUILDING"]["not_viable"] == 130
    assert first["trials"]["BUILDING"]["history_rows"] == 1336
    assert first["trials"]["NOPE"] == {"LAST_NAME": "NOPE", "rows": 0, "not_viable": 0, "history_rows": 0}
    none = extract_trials(tables, ["NOPE"], _fresh_dir())
    empty = read_trials(spark, none["snapshot"])
    assert empty.count() == 0 and "VIABLE" in empty.columns
    # a trial that has lost its receipts loses its rows; another trial's stay
    frames = dict(tables.frames)
    frames["CENTRALRECEIVING_VLA"] = frames["CENTRALRECEIVING_VLA"].where("LAST_NAME <> 'BUILDING'")
    again = extract_trials(LimsTables(frames), ["BUILDING"], out)
    assert again["trials"]["BUILDING"]["rows"] == 0
    left = {r.LAST_NAME: r["count"] for r in read_trials(spark, first["snapshot"]).groupBy("LAST_NAME").count().collect()}
    assert set(left) == {"MACHINERY"}
    # codes keep their type
    frames = dict(tables.frames)
    frames["CENTRALRECEIVING_VLA"] = frames["CENTRALRECEIVING_VLA"].replace({"BUILDING": "007", "MACHINERY": "7"}, subset="LAST_NAME")
    typed = extract_trials(LimsTables(frames), ["007", "7"], _fresh_dir())
    assert typed["trials"]["007"]["rows"] == 216 and typed["trials"]["7"]["rows"] > 0
    assert {r.LAST_NAME for r in read_trials(spark, typed["snapshot"]).select("LAST_NAME").distinct().collect()} == {"007", "7"}
    loose = extract_trials(tables, ["building ", "NOPE"], _fresh_dir(), collation="UTF8_LCASE_RTRIM")
    assert loose["trials"]["building "]["rows"] == 216
    with pytest.raises(SystemExit):
        main(["--fixture-dir", "x", "--trial-code", "A", "--trial-code", "B", "--output-dir", out, "--add-trial-to-path"], spark=spark)


def test_stop_characters_of_a_regex_class(spark):
    from vialflow.functions.text import redact_labelled

    df = spark.createDataFrame([("PWD=a[b",), ("PWD=a&&b",)], "t string")
    assert [r[0] for r in df.select(redact_labelled("t", "PWD=", "[&")).collect()] == ["PWD=****[b", "PWD=****&&b"]


def _contents(spark, path):
    return sorted(map(str, spark.read.parquet(path).collect()))


def _old_receipts(tables):
    from vialflow.sources.tables import LimsTables

    return LimsTables({**tables.frames, "CENTRALRECEIVING_VLA": tables["CENTRALRECEIVING_VLA"].where("ORIGREC % 2 = 0")})


def test_failed_history_leaves_the_old_pair(spark, tables, monkeypatch):
    """A re-run that dies in the history write changes nothing: neither snapshot nor history."""
    import pytest

    import vialflow.sinks.parquet as sink

    out = _fresh_dir()
    first = extract_trial(_old_receipts(tables), "BUILDING", out, download_history=True)
    old = _contents(spark, first.snapshot_path), _contents(spark, first.history_path)
    many = extract_trials(_old_receipts(tables), ["BUILDING", "MACHINERY"], out + "/many", download_history=True)
    old_many = _contents(spark, many["snapshot"]), _contents(spark, many["history"])
    boom = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("no history"))
    monkeypatch.setattr(sink, "inventory_history", boom)
    with pytest.raises(RuntimeError, match="no history"):
        extract_trial(tables, "BUILDING", out, download_history=True)
    with pytest.raises(RuntimeError, match="no history"):
        extract_trials(tables, ["BUILDING", "MACHINERY"], out + "/many", download_history=True)
    assert (_contents(spark, first.snapshot_path), _contents(spark, first.history_path)) == old
    assert (_contents(spark, many["snapshot"]), _contents(spark, many["history"])) == old_many
    assert not [n for n in os.listdir(out) + os.listdir(out + "/many") if n.startswith(("_staging-", "_commit-"))]
    monkeypatch.undo()
    again = extract_trial(tables, "BUILDING", out, download_history=True)
    assert (again.snapshot_rows, again.history_rows) == (216, 1336) and _contents(spark, again.snapshot_path) != old[0]


def test_interrupted_publication_is_finished_by_the_next_run(spark, tables, monkeypatch):
    """Killed between the two renames: the commit record rolls the pair forward."""
    import pytest

    from vialflow.sinks import publish

    out = _fresh_dir()
    first = extract_trial(_old_receipts(tables), "BUILDING", out, download_history=True)
    real, calls = publish.Store.move, []

    def dies(self, source, target):
        if publish.STAGING in source and publish.STAGING not in target:
            calls.append(target)
            if len(calls) == 2:
                raise KeyboardInterrupt
        real(self, source, target)

    monkeypatch.setattr(publish.Store, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        extract_trial(tables, "BUILDING", out, download_history=True)
    monkeypatch.undo()
    assert len(calls) == 2 and publish.recover(spark, out) == 1 and publish.recover(spark, out) == 0
    assert spark.read.parquet(first.snapshot_path).count() == 216 and spark.read.parquet(first.history_path).count() == 1336
    assert not [n for n in os.listdir(out) if n.startswith(("_staging-", "_commit-"))]


def test_trial_with_the_same_file_name_is_not_replaced(spark, tables):
    import pytest

    from vialflow.sources.tables import LimsTables

    frames = dict(tables.frames)
    frames["CENTRALRECEIVING_VLA"] = frames["CENTRALRECEIVING_VLA"].replace({"BUILDING": "A-1", "MACHINERY": "A_1"}, subset="LAST_NAME")
    t, out = LimsTables(frames), _fresh_dir()
    first = extract_trial(t, "A-1", out)
    with pytest.raises(FileExistsError, match="A-1"):
        extract_trial(t, "A_1", out)
    assert extract_trial(t, "A-1", out).snapshot_rows == first.snapshot_rows == 216
    with pytest.raises(ValueError, match="no letter or digit"):
        extract_trial(t, "***", out)


def test_counts_of_many_trials_do_not_grow_the_plan(spark, tables):
    """Ten codes or a thousand: the written plan has no aggregate for a code."""
    from pyspark.sql import functions as F

    from vialflow.sinks import parquet as sink

    seen = []
    real = sink.write_parquet

    def spy(df, *a, **k):
        seen.append(len(df._jdf.queryExecution().analyzed().toString().replace(" ", "")))
        real(df, *a, **k)

    sink.write_parquet = spy
    try:
        snap = spark.createDataFrame([("T1", True), ("T1", False), ("T2", True)], "LAST_NAME string, VIABLE boolean")
        for n in (10, 200):
            run = sink.Publication(spark, _fresh_dir())
            codes = [f"T{i}" for i in range(n)]
            found = sink._write_trials(snap, run.folder + "/inventory", run, codes if n == 10 else codes[:3], None, "zstd", True)
            assert found["T1"] == {"LAST_NAME": "T1", "rows": 2, "not_viable": 1} and found["T0"]["rows"] == 0
            run.commit()
    finally:
        sink.write_parquet = real
    assert abs(seen[0] - seen[1]) < 50


def test_collated_keys_match(spark, tables):
    """Mixed-case and padded GUIDs, MATCODEs, LOCATIONCODEs and trial codes match, reduced or not, in all three plans."""
    from vialflow.operators.reducers import CONF_MIN_BYTES
    from vialflow.plans.history import inventory_history
    from vialflow.plans.inventory import trial_extract
    from vialflow.sources.fixtures import respelled
    from vialflow.sources.tables import LimsTables

    t = respelled(tables)
    loose = "UTF8_LCASE_RTRIM"
    same = [c for c in EXTRACT_COLUMNS if c not in ("LAST_NAME", "MATCODE", "RACK_CODE", "LONGCODE", "VIABLE")]
    plain = sorted(map(str, trial_extract(tables, "BUILDING").select(*same).collect()))
    assert trial_extract(t, "BUILDING").count() < len(plain)
    assert sorted(map(str, trial_extract(t, "building", collation=loose).select(*same).collect())) == plain
    spark.conf.set(CONF_MIN_BYTES, "0")
    try:
        big = LimsTables(dict(t.frames))
        reduced = trial_extract(big, "Building  ", collation=loose)
        assert sorted(map(str, reduced.select(*same).collect())) == plain
        # the spellings found are listed, so the filter reaches the scan; ICU collations work unreduced
        assert "In(" in reduced._jdf.queryExecution().executedPlan().toString() or "IN (" in reduced._jdf.queryExecution().optimizedPlan().toString()
        assert inventory_history(big, "building", collation=loose).count() == 1336
    finally:
        spark.conf.unset(CONF_MIN_BYTES)
    res = extract_trial(t, "building", _fresh_dir(), collation=loose, download_history=True)
    assert (res.snapshot_rows, res.history_rows) == (216, 1336)
    assert trial_extract(t, "building", collation="UNICODE_CI_RTRIM").count() == 216


def _repeated_keys(tables):
    """Some receipts and vials twice (also in another trial), some keys null."""
    from vialflow.sources.tables import LimsTables

    frames = dict(tables.frames)
    cr, inv, led = (frames[n] for n in ("CENTRALRECEIVING_VLA", "INVENTORY_VLA", "INVENTORY_TRANSACTIONS_VLA"))
    cr = cr.unionByName(cr.where("EXTERNAL_ID % 5 = 0").withColumn("LAST_NAME", F.lit("OTHER"))).unionByName(cr.where("EXTERNAL_ID % 7 = 0"))
    frames["CENTRALRECEIVING_VLA"] = cr.withColumn("EXTERNAL_ID", F.expr("IF(EXTERNAL_ID % 11 = 0, NULL, EXTERNAL_ID)"))
    inv = inv.unionByName(inv.where("INVENTORYID % 3 = 0").withColumn("EXTERNAL_CODE", F.lit("again")))
    frames["INVENTORY_VLA"] = inv.withColumn("METADATA_GUID", F.expr("IF(INVENTORYID % 13 = 0, NULL, METADATA_GUID)"))
    frames["INVENTORY_TRANSACTIONS_VLA"] = led.unionByName(led.where("INVENTORYID % 4 = 0")).withColumn(
        "INVENTORYID", F.expr("IF(INVENTORYID % 17 = 0, NULL, INVENTORYID)"))
    return LimsTables(frames)


def test_large_trials_carry_few_columns(spark, tables):
    """Vials too many to broadcast are joined to the ledger once; receipts come last, locations after the last shuffle: the same rows."""
    from vialflow.plans.history import by_trial, inventory_history, locations_last
    from vialflow.plans.inventory import materialize_trial_vials, trial_extract
    from vialflow.sinks.parquet import read_trials

    codes = ["BUILDING", "OTHER", "MACHINERY"]
    t = _repeated_keys(tables)
    plain = extract_trials(t, codes, _fresh_dir(), download_history=True, semi_join_reduction=False)
    rows = lambda done, name: sorted(map(str, read_trials(spark, done[name]).collect()))
    for more in ({}, {"vialflow.broadcast.maxBytes": "1"}):  # small lookups broadcast, or shuffled
        values = {"vialflow.bloom.minBytes": "0", "vialflow.semijoin.maxRows": "10", "spark.sql.autoBroadcastJoinThreshold": "-1", **more}
        for k, v in values.items():
            spark.conf.set(k, v)
        try:
            t = _repeated_keys(tables)
            done = extract_trials(t, codes, _fresh_dir(), download_history=True)
            v = materialize_trial_vials(t, codes)
            late = locations_last(t, v)
            hist = by_trial(t, inventory_history(t, codes, sort=False, with_trial=True, vials=v, locations=not late))
            plans = [df._jdf.queryExecution().executedPlan().toString() for df in (hist, trial_extract(t, codes, vials=v, spread_by="LAST_NAME"))]
        finally:
            for k in values:
                spark.conf.unset(k)
        assert done["trials"] == plain["trials"] and done["trials"]["OTHER"]["rows"] > 0
        assert rows(done, "snapshot") == rows(plain, "snapshot") and rows(done, "history") == rows(plain, "history")
        assert v.vial_ledger and late == (not more)
        # neither plan joins the ledger to the vials, and no metadata or box join carries the receipt's columns
        assert not any("VIAL_ID#" in line and "SortMergeJoin" in line for p in plans for line in p.splitlines())
        assert any("SortMergeJoin [_RECEIPT#" in line or "SortMergeJoin [RECEIPT_ID#" in line for line in plans[1].splitlines())
