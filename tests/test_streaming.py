"""The history maintained as a stream equals the batch history."""

from __future__ import annotations

from tests.conftest import SF0001
from vialflow.plans.history import inventory_history
from vialflow.streaming.history import fixture_ledger_stream, history_stream, run_history_stream


def test_stream_equals_batch(tables):
    streamed = run_history_stream(tables, f"{SF0001}/lineitem*.parquet", "BUILDING")
    batch = inventory_history(tables, "BUILDING", sort=False)
    assert streamed.count() == batch.count() == 1336
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_is_stateless(spark, tables):
    df = history_stream(tables, fixture_ledger_stream(spark, f"{SF0001}/lineitem*.parquet"), "BUILDING")
    assert df.isStreaming
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" not in plan.split("Join")[0]  # joins are stream-static; no stateful operator on the stream


def test_stream_resumes_from_checkpoint(spark, tables):
    """Files that arrive later are processed once, on the next run, from the same checkpoint."""
    import tempfile

    from pyspark.sql import functions as F

    from vialflow.session import scratch_path

    landing = tempfile.mkdtemp(prefix="vialflow-landing-")
    raw = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    raw.where(F.col("l_orderkey") % 2 == 0).coalesce(1).write.parquet(f"{landing}/batch1")
    sink, ckpt = scratch_path(spark, "stream_sink"), scratch_path(spark, "stream_ckpt")
    first = run_history_stream(tables, f"{landing}/batch*/*.parquet", "BUILDING", sink=sink, checkpoint=ckpt).count()
    raw.where(F.col("l_orderkey") % 2 == 1).coalesce(1).write.parquet(f"{landing}/batch2")
    both = run_history_stream(tables, f"{landing}/batch*/*.parquet", "BUILDING", sink=sink, checkpoint=ckpt)
    batch = inventory_history(tables, "BUILDING", sort=False)
    assert 0 < first < both.count() == batch.count() == 1336
    assert both.exceptAll(batch).count() == 0 and batch.exceptAll(both).count() == 0


def test_stream_over_large_tables(spark, tables):
    """Large tables bring reducers: those of the trial cut the stream, none is built from it."""
    conf = {"vialflow.bloom.minBytes": "0", "vialflow.broadcast.maxBytes": "1"}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        streamed = run_history_stream(tables, f"{SF0001}/lineitem*.parquet", "BUILDING")
        plan = history_stream(tables, fixture_ledger_stream(spark, f"{SF0001}/lineitem*.parquet"), "BUILDING")
        assert "bit_or" in plan._jdf.queryExecution().analyzed().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    batch = inventory_history(tables, "BUILDING", sort=False)
    assert streamed.count() == 1336
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


# --- the kept ledger: late vials, changed rows, batches run twice ------------------------------

KEY = ("INVENTORYID", "TRANSACTION_ID", "THAWCOUNT")


def _keeper(spark, tables, now):
    from vialflow.session import scratch_path
    from vialflow.streaming.kept import KeptLedger

    return KeptLedger(lambda: now[0], "BUILDING", scratch_path(spark, "kept"), key=KEY, buckets=4)


def _versioned(tables, version, where="true", **changes):
    from pyspark.sql import functions as F

    from vialflow.plans.inventory import LEDGER_COLUMNS
    from vialflow.streaming.kept import VERSION

    rows = tables["INVENTORY_TRANSACTIONS_VLA"].where(where).select(*LEDGER_COLUMNS)
    return rows.withColumns({c: F.expr(e) for c, e in changes.items()}).withColumn(VERSION, F.lit(version).cast("long"))


def _without(tables, table, where):
    from vialflow.sources.tables import LimsTables

    return LimsTables({**tables.frames, table: tables[table].where(where)})


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_late_vials_and_receipts_are_followed(spark, tables):
    batch = inventory_history(tables, "BUILDING", sort=False)
    for table, where in (("INVENTORY_VLA", "INVENTORYID % 3 = 0"), ("CENTRALRECEIVING_VLA", "ORIGREC % 2 = 0")):
        now = [_without(tables, table, where)]
        kept = _keeper(spark, tables, now)
        kept.batch(_versioned(tables, 1, "INVENTORYID % 2 = 0"), 0)
        part = kept.history(sort=False).count()
        assert 0 < part < 1336
        now[0] = tables
        kept.batch(_versioned(tables, 2, "INVENTORYID % 2 = 1"), 1)  # the next batch finds the pending rows, too
        assert _same(kept.history(sort=False), batch)
        assert spark.read.parquet(f"{kept.folder}/pending").count() == 0


def test_flag_flips_replace_rows(spark, tables):
    now = [tables]
    kept = _keeper(spark, tables, now)
    kept.batch(_versioned(tables, 1), 0)
    kept.batch(_versioned(tables, 2, "THAWCOUNT = 1", FLAG_CURRENT="0", AMOUNTLEFT="-1"), 1)
    got = kept.history(sort=False)
    assert got.count() == 1336 and got.where("FLAG_CURRENT = 1").count() == 0
    plain = inventory_history(tables, "BUILDING", sort=False)
    assert got.where("AMOUNTLEFT = -1").count() >= plain.where("FLAG_CURRENT = 1").count() > 0
    # an older version that arrives late changes nothing
    before = sorted(map(str, got.collect()))
    kept.batch(_versioned(tables, 1, "THAWCOUNT = 1"), 2)
    assert sorted(map(str, kept.history(sort=False).collect())) == before and kept.history().columns == plain.columns


def test_batch_run_twice_and_failed_batch(spark, tables, monkeypatch):
    import pytest

    from vialflow.sinks import publish

    now = [tables]
    kept = _keeper(spark, tables, now)
    kept.batch(_versioned(tables, 1, "INVENTORYID % 2 = 0"), 0)
    half = kept.history(sort=False).count()
    kept.batch(_versioned(tables, 1, "INVENTORYID % 2 = 1"), 0)  # the number is known: nothing is merged
    assert kept.history(sort=False).count() == half

    def dies(self):
        raise RuntimeError("lost")

    monkeypatch.setattr(publish.Publication, "commit", dies)
    with pytest.raises(RuntimeError):
        kept.batch(_versioned(tables, 1, "INVENTORYID % 2 = 1"), 1)
    monkeypatch.undo()
    assert kept.history(sort=False).count() == half
    kept.batch(_versioned(tables, 1, "INVENTORYID % 2 = 1"), 1)
    assert _same(kept.history(sort=False), inventory_history(tables, "BUILDING", sort=False))


def test_kept_history_follows_files(spark, tables):
    """Files with the first rows, then one with flipped flags: a stream from one checkpoint."""
    import tempfile

    from pyspark.sql import functions as F

    from vialflow.session import scratch_path
    from vialflow.streaming.kept import versioned_fixture_stream

    landing = tempfile.mkdtemp(prefix="vialflow-landing-")
    raw = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    raw.coalesce(1).write.parquet(f"{landing}/batch1")
    kept, checkpoint = _keeper(spark, tables, [tables]), scratch_path(spark, "kept_ckpt")
    follow = lambda: kept.follow(versioned_fixture_stream(spark, f"{landing}/batch*/*.parquet"), checkpoint)
    follow()
    assert _same(kept.history(sort=False), inventory_history(tables, "BUILDING", sort=False))
    raw.where("l_linenumber = 2").withColumn("l_returnflag", F.lit("Z")).coalesce(1).write.parquet(f"{landing}/batch2")
    follow()
    got = kept.history(sort=False)
    assert got.count() == 1336 and got.where("COMMENTS = 'Z'").count() > 0
