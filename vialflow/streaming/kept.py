"""A trial's ledger kept up to date by a stream, with late vials and changed rows.

The plain stream (:mod:`.history`) appends what can be joined when it arrives.
Here each micro-batch is merged into keyed tables in the shared folder:

* ``kept``: the newest version of every ledger row of the trial's vials, by
  buckets of the vial; a row that comes again (its current flag has flipped, an
  amount was mended) replaces the one before. Only buckets touched are rewritten.
* ``pending``: rows whose vial, or whose vial's receipt, is not known yet; they
  are looked at again with every batch and whenever :meth:`settle` is called.

The history itself is a view of ``kept``: headers, boxes and locations are
joined when it is read, so those may come late, too. All tables of a batch are
published together with the batch's number (see :mod:`vialflow.sinks.publish`);
a batch that Spark runs again after a failure finds its number and does nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.history import inventory_history
from ..plans.inventory import LEDGER_COLUMNS, TrialCodes, trial_where
from ..sinks.publish import Publication, Store, recover
from ..sources.fixtures import DERIVED_SQL
from ..sources.tables import LimsTables
from ..sqltext import run

VERSION = "_VERSION"
BUCKET = "BUCKET"
#: The file that holds the number of the last batch published.
MARK = "_batch.json"


@dataclass
class KeptLedger:
    """The kept tables below ``folder`` for the trial(s) ``codes``.

    ``tables`` gives the tables as they are now; it is asked anew for each batch.
    Rows with equal ``key`` are versions of each other: those of the greatest
    ``_VERSION`` stay, all of them if they share it.
    """

    tables: Callable[[], LimsTables]
    codes: TrialCodes
    folder: str
    key: tuple[str, ...] = ("INVENTORYID", "TRANSACTION_ID")
    buckets: int = 64
    collation: str | None = None

    def batch(self, rows: DataFrame, number: int) -> None:
        """Merge one micro-batch of ledger rows with a ``_VERSION`` (for ``foreachBatch``)."""
        spark = rows.sparkSession
        recover(spark, self.folder)
        store = Store(spark)
        if number <= self._last(store):
            return
        self._merge(rows.select(*LEDGER_COLUMNS, VERSION), number)

    def settle(self) -> None:
        """Look at the pending rows again, with the vials and receipts known by now."""
        t = self.tables()
        recover(t.spark, self.folder)
        self._merge(None, self._last(Store(t.spark)))

    def _last(self, store: Store) -> int:
        text = store.read(f"{self.folder}/state/{MARK}")
        return json.loads(text)["batch"] if text else -1

    def _read(self, spark, name: str, like: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        return spark.read.schema(like.schema).parquet(path) if Store(spark).exists(path) else like.limit(0)

    def _merge(self, new: DataFrame | None, number: int) -> None:
        t = self.tables()
        spark, work = t.spark, Publication(t.spark, self.folder)
        shape = spark.createDataFrame([], self._shape(t))
        rows = self._read(spark, "pending", shape)
        if new is not None:
            rows = rows.union(new.select(*[F.col(f.name).cast(f.dataType) for f in shape.schema]))
        pred, args = trial_where(t, "CR.LAST_NAME", self.codes, self.collation)
        # a vial is known once it has a receipt; one row for each, however often it is received
        known = run(spark, f"""
SELECT INV.INVENTORYID AS VIAL_ID, bool_or({pred}) AS OURS
FROM {{INVENTORY_VLA}} INV JOIN {{CENTRALRECEIVING_VLA}} CR ON CR.EXTERNAL_ID = INV.EXTERNAL_ID
GROUP BY INV.INVENTORYID""", t, args)
        try:
            seen = f"{work.staging}/seen"
            rows.join(known, F.col("INVENTORYID") == F.col("VIAL_ID"), "left").drop("VIAL_ID").write.parquet(seen)
            judged = spark.read.parquet(seen)
            bucket = F.pmod(F.xxhash64("INVENTORYID"), F.lit(self.buckets)).cast("int")
            ours = judged.where("OURS").drop("OURS").withColumn(BUCKET, bucket)
            touched = [r[0] for r in ours.select(BUCKET).distinct().collect()]  # at most ``buckets``
            if touched:
                old = self._read(spark, "kept", shape.withColumn(BUCKET, F.lit(0))).where(F.col(BUCKET).isin(touched))
                newest = F.max(VERSION).over(Window.partitionBy(*self.key))
                merged = old.unionByName(ours).withColumn("_NEWEST", newest).where(F.col(VERSION) == F.col("_NEWEST")).drop("_NEWEST")
                merged.distinct().write.partitionBy(BUCKET).parquet(f"{work.staging}/kept")
                work.moves += [[f"{work.staging}/kept/{BUCKET}={b}", f"{self.folder}/kept/{BUCKET}={b}"] for b in touched]
            judged.where(F.col("OURS").isNull()).drop("OURS").write.parquet(work.stage(f"{self.folder}/pending"))
            Store(spark).write(f"{work.staging}/state/{MARK}", json.dumps({"batch": number}))
            work.moves.append([f"{work.staging}/state", f"{self.folder}/state"])
        except BaseException:
            work.abandon()
            raise
        work.commit()

    def _shape(self, t: LimsTables):
        return t["INVENTORY_TRANSACTIONS_VLA"].select(*LEDGER_COLUMNS).withColumn(VERSION, F.lit(0).cast("long")).schema

    def history(self, *, sort: bool = True) -> DataFrame:
        """The trial's movement history as of the last batch; ask anew after the next, which replaces files."""
        t = self.tables()
        recover(t.spark, self.folder)
        shape = t.spark.createDataFrame([], self._shape(t)).withColumn(BUCKET, F.lit(0))
        kept = self._read(t.spark, "kept", shape).select(*LEDGER_COLUMNS)
        return inventory_history(LimsTables({**t.frames, "INVENTORY_TRANSACTIONS_VLA": kept}), self.codes, collation=self.collation, sort=sort)

    def follow(self, ledger: DataFrame, checkpoint: str) -> None:
        """Merge everything that the stream ``ledger`` has now, then stop (``availableNow``)."""
        query = ledger.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()


def versioned_fixture_stream(spark, lineitem_path: str) -> DataFrame:
    """The derived ledger over a stream of driver ``lineitem`` files; a later file holds later versions."""
    schema = spark.read.parquet(lineitem_path).schema
    raw = spark.readStream.schema(schema).parquet(lineitem_path).withColumn(VERSION, F.unix_micros("_metadata.file_modification_time"))
    text = DERIVED_SQL["INVENTORY_TRANSACTIONS_VLA"].replace("SELECT ", f"SELECT {VERSION}, ", 1)
    return spark.sql(text, lineitem=raw).select(*LEDGER_COLUMNS, VERSION)
