"""Inventory history maintained as a stream of ledger rows.

New ledger rows (the ``INVENTORY_TRANSACTIONS_VLA`` shape) arrive as files;
each micro-batch is joined to the static tables with the same statement as
the batch history: an inner stream-static join to the trial's vials, and
left stream-static joins to transaction headers, parent boxes and
locations. Large tables add the Bloom filters of the trial's receipts and vials
(static, too), never one of the ledger's own ids. All joins are stateless (the stream is on the left), so no state
store grows; the sink is Parquet with its checkpoint in the shared folder,
so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.history import history_sql
from ..plans.inventory import TrialCodes, trial_filter_sql
from ..session import scratch_path
from ..sources.fixtures import DERIVED_SQL
from ..sources.tables import COLUMNS, LimsTables
from ..sqltext import run


def ledger_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 64) -> DataFrame:
    """Raw ledger files as a stream; the schema is taken from the files once."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def fixture_ledger_stream(spark: SparkSession, lineitem_path: str) -> DataFrame:
    """The derived ledger (fixture SQL) over a stream of driver ``lineitem`` files."""
    raw = ledger_file_stream(spark, lineitem_path)
    text = DERIVED_SQL["INVENTORY_TRANSACTIONS_VLA"]
    return spark.sql(text, lineitem=raw).select(*COLUMNS["INVENTORY_TRANSACTIONS_VLA"])


def history_stream(t: LimsTables, ledger: DataFrame, trial_codes: TrialCodes) -> DataFrame:
    """Streaming history rows (unsorted: a stream has no global order)."""
    pred, args = trial_filter_sql("CR.LAST_NAME", trial_codes)
    tables = {**t.frames, "INVENTORY_TRANSACTIONS_VLA": ledger}
    return run(t.spark, history_sql(t, pred, sort=False, streamed=True), tables, args)


def write_available_now(df: DataFrame, sink_path: str, checkpoint_path: str) -> StreamingQuery:
    """Process everything available, then stop (``availableNow``)."""
    query = (
        df.writeStream.format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_history_stream(
    t: LimsTables,
    lineitem_path: str,
    trial_codes: TrialCodes,
    *,
    sink: str | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Run the stream over the files present now; return all rows written so far.

    Pass the same ``sink`` and ``checkpoint`` again to resume: only files
    that arrived since the last run are processed.
    """
    spark = t.spark
    sink = sink or scratch_path(spark, "history_stream")
    checkpoint = checkpoint or scratch_path(spark, "history_stream_ckpt")
    write_available_now(history_stream(t, fixture_ledger_stream(spark, lineitem_path), trial_codes), sink, checkpoint)
    return spark.read.parquet(sink)
