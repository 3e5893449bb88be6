"""Token counts of documents in flat token files without an index.

A flat file is a run of unsigned 16-bit ids with a separator after each
document, cut into blocks anywhere. Each block is searched for separators by
itself with numpy; a prefix scan over the blocks' summaries then numbers the
separators and gives every block the ids that the document open at its start
already has, which stitches documents across blocks. The scan runs in ranges of
blocks first and over the ranges' sums then, so a long file is dealt to many
tasks; only summaries take part in it, never the documents' lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialflow.llm.common import small_batches, store
from vialflow.llm.tokens import encoder

#: Ids in a block.
BLOCK_IDS = 1 << 18
#: A range has 2 to this power of a file's blocks.
RANGE_BITS = 10


def write_flat(docs: DataFrame, path: str, tokenizer: str, separator: int, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Write a flat file for each partition of ``docs`` below ``path``.

    Columns file, block, ids hold the flat files; first_doc and doc_ids are the
    list of what was written, in order, for a reader that wants names with its
    counts. ``separator`` must be an id that no text is encoded to. Null and
    empty texts are a separator alone; a null id stays null; repeated rows are
    written each. Other columns are not read; an empty table has no blocks.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    end = np.array([separator], dtype="<u2").tobytes()
    schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("ids", pa.binary()), ("first_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, held, docs_before = TaskContext.get().partitionId(), 0, bytearray(), 0
        names: list = []

        def cut(n: int) -> pa.RecordBatch:
            row = {"file": file, "block": block, "ids": bytes(held[:n]), "first_doc": docs_before, "doc_ids": list(names)}
            del held[:n]
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                for key, made in zip(part.column(0).to_pylist(), encoder(tokenizer, True).encode(part.column(1).to_pylist())):
                    held += np.frombuffer(made, "<u4").astype("<u2").tobytes()
                    held += end
                    names.append(key)
                    while len(held) >= 2 * block_ids:
                        yield cut(2 * block_ids)
                        block, docs_before, names = block + 1, docs_before + len(names), []
        if held or names:
            yield cut(len(held))

    made = rows.mapInArrow(run, "file long, block long, ids binary, first_doc long, doc_ids array<long>")
    made.write.option("compression", "zstd").parquet(path)


def scan(blocks: DataFrame, separator: int) -> DataFrame:
    """(file, doc, n_tokens, closed) of flat files given as (file, block, ids).

    ``doc`` counts a file's documents from 0; separators are not counted as
    tokens. Ids after a file's last separator are a document with closed =
    false. Null or empty blocks hold no ids; files without ids have no rows.
    Blocks without a file are one file, blocks without a number its first.
    Repeated blocks are blocks of their own, side by side. Other columns are
    not read; an empty table has an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(2)[i].as_py() or b""
                ids = np.frombuffer(raw, "<u2")
                at = np.flatnonzero(ids == separator)
                first, last = (int(at[0]), int(at[-1]) + 1) if len(at) else (None, None)
                cols = [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([len(ids)], pa.int64()), pa.array([len(at)], pa.int64()), pa.array([first], pa.int64()), pa.array([last], pa.int64()), pa.array([(np.diff(at) - 1).astype("<i8")], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["file", "block", "n", "seps", "first", "last", "inner"])

    found = blocks.select(F.col("file").cast("long"), F.col("block").cast("long"), F.col("ids").cast("binary"))
    found = found.mapInArrow(run, "file long, block long, n long, seps long, first long, last long, inner array<long>")
    found = store(found.withColumn("at", F.monotonically_increasing_id()), "scan-blocks")
    zero, end = F.lit(0).cast("long"), F.col("start") + F.col("last")

    def scanned(rows: DataFrame, within: list[str], order: list[str]) -> DataFrame:
        """With the ids and separators before each row, and the end of the last separator before it (null: none)."""
        before = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumns({"start": F.coalesce(F.sum("n").over(before), zero), "doc0": F.coalesce(F.sum("seps").over(before), zero)})
        return rows.withColumn("opened", F.max(end).over(before))

    narrow = found.select("at", "file", "block", F.shiftright("block", RANGE_BITS).alias("range"), "n", "seps", "last")
    placed = store(scanned(narrow, ["file", "range"], ["block", "at"]), "scan-placed")
    ranges = placed.groupBy("file", "range").agg(F.sum("n").alias("n"), F.sum("seps").alias("seps"), F.max(end).alias("last"))
    ranges = store(scanned(ranges, ["file"], ["range"]), "scan-ranges")

    r = ranges.select(F.col("file").alias("rf"), F.col("range").alias("rr"), F.col("start").alias("start0"), F.col("doc0").alias("doc00"), F.coalesce("opened", zero).alias("opened0"))
    known = placed.where("seps > 0").join(r, F.col("file").eqNullSafe(F.col("rf")) & F.col("range").eqNullSafe(F.col("rr")))
    start, opened = F.col("start0") + F.col("start"), F.coalesce(F.col("start0") + F.col("opened"), F.col("opened0"))
    known = known.select("at", "file", (F.col("doc00") + F.col("doc0")).alias("doc0"), (start - opened).alias("open"))
    lengths = F.concat(F.array(F.col("open") + F.col("first")), F.col("inner"))
    closed = known.join(found.select("at", "first", "inner"), "at").select("file", "doc0", F.posexplode(lengths).alias("i", "n_tokens"))
    closed = closed.select("file", (F.col("doc0") + F.col("i")).alias("doc"), "n_tokens", F.lit(True).alias("closed"))
    ends = ranges.groupBy("file").agg(F.sum("n").alias("n"), F.sum("seps").alias("doc"), F.max(end).alias("last"))
    rest = F.col("n") - F.coalesce("last", zero)
    return closed.union(ends.where(rest > 0).select("file", "doc", rest.alias("n_tokens"), F.lit(False).alias("closed")))


def count_tokens(spark: SparkSession, path: str, separator: int) -> DataFrame:
    """(doc_id, n_tokens) for every document that :func:`write_flat` wrote below ``path``."""
    written = spark.read.parquet(path)
    counted = scan(written.select("file", "block", "ids"), separator).where("closed")
    listed = written.select(F.col("file").alias("f"), "first_doc", F.posexplode("doc_ids").alias("i", "doc_id"))
    listed = listed.select("f", (F.col("first_doc") + F.col("i")).alias("d"), "doc_id")
    joined = counted.join(listed, (counted["file"] == listed["f"]) & (counted["doc"] == listed["d"]))
    return joined.select("doc_id", "n_tokens")
