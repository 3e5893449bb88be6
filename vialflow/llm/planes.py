"""Token ids in bit- or byte-plane files.

Ids of all documents follow one another in ascending document id, over shards
(one for each range of ids) and in blocks of a fixed number of ids. A block's
ids are transposed into planes - all lowest bytes, then all second bytes, and
so on, or the same by bits - and each plane is compressed by itself with
zstandard. The block's row is its entry in the chunk index: shard, place,
number of ids, and the documents that start in it. The container is Parquet,
written and committed by Spark, so any store that Spark writes to will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialflow.llm.common import shuffle_partitions, small_batches
from vialflow.llm.tokens import encoder

#: Ids in a block.
BLOCK_IDS = 65536
_SCHEMA = "shard int, chunk int, first_id long, n_ids int, kind string, planes array<binary>, doc_ids array<long>, doc_starts array<long>"
_ARROW = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()), ("kind", pa.string()), ("planes", pa.list_(pa.binary())), ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64()))])


def to_planes(ids: np.ndarray, kind: str = "byte", level: int = 3) -> list[bytes]:
    """Compressed planes of unsigned 32-bit ids."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    rows = octets.T if kind == "byte" else np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1)
    packer = zstandard.ZstdCompressor(level=level)
    return [packer.compress(np.ascontiguousarray(r).tobytes()) for r in rows]


def from_planes(planes: list[bytes], n_ids: int, kind: str = "byte") -> np.ndarray:
    """The ids that :func:`to_planes` was given."""
    unpacker = zstandard.ZstdDecompressor()
    rows = np.stack([np.frombuffer(unpacker.decompress(p), np.uint8) for p in planes])
    if kind == "bit":
        rows = np.packbits(np.unpackbits(rows, axis=1, count=n_ids), axis=0, bitorder="little")
    return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, kind: str = "byte", id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> None:
    """Encode every whole text, append ``end_id`` and write the ids below ``path``.

    Documents follow in ascending id, null ids first; rows that share an id
    follow in the order of their text's hash, and repeated rows one by one. Null
    and empty texts have the end id only. Other columns are not read. An empty
    table makes an archive of no blocks.
    """
    small_batches(docs.sparkSession)
    n = shards or shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    dealt = rows.repartitionByRange(n, F.col("id"), F.xxhash64("text")).sortWithinPartitions(F.col("id"), F.xxhash64("text"))
    end = np.array([end_id], dtype="<u4").tobytes()
    size = BLOCK_IDS * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, done, held = TaskContext.get().partitionId(), 0, 0, bytearray()
        ids: list = []
        starts: list = []

        def block(n_bytes: int) -> pa.RecordBatch:
            part = np.frombuffer(bytes(held[:n_bytes]), "<u4")
            here = sum(s < done + len(part) for s in starts)
            row = {"shard": shard, "chunk": chunk, "first_id": done, "n_ids": len(part), "kind": kind, "planes": to_planes(part, kind), "doc_ids": ids[:here], "doc_starts": starts[:here]}
            del held[:n_bytes], ids[:here], starts[:here]
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                for key, made in zip(part.column(0).to_pylist(), encoder(tokenizer).encode(part.column(1).to_pylist())):
                    ids.append(key)
                    starts.append(done + len(held) // 4)
                    held += made
                    held += end
                    while len(held) >= size:
                        yield block(size)
                        chunk, done = chunk + 1, done + BLOCK_IDS
        if held:
            yield block(len(held))

    dealt.mapInArrow(run, _SCHEMA).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """One row for each document, from the files: doc_id, start, n_tokens, and its ids.

    ``start`` counts the ids of all documents before it. With ``digest`` the
    ids give way to ``ids_crc32``, the CRC-32 of the ids as little-endian
    unsigned 32-bit integers, made piece by piece.
    """
    chunks = spark.read.schema(_SCHEMA).parquet(path)
    last = "ids_crc32 long" if digest else "ids array<long>"
    kind_of = pa.int64() if digest else pa.list_(pa.int64())
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), (last.split()[0], kind_of)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        now = None  # shard, id, local start, ids so far, pieces or CRC

        def add(piece: np.ndarray) -> None:
            now[3] += len(piece)
            if digest:
                now[4] = zlib.crc32(piece.tobytes(), now[4])
            else:
                now[4].append(piece)

        def close() -> None:
            if now is not None:
                out.append(now[:4] + [now[4] if digest else np.concatenate(now[4]).astype("<i8")])

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out.clear()
            return made

        for batch in batches:
            for row in batch.to_pylist():
                ids, first = from_planes(row["planes"], row["n_ids"], row["kind"]), row["first_id"]
                if now is not None and now[0] != row["shard"]:
                    close()
                    now = None
                cuts = [s - first for s in row["doc_starts"]]
                if now is not None and (head := ids[: cuts[0] if cuts else len(ids)]).size:
                    add(head)
                for key, a, b in zip(row["doc_ids"], cuts, [*cuts[1:], len(ids)]):
                    close()
                    now = [row["shard"], key, first + a, 0, 0 if digest else []]
                    add(ids[a:b])
                if len(out) >= 4096 or (out and not digest):
                    yield flush()
        close()
        if out:
            yield flush()

    ordered = chunks.repartition(shuffle_partitions(spark), "shard").sortWithinPartitions("shard", "chunk")
    read = ordered.mapInArrow(run, f"shard int, doc_id long, local long, n_tokens long, {last}")
    # one row for each shard
    whole = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    base = whole.select(F.col("shard").alias("s"), F.coalesce(before, F.lit(0)).alias("base"))
    joined = read.join(F.broadcast(base), read["shard"] == base["s"])
    return joined.select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", last.split()[0])
