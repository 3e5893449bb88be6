"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are 64-bit SimHashes over word shingles. Distinct fingerprints
are dealt into tiles by the bit counts of their sub-words: two fingerprints
within radius r have sub-word counts that differ by r in total at most, so
all other pairs of tiles are skipped. What is left is compared exactly, tile
against tile, with numpy exclusive-or and bit counts. No candidate is
estimated and no cap is set, so no link is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialflow.llm.common import connected_components, store

#: Fingerprints in one side of a comparison; a larger tile is split.
TILE_ROWS = 8192
_STEP = 256  # rows compared at once with the other side
_PART = 65536  # shingles whose bits are unpacked at once


def simhash64(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one text: ASCII lower case, white-space words, XXH64 of the joined shingles.

    Fewer words than ``shingle`` make one shingle of all; no word (null and
    empty texts too) gives zero. A bit is one if set in over half the hashes.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    grams = [words] if len(words) <= shingle else zip(*(words[i:] for i in range(shingle)))
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, grams), itertools.repeat(seed))
    count, ones = 0, np.zeros(64, dtype=np.int64)
    while part := list(itertools.islice(hashes, _PART)):
        h = np.array(part, dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        count += len(part)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, keys: Sequence[Column] = ()) -> DataFrame:
    """(id, fp) for every row; fp is the 64-bit fingerprint as a signed long. ``keys``: named columns of longs to carry along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((simhash64(t.as_py(), shingle, seed) for t in batch.column(1)), "<u8", batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view("<i8")), *batch.columns[2:]], names=["id", "fp", *names])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"), *keys)
    names = narrow.columns[2:]
    return narrow.mapInArrow(run, ", ".join(f"{c} long" for c in ["id", "fp", *names]))


def _tile(fp: Column, blocks: int) -> Column:
    """The bit counts of ``blocks`` sub-words, packed into one long."""
    width = 64 // blocks
    field = width.bit_length()
    key = F.lit(0).cast("long")
    for i in range(blocks):
        part = F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        key = key + F.shiftleft(F.bit_count(part).cast("long"), i * field)
    return key


def _deltas(blocks: int, radius: int) -> list[int]:
    """Differences between packed counts of tiles within ``radius``; one of each pair of signs."""
    field = (64 // blocks).bit_length()
    found = {0}
    for _ in range(radius):
        found |= {d + s * (1 << (i * field)) for d in found for i in range(blocks) for s in (1, -1)}
    return sorted(d for d in found if d >= 0)


def _merge(lab: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked entries one label, in place."""
    while True:
        la, lb = lab[a], lab[b]
        if not (apart := la != lb).any():
            return
        np.minimum.at(lab, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while ((up := lab[lab]) != lab).any():
            lab[:] = up


def _linked(x: np.ndarray, y: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within x, or between x and y."""
    both = x if y is None else np.concatenate([x, y])
    lab, other, shift = np.arange(len(both)), x if y is None else y, 0 if y is None else len(x)
    for i in range(0, len(x), _STEP):
        a, b = np.nonzero(np.bitwise_count(x[i : i + _STEP, None] ^ other[None, :]) <= radius)
        if len(a):
            _merge(lab, a + i, b + shift)
    moved = np.flatnonzero(lab != np.arange(len(both)))
    return both[moved], both[lab[moved]]


def links(fps: DataFrame, radius: int = 2, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of column ``fp``.

    Connects exactly what all pairs within ``radius`` bits connect, with a
    spanning forest for each pair of tiles in place of every pair. ``blocks``
    (4, 8 or 16 sub-words) sets only the cost: more sub-words skip more pairs
    and deal each fingerprint to more tiles; by default 4 up to 2**22
    fingerprints, 8 up to 2**30, then 16.
    """
    fps = fps.select("fp")
    if blocks is None:
        n = fps.count()
        blocks = 4 if n <= 1 << 22 else 8 if n <= 1 << 30 else 16
    keyed = fps.withColumn("tile", _tile(F.col("fp"), blocks))
    tiles = store(keyed.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias("chunks")), "simhash-tiles")
    dealt = keyed.join(tiles, "tile").select("tile", F.pmod(F.xxhash64("fp"), "chunks").cast("int").alias("chunk"), "fp")
    blobs = store(dealt.groupBy("tile", "chunk").agg(F.collect_list("fp").alias("fps")), "simhash-blobs")

    near = F.explode(F.array(*[F.lit(d).cast("long") for d in _deltas(blocks, radius)]))
    one = tiles.select(F.col("tile").alias("t1"), F.col("chunks").alias("n1"), near.alias("d")).withColumn("t2", F.col("t1") + F.col("d"))
    two = tiles.select(F.col("tile").alias("t2"), F.col("chunks").alias("n2"))
    units = one.join(two, "t2").withColumn("c1", F.explode(F.sequence(F.lit(0), F.col("n1") - 1)))
    units = units.withColumn("c2", F.explode(F.sequence(F.lit(0), F.col("n2") - 1))).where("t1 <> t2 or c1 <= c2")
    x = blobs.select(F.col("tile").alias("t1"), F.col("chunk").alias("c1"), F.col("fps").alias("x"))
    y = blobs.select(F.col("tile").alias("t2"), F.col("chunk").alias("c2"), F.col("fps").alias("y"))
    same = (F.col("t1") == F.col("t2")) & (F.col("c1") == F.col("c2"))
    units = units.join(x, ["t1", "c1"]).join(y, ["t2", "c2"]).select("x", F.when(~same, F.col("y")).alias("y"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = lambda s: s.values.to_numpy(zero_copy_only=False).view("<u8") if s.is_valid else None
        for batch in batches:
            found = [_linked(values(x), values(y), radius) for x, y in zip(batch.column(0), batch.column(1))]
            a, b = (np.concatenate([f[i] for f in found] or [np.zeros(0, "<u8")]).view("<i8") for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return units.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over fingerprints that
    differ in ``radius`` bits or fewer. Null and empty texts have fingerprint
    zero and link like any other; repeated rows come back as often as they
    came; a null id stays null and takes part through its text; a component
    of null ids only has a null id. Other columns of ``docs`` are not read.
    """
    rows = store(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-rows")
    label = _least(rows, F.col("id"), radius)
    out = rows.join(label, rows["fp"] == label["f"])
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("c").alias("component_id"))


def _least(rows: DataFrame, by: Column, radius: int) -> DataFrame:
    """(f, c) for every fingerprint of ``rows``: the least ``by`` of the rows in its component."""
    distinct = store(rows.groupBy("fp").agg(F.min(by).alias("first")), "simhash-distinct")
    roots = connected_components(links(distinct, radius))
    member = store(distinct.join(roots, distinct["fp"] == roots["node"]).select("fp", "root", "first"), "simhash-members")
    least = member.groupBy("root").agg(F.min("first").alias("least"))
    linked = store(member.join(least, "root").select("fp", "least"), "simhash-linked")
    return store(distinct.join(linked, "fp", "left").select(F.col("fp").alias("f"), F.coalesce("least", "first").alias("c")), "simhash-labels")


def _content(id_col: str, text_col: str) -> list[Column]:
    """128 bits of a row's id and text."""
    return [F.xxhash64(F.lit(s), F.col(id_col).cast("long"), F.col(text_col)).alias(n) for s, n in ((1, "ka"), (2, "kb"))]


def _without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, how: str = "left_anti") -> DataFrame:
    """``docs`` without (or with ``how`` left_semi: only) the rows whose id and text hash to (ka, kb) of ``gone``."""
    a, b = _content(id_col, text_col)
    return docs.join(gone, (a == gone["ka"]) & (b == gone["kb"]), how)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, repeats: bool = True) -> DataFrame:
    """``docs`` with what stays of each component; columns as they came.

    With ``repeats`` all rows with the smallest id of their own component stay,
    and all rows with a null id. Without, exactly one row of each component
    stays: the smallest id (null last), of these the least hash of id and text,
    and one of the rows equal in both. Rows are judged by their own text: an id
    that occurs with several texts may stay with some of them.
    """
    rows = store(fingerprints(docs, id_col, text_col, shingle, keys=_content(id_col, text_col)), "simhash-rows")
    if repeats:
        label = _least(rows, F.col("id"), radius)
        gone = rows.join(label, rows["fp"] == label["f"]).where("id <> c").select("ka", "kb").distinct()
        return _without(docs, store(gone, "simhash-gone"), id_col, text_col)
    row = F.struct(F.col("id").isNull().alias("none"), "id", "ka", "kb")
    label = _least(rows, row, radius)
    judged = rows.join(label, rows["fp"] == label["f"])
    lost = (F.col("ka") != F.col("c.ka")) | (F.col("kb") != F.col("c.kb"))
    # what loses, and what stays but has copies
    met = judged.groupBy("ka", "kb").agg(F.bool_or(lost).alias("lost"), F.count(F.lit(1)).alias("n")).where("lost or n > 1")
    met = store(met, "simhash-gone")
    out = _without(docs, met, id_col, text_col)
    copied = met.where("not lost").select("ka", "kb")
    if copied.isEmpty():
        return out
    a, b = _content(id_col, text_col)
    named = docs.select(a, b, F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    once = named.join(copied, ["ka", "kb"], "left_semi").groupBy("ka", "kb").agg(F.any_value("row").alias("row"))
    return out.union(once.select("row.*"))
