"""Exact top-k inner products by a vector-approximation file.

Every distinct vector has a row in the approximation file: for each dimension
the number of the cell, one byte, that its component lies in. Cells end at
quantiles of a bounded sample and reach to the extremes of all rows, so they
bound each component, and a scan of the file bounds each score from below and
above. A vector may be among the best of a query only if its upper bound is not
below the k-th best lower bound. Of these the exact vectors are read in the
order of their bounds, a growing step at a time, until the k-th best exact
score beats the bounds of all that are left.

Scan units pair a block of the file with a block of queries. Equal vectors are
one row that lists the few smallest ids, so copies cost nothing and never meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialflow.llm.common import store

#: Components (rows x dimensions) of the sample that the cells are cut by.
SAMPLE = 1 << 20
#: Cells of a dimension; a cell number is a byte.
CELLS = 256
#: Vectors and queries of a block. They set the cost only.
BLOCK, QUERIES = 4096, 1024
#: Queries bounded at once.
_STEP = 128
#: Copies of a query's result, so that a query vector that many rows share spreads over tasks.
_SALTS = 8
#: The id that rows without one are ordered by.
_NO_ID = (1 << 63) - 1


def whole(vector: Column, scale: int) -> Column:
    """floor(scale x) of every component, as longs."""
    return F.transform(vector, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("long"))


def finite(vector: Column) -> Column:
    """True if ``vector`` is there and has finite components only."""
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(good, F.lit(False))


def _padded(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of longs as rows of ``width``, zeros at the end of the shorter ones."""
    values, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
    if (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


class Cells:
    """Cell ends of each dimension, and the least and greatest value that a cell may hold."""

    def __init__(self, sample: np.ndarray, low: np.ndarray, high: np.ndarray, cells: int = CELLS):
        self.width = len(low)
        self.low, self.high = np.zeros((self.width, cells)), np.zeros((self.width, cells))
        self.ends = []
        for d in range(self.width):
            q = np.quantile(sample[:, d], np.arange(1, cells) / cells, method="higher") if len(sample) else []
            ends = np.unique(np.asarray(q, np.int64))
            self.ends.append(ends)
            self.low[d, : len(ends) + 1] = np.concatenate([[low[d]], ends])
            self.high[d, : len(ends) + 1] = np.concatenate([ends - 1, [high[d]]])

    def of(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, d], "right") for d, e in enumerate(self.ends)], axis=1).astype(np.uint8) if len(x) else np.zeros((0, self.width), np.uint8)

    def bounds(self, cells: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores, a row for each of ``cells`` and a column for each query."""
        dims = np.arange(self.width)
        low, high = self.low[dims, cells], self.high[dims, cells]
        up, down = np.maximum(queries, 0).astype(float).T, np.minimum(queries, 0).astype(float).T
        # sums beyond 2**53 are rounded; the bounds are widened by more than that
        most = np.abs(queries).astype(float) @ np.maximum(np.abs(self.low).max(axis=1), np.abs(self.high).max(axis=1))
        slack = np.where(most < 2.0**52, 0.0, most * 2.0**-40)
        return low @ up + high @ down - slack, high @ up + low @ down + slack


def _extremes(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each dimension; shorter vectors count as zeros there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: np.ndarray | None = None
        for batch in batches:
            x = batch.column(0)
            sizes = np.diff(x.offsets.to_numpy())
            if not len(sizes):
                continue
            part = _padded(x, int(sizes.max()))
            a, b = part.min(axis=0), part.max(axis=0)
            if low is None:
                low, high, least = a, b, int(sizes.min())
                continue
            least, wide = min(least, int(sizes.min())), max(len(a), len(low))
            grow = lambda v: np.concatenate([v, np.zeros(wide - len(v), np.int64)])
            low, high = np.minimum(grow(low), grow(a)), np.maximum(grow(high), grow(b))
        if low is not None:
            names = ["d", "low", "high", "least"]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low))), pa.array(low), pa.array(high), pa.array(np.full(len(low), least))], names=names)

    parts = vectors.select("x").mapInArrow(run, "d long, low long, high long, least long")
    found = parts.groupBy("d").agg(F.min("low"), F.max("high"), F.min("least")).orderBy("d").collect()
    # a dimension that some task never saw is missing in its vectors
    short = min((r[3] for r in found), default=0)
    zero = lambda r, v, pick: pick(v, 0) if r[0] >= short else v
    return np.array([zero(r, r[1], min) for r in found], np.int64), np.array([zero(r, r[2], max) for r in found], np.int64)


def _survivors(low: np.ndarray, high: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which of the vectors may be among the ``k`` best of one query; of equal scores the smaller id is better."""
    if len(low) <= k:
        return np.arange(len(low))
    kth = np.partition(low, len(low) - k)[len(low) - k]
    keep = np.flatnonzero(high >= kth)
    tied = np.sort(ids[low == kth])
    last = tied[k - 1 - np.count_nonzero(low > kth)]
    return keep[(high[keep] > kth) | (ids[keep] <= last)]


def _bounded(file: DataFrame, asked: DataFrame, cells: Cells, k: int, block: int) -> DataFrame:
    """(qid, did, least, low, high) of the vectors that may be among the ``k`` best of their block."""
    spark, width = file.sparkSession, cells.width
    blocks, groups = -(-file.count() // block), -(-asked.count() // QUERIES)
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(max(1, n))).cast("int")
    left = store(file.groupBy(deal("did", blocks).alias("block")).agg(F.collect_list(F.struct("did", "least", "cells")).alias("v")), "vafile-blocks")
    right = store(asked.groupBy(deal("qid", groups).alias("group")).agg(F.collect_list(F.struct("qid", "x")).alias("q")), "vafile-queries")
    units = spark.range(blocks).select(F.col("id").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(max(0, groups - 1)))).alias("group"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                v, q = batch.column(0)[i].values, batch.column(1)[i].values
                dids, least = (v.field(j).to_numpy(zero_copy_only=False) for j in (0, 1))
                have = np.frombuffer(b"".join(v.field(2).to_pylist()), np.uint8).reshape(-1, width)
                qids, x = q.field(0).to_numpy(zero_copy_only=False), _padded(q.field(1), width)
                for at in range(0, len(x), _STEP):
                    low, high = cells.bounds(have, x[at : at + _STEP])
                    kept = [_survivors(low[:, j], high[:, j], least, k) for j in range(low.shape[1])]
                    row = np.concatenate(kept)
                    col = np.repeat(np.arange(len(kept)), [len(r) for r in kept])
                    cols = (qids[at + col], dids[row], least[row], np.floor(low[row, col]), np.ceil(high[row, col]))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["qid", "did", "least", "low", "high"])

    units = units.join(right, "group").join(left, "block").select("v", "q")
    return units.mapInArrow(scan, "qid long, did long, least long, low double, high double")


def _kth(found: DataFrame, value: str, k: int) -> DataFrame:
    """(qid, kth, last): the ``k``-th best value of each query and the id there; nothing where there are fewer."""
    order = Window.partitionBy("qid").orderBy(F.col(value).desc(), "least")
    ranked = found.select("qid", value, "least", F.row_number().over(order).alias("place")).where(F.col("place") <= k)
    return ranked.where(F.col("place") == k).select("qid", F.col(value).alias("kth"), F.col("least").alias("last"))


def _open(found: DataFrame, kth: DataFrame) -> DataFrame:
    """The rows of ``found`` that the ``k``-th best does not rule out."""
    able = F.col("kth").isNull() | (F.col("high") > F.col("kth")) | ((F.col("high") == F.col("kth")) & (F.col("least") <= F.col("last")))
    return found.join(kth, "qid", "left").where(able).select(found.columns)


def top_k(vectors: DataFrame, asked: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """The ``k`` best other rows for every row where ``asked`` holds.

    Components become floor(scale x); the score is their inner product, a long.
    Returns (query_id, rank from 1, vec_id, score), ties to the smaller id, all
    rows if there are fewer than ``k``. Null vectors and vectors with null or
    non-finite components take no part. Rows are told apart by themselves: a
    row that shares the id or the vector of a query row is a candidate like any
    other. A null id is never asked; as a candidate it comes after the others
    of its score. Vectors shorter than the longest count as zeros at their end.
    A score beyond 64 bits is an error. An empty table has an empty result;
    other columns are not read.
    """
    rows = vectors.where(finite(F.col(vector_col))).select(
        F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("id"), whole(F.col(vector_col), scale).alias("x"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = store(rows, "vafile-rows")

    # a query's own row may be among the best, so one more is looked for
    more = k + 1
    order = Window.partitionBy("x").orderBy(F.col("id").asc_nulls_last(), "key")
    first = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= more)
    distinct = first.groupBy("x").agg(F.sort_array(F.collect_list(F.struct("n", "id", "key"))).alias("members"))
    distinct = distinct.select(F.monotonically_increasing_id().alias("did"), "x", "members", F.coalesce(F.col("members")[0]["id"], F.lit(_NO_ID)).alias("least"))
    distinct = store(distinct, "vafile-vectors")
    queries = store(rows.where("asked").select("x").distinct().select(F.monotonically_increasing_id().alias("qid"), "x"), "vafile-asked")

    low, high = _extremes(distinct)
    width = len(low)
    picked = distinct.orderBy(F.xxhash64("did"), "did").limit(max(cells, SAMPLE // max(1, width))).select("x").toArrow()
    ends = Cells(_padded(picked.column(0).combine_chunks(), width) if picked.num_rows else np.zeros((0, width), np.int64), low, high, cells)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = ends.of(_padded(batch.column(2), width))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in made], pa.binary())], names=["did", "least", "cells"])

    file = store(distinct.select("did", "least", "x").mapInArrow(approximate, "did long, least long, cells binary"), "vafile-file")
    bounds = store(_bounded(file, queries, ends, more, block), "vafile-bounds")
    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.col("high").desc(), "least", "did"))
    left = store(_open(bounds, _kth(bounds, "low", more)).withColumn("place", place), "vafile-order")

    product = F.aggregate(F.zip_with("x", "qx", lambda a, b: F.coalesce(a * b, F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda s, v: s + v)
    exact, upto = None, 4 * more
    while exact is None or not left.isEmpty():
        now = left.where(F.col("place") <= upto).select("qid", "did")
        read = now.join(distinct, "did").join(queries.select("qid", F.col("x").alias("qx")), "qid")
        scored = store(read.select("qid", product.alias("score"), "least", "members"), "vafile-exact")
        exact = scored if exact is None else exact.union(scored)
        left = store(_open(left.where(F.col("place") > upto), _kth(exact, "score", more)), "vafile-order")
        upto *= 4

    each = exact.select("qid", "score", F.explode("members").alias("m")).select("qid", "score", "m.id", "m.key")
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "key")
    best = each.withColumn("n", F.row_number().over(order)).where(F.col("n") <= more)
    best = best.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("n", "id", "key", "score"))).alias("best"))
    best = best.join(queries, "qid").select("x", "best", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    ask = rows.where("asked").select(F.col("key").alias("own"), F.col("id").alias("query_id"), "x", F.pmod(F.xxhash64("key"), F.lit(_SALTS)).cast("int").alias("salt"))
    other = F.slice(F.filter("best", lambda b: b["key"] != F.col("own")), 1, k)
    out = ask.join(best, ["x", "salt"]).select("query_id", F.posexplode(other).alias("pos", "b"))
    return out.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("b.id").alias("vec_id"), "b.score")
