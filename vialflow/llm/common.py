"""Helpers shared by the operators: written scratch tables, words, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialflow.session import scratch_path

#: Fixed value: words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back.

    Cuts the lineage with files that every executor sees, so that a lost
    executor costs a re-read and never a re-computation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold few rows: whole texts are long, and a worker holds a batch more than once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) == 10_000:  # the default, not a choice of the session's owner
        spark.conf.set(key, "1000")


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Let the jobs run inside this block hand Python at most ``rows`` rows at once; the session's own, smaller choice holds."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame) -> DataFrame:
    """Label each node of ``edges`` (two long columns) with the least node of its component.

    Returns (node, root) for every node that has an edge to another one. Each
    round hooks every node to its least neighbour, jumps pointers four levels
    and contracts the edges, so a chain of n nodes takes O(log n) rounds.
    Every table is written between the steps: joins then read both sides
    through shuffles of their own, which lets Spark split a hot node.
    """
    a, b = edges.columns
    left = store(_undirected(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "cc-edges")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        hook = store(hook.select("node", F.least("node", "m").alias("root")), "cc-hook")
        for _ in range(2):
            hook = store(_compose(hook, hook), "cc-jump")
        rounds.append(hook)
        left = store(_undirected(_relabel(_relabel(left, hook, "a"), hook, "b")), "cc-edges")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds[0]
    for later in rounds[1:]:
        out = _compose(out, later)
    return store(out, "cc-roots") if len(rounds) > 1 else out


def _undirected(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _compose(first: DataFrame, then: DataFrame) -> DataFrame:
    t = then.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
    joined = first.join(t, first["root"] == t["n2"], "left")
    return joined.select("node", F.coalesce("r2", "root").alias("root"))


def _relabel(edges: DataFrame, labels: DataFrame, end: str) -> DataFrame:
    joined = edges.join(labels, edges[end] == labels["node"])
    return joined.select(*[F.col("root").alias(c) if c == end else F.col(c) for c in ("a", "b")])
