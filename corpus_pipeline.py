"""The corpus pipeline: quality, near-duplicates, benchmark passages, mix, token files.

Each stage works on all rows that the one before it kept, which are written as
Parquet and read again in between. ``ORACLE_SQL`` is None: neither a fitted
classifier nor XXH64 fingerprints can be said in SQL; the tests hold each stage
against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialflow.llm import decontam, mixing, planes, quality, simhash
from vialflow.llm.queries import END_ID, RADIUS, SHINGLE, THRESHOLD, vocabulary
from vialflow.session import scratch_path


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    return quality.accepted(docs, model, threshold=THRESHOLD)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, that of the smallest id, of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs, shingle=SHINGLE, radius=RADIUS, repeats=False)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources says."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and list the documents in them."""
    path = scratch_path(spark, "pipeline-planes")
    planes.write_ids(docs, path, vocabulary(), END_ID)
    return planes.read_ids(spark, path, digest=True)


STAGES = [
    ("quality", accept),
    ("simhash", keep_one),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
