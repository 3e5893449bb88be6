"""Session helpers: local test session, shared scratch folder.

Cluster sessions come configured from outside; the helpers here only fill
in settings that are unset, so a cluster's own values always win.
"""

from __future__ import annotations

import logging
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Settings every plan in this package relies on. AQE re-plans joins from the
# real shuffle sizes (broadcast conversion, skew split, partition coalescing).
REQUIRED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Starting points for a large cluster (hundreds of executors, tens of TB per
# job). Shuffle partitions start high and AQE coalesces them to ~256 MB each;
# skewed partitions over 1 GB (and 5x the median) are split; dimension
# broadcasts stay well under executor memory.
CLUSTER_CONF = {
    **REQUIRED_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "vialflow.broadcast.maxBytes": str(256 * 1024 * 1024),
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Set :data:`CLUSTER_CONF` keys that the session has not set explicitly."""
    explicit = spark.conf.getAll
    for key, value in {**CLUSTER_CONF, **(overrides or {})}.items():
        if key not in explicit:
            spark.conf.set(key, value)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vialflow") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage; it is
    read, never replaced. Only a local-mode session without one gets a fresh
    folder of its own (the test situation).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) so lineage cuts and scratch tables survive executor loss"
        )
    folder = tempfile.mkdtemp(prefix="vialflow-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table (any Hadoop-compatible store); without access to the store its lifecycle rules will."""
    try:
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)
    except Exception as exc:  # noqa: BLE001 - scratch only: what is published is moved and removed by sinks.publish
        log.warning("scratch table %s stays: %s", path, exc)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once.

    Workers import it by name; a driver that put the repository on its own
    ``sys.path`` has not told them where it is.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="vialflow-"), "vialflow")
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
    _SHIPPED.add(sc.applicationId)
