"""Session helpers: a tuned builder and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Sizing for a large cluster (hundreds of executors, ~100 TB of input):
# start with many shuffle partitions and let AQE coalesce them towards the
# advisory size, so a 100 TB shuffle still has ~128 MB partitions that fit in
# executor memory; split scans at 256 MB; let AQE split skewed join
# partitions; keep Arrow batches moderate for wide text rows.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
}


def get_spark(master: str | None = None, app: str = "corpusprep",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE, Arrow and UTC; tests use ``local[*]``. A non-local
    master gets ``CLUSTER_CONF`` (explicit settings of the caller win)."""
    cpus = os.environ.get("BENCH_CPUS")
    master = master or (f"local[{cpus}]" if cpus else "local[*]")
    parts = shuffle_partitions or int(cpus or os.cpu_count() or 8)
    builder = SparkSession.builder.master(master).appName(app)
    if not master.startswith("local"):
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
        parts = shuffle_partitions or int(CLUSTER_CONF["spark.sql.shuffle.partitions"])
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.python.filterPushdown.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a shared file system such as
    HDFS or an object store). Only a local-mode session without the setting
    gets a private folder, as in tests.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        path = tempfile.mkdtemp(prefix="corpusprep-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
