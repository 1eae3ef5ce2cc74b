"""Session helpers: a local builder for tests and bench, and shared-scratch lookup.

Library functions never change session configuration; only ``local_session``
(tests, bench) does. On a cluster the user's session is used as it is.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with AQE on, the UI off and the session zone pinned to UTC."""
    parts = shuffle_partitions or (os.cpu_count() or 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("snapmart")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # test-sized data: let AQE keep a few parallel tasks instead of coalescing to one
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or else by the context's checkpoint folder.

    A local session without either gets a temporary folder of its own. On a cluster a machine-local
    folder would be lost to the other machines, so there an unset folder is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="snapmart-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/snapmart/{name}-{uuid.uuid4().hex}"


# Settings for a large cluster (about 1,000 executors reading about 100 TB). The library never sets
# these itself; pass them to the session builder (``.config(map=CLUSTER_CONF)``) or spark-submit.
CLUSTER_CONF = {
    # AQE re-plans from measured sizes: coalesces small shuffle partitions, splits skewed join
    # partitions, and turns a sort-merge join into a broadcast only when the measured side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    # Initial shuffle width: 8,000 x 256 MB covers a 2 TB shuffle stage without spilling tasks;
    # AQE coalesces it down for the small stages (dimension, checks).
    "spark.sql.shuffle.partitions": "8000",
    # Scan splits of 512 MB: 100 TB gives about 200k tasks, about 25 waves over 8,000 cores.
    "spark.sql.files.maxPartitionBytes": "512m",
    # Static plans broadcast only below 64 MB of estimated size; the runtime (measured) threshold is
    # the one that matters for the dimension join.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
