"""Session defaults and the shared scratch location.

Nothing here starts a server: the web UI and the console progress bar are off.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on for correct results (zone-free dates, ANSI casts)
# and for adaptive planning at any scale.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_settings(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.25,
                   target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a run over ``input_bytes`` of Parquet on ``total_cores`` executor cores.

    * Scan splits of ``target_partition_bytes`` (256 MB) keep task count and per-task
      memory in check (100 TB -> ~400k scan tasks, a few waves on 8,000 cores).
    * The initial shuffle partition count assumes the largest shuffle carries
      ``shuffle_fraction`` of the input (facts are pre-aggregated before they
      shuffle) at ~256 MB per partition, at least twice the cores; AQE then coalesces
      toward the 128 MB advisory size and splits skewed partitions above 512 MB.
    * Broadcasts are only planned for sides under 64 MB (size-checked dimensions are
      far below that).
    """
    shuffle_bytes = max(int(input_bytes * shuffle_fraction), 1)
    partitions = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "abacus", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster pass ``master=None`` and let the launcher decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small partitions anyway).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name it (reliable storage every executor can reach). Only a
    local-mode session without the setting gets a fresh temporary folder, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for this cluster")
    root = tempfile.mkdtemp(prefix="abacus-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
