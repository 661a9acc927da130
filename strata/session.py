"""Session construction and the shared work folder.

The work folder holds tables that cut lineage or stage intermediate results.
It is always taken from the cluster's ``spark.checkpoint.dir`` so every
executor sees the same files. Only a local-mode session without that setting
(tests, laptops) gets a folder created here.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. Spark broadcasts a join side whose estimated
# size (of a scan: its files) is under 10 MB, its default; AQE does so too for a
# side that turns out that small at runtime, and splits skewed shuffle
# partitions. ANSI mode makes strict casts fail loudly.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and size ``shuffle_partitions`` to the
    data (AQE coalesces small ones at runtime); in tests use ``local[*]`` and 8.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def cluster_conf(shuffle_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a large cluster, from an estimate of the largest shuffle.

    The initial shuffle partition count is chosen so that each partition of the
    largest exchange is about ``partition_bytes``; AQE then coalesces the small
    ones at runtime toward the same advisory size, and splits partitions of a
    skewed join side above four times it. Scan splits use the same size, so a
    task's input fits comfortably in executor memory.
    """
    partitions = max(200, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    current = spark.sparkContext.getCheckpointDir()
    return current or None


def work_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    A local-mode session without the setting gets a fresh folder (and the
    checkpoint dir is set to it); any other session without it is an error,
    because a machine-local folder is invisible to the other executors.
    """
    configured = _configured_checkpoint_dir(spark)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, S3, ...) that every executor can read and write"
        )
    folder = tempfile.mkdtemp(prefix="strata-work-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the work folder."""
    return f"{work_root(spark)}/strata/{name}-{uuid.uuid4().hex}"
