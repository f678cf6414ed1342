"""Session settings and the shared scratch folder.

Library functions never build a session; they take the caller's. This module
only offers a builder for tests, the bench and the job CLI, plus the lookup of
the shared folder that lineage cuts are written to.
"""

from __future__ import annotations

import contextvars
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours carries. Time zone: the epoch of a plain
# TIMESTAMP depends on it, so it is pinned. AQE re-plans joins at runtime
# (broadcast only when the measured side is small, skew splitting, partition
# coalescing).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # fits of a grid run beside each other, each in a pool of its own
    "spark.scheduler.mode": "FAIR",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.kryoserializer.buffer.max": "1g",
    # checkpoint files of lineage cuts are removed once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Extra settings for a single-machine session only.
LOCAL_CONF = {
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(
    input_bytes: float,
    executor_cores_total: int = 8000,
    partition_bytes: int = 256 << 20,
    exchanged_share: float = 0.25,
) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of listens.

    Shuffles start with one partition per ``partition_bytes`` of what an
    exchange carries (``exchanged_share`` of the input: pairs and counts, not
    raw rows), from two to eight per core: a reducer that holds more spills,
    while the blocks of an exchange (map tasks times partitions) and the
    driver's record of them stay bounded by the cores. AQE coalesces small
    partitions up to the advisory size and splits skewed join partitions over
    it and five times the median; file splits are sized alike.
    """
    wanted = int(exchanged_share * input_bytes // partition_bytes) + 1
    partitions = min(max(2 * executor_cores_total, wanted), 8 * executor_cores_total)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }


def build_session(
    master: str | None = None,
    app_name: str = "encore",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the settings above.

    ``master`` of ``None`` leaves the master to ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if master and master.startswith("local"):
        settings.update(LOCAL_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM: ``local`` or ``local[...]``, not ``local-cluster[...]``, which has executors of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for lineage cuts, as the cluster names it.

    The folder comes from ``spark.checkpoint.dir`` (or an already set
    checkpoint directory of the context). Only a local session may fall back
    to a fresh folder of its own; on a cluster an unset folder is an error,
    because a machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for checkpoints"
            )
        configured = tempfile.mkdtemp(prefix="encore-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# Paths handed out inside the innermost scope (``encore.sources.parquet.scratch_scope``).
SCRATCH: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table.

    Inside a scratch scope the path belongs to that scope and is freed with it.
    """
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root.rstrip("/"), "tables", f"{name}-{uuid.uuid4().hex}")
    scope = SCRATCH.get()
    if scope is not None:
        scope.append(path)
    return path


def kept_path(spark: SparkSession, name: str) -> str:
    """The path of a table that outlives queries and sessions, such as a fitted model."""
    return os.path.join(ensure_checkpoint_root(spark), "kept", name)


def ensure_checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names; a context's own checkpoint folder lies below it."""
    own = ensure_checkpoint_dir(spark).rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else os.path.dirname(own)
