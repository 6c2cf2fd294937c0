"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Zoneless times are parsed and compared in UTC. Adaptive execution stays on: it
# coalesces small shuffle partitions, splits skewed ones, and picks a broadcast
# join only from sizes it has measured.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Noting the Python call site of every column costs several driver round trips each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Stream state on local disk with change logs, so that it can outgrow memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def sized_settings(shuffle_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle settings for a job that shuffles about ``shuffle_bytes``: enough initial
    partitions that each fits a task's memory, which adaptive execution merges again
    where a shuffle turns out smaller."""
    partitions = max(2 * cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def get_session(
    app_name: str = "macrotide", master: str | None = None, *, shuffle_bytes: int | None = None, cores: int | None = None, **extra: str
) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for dots.

    ``shuffle_bytes`` is what the largest shuffle of the job moves (the input's size is a safe
    guess) and sets the number of partitions. A session off a local master needs it, or
    ``spark.sql.shuffle.partitions`` itself: Spark's own 200 would make tasks of terabytes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    extra = {name.replace("__", "."): value for name, value in extra.items()}
    settings = dict(SETTINGS)
    if shuffle_bytes is not None:
        settings |= sized_settings(shuffle_bytes, cores or 8)
    elif master and not is_local(master) and "spark.sql.shuffle.partitions" not in extra:
        raise ValueError("give shuffle_bytes or spark.sql.shuffle.partitions for a session on a cluster")
    for name, value in settings.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def object_store_settings(
    endpoint: str, access_key: str, secret_key: str, *, path_style: bool = True, tls: bool = False
) -> dict[str, str]:
    """``fs.s3a`` settings for an S3-compatible store; give them to the session
    builder, then use ``s3a://`` paths with every reader and writer."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """Folder that all executors share, as the cluster names it in
    ``spark.checkpoint.dir``. Where that is unset a temporary folder serves a local master; on
    a cluster each executor would write to its own disk, so there it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not is_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="macrotide-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{checkpoint_root(spark)}/macrotide-{label}-{uuid.uuid4().hex}"


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the place where the driver has it. Where
    executors have no such place, install the package there or pass it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
