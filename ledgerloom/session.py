"""Session and scratch-space helpers.

Everything that writes (layouts, copies, published versions) writes below the
shared folder named by ``spark.checkpoint.dir``. A cluster sets it; only when it
is unset (local tests) do we pick a fresh folder ourselves.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_ROOT: dict[int, str] = {}


def build_session(cpus: str | int = "*", shuffle_partitions: int = 8,
                  app_name: str = "ledgerloom") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) sessions have no local context
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None and sc.getCheckpointDir():
        root = sc.getCheckpointDir()  # set with setCheckpointDir rather than the conf key
    if not root:
        master = spark.conf.get("spark.master", "unknown")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares; "
                               "a machine-local folder only works in local mode")
        root = _LOCAL_ROOT.get(id(spark))
        if root is None:
            root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
            _LOCAL_ROOT[id(spark)] = root
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root.rstrip("/") + "/checkpoints")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root for one call's output."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/ledgerloom/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """A database or table name that does not collide between calls."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


# Target bytes per shuffle partition and per scan split.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
SCAN_SPLIT_BYTES = 512 * 1024 * 1024


def cluster_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of Parquet on ``total_cores``.

    Shuffle partitions: enough for ~256 MB each (so a task's share of a
    shuffle fits executor memory and spills little), and at least three waves
    of tasks; AQE then coalesces small ones and splits skewed ones. Scans
    split at 512 MB. Static broadcasts stay at Spark's 10 MB default; the
    operators here never hint a broadcast of a side whose size is unchecked.
    """
    partitions = max(3 * total_cores, -(-input_bytes // SHUFFLE_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(SCAN_SPLIT_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(SHUFFLE_PARTITION_BYTES),
        "spark.sql.parquet.compression.codec": "zstd",
    }


_CONF_LOCK = threading.RLock()


@contextmanager
def partition_overwrite(spark: SparkSession, mode: str):
    """Run catalog writes with ``spark.sql.sources.partitionOverwriteMode``
    set to ``mode`` ("static" replaces the whole table, "dynamic" only the
    partitions written). For catalog tables the session setting is the way to
    choose: a write option would be stored with the table and override every
    later insert. Writes to plain paths pass the option per write instead."""
    key = "spark.sql.sources.partitionOverwriteMode"
    with _CONF_LOCK:
        prev = spark.conf.get(key)
        spark.conf.set(key, mode)
        try:
            yield
        finally:
            spark.conf.set(key, prev)
