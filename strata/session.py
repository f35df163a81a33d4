"""Session defaults and the shared working folder.

Everything that has to outlive a task (streaming checkpoints, landed files,
state tables, cut lineage) goes under the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is missing (local runs and
tests) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every job in the package relies on.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "strata",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's own."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the package's SQL defaults on an existing session (idempotent)."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="strata-ckpt-")  # one machine: driver and executor are one process
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh sub-folder of the shared working area (never a machine-local tmp on a cluster)."""
    root = ensure_checkpoint_dir(spark)
    # Spark may return the checkpoint dir with an added UUID sub-folder; keep it.
    name = os.path.join(*parts) if parts else "work"
    if unique:
        name = f"{name}-{uuid.uuid4().hex[:12]}"
    return root.rstrip("/") + "/strata/" + name


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists (Hadoop FileSystem of the path's scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the given files/folders from file-system metadata (no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total


def size_for_input(spark: SparkSession, paths: list[str], partition_mb: int = 128,
                   min_partitions: int | None = None) -> int:
    """Size shuffles and scan splits for the data at hand so tasks fit executor memory.

    Initial shuffle partitions = input bytes / ``partition_mb`` (AQE then coalesces
    small ones to the same advisory size and splits skewed ones); scan splits are
    capped at twice that. Returns the partition count that was set.
    """
    floor = min_partitions or spark.sparkContext.defaultParallelism
    n = max(floor, -(-input_bytes(spark, paths) // (partition_mb * 1024 * 1024)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{partition_mb}m")
    spark.conf.set("spark.sql.files.maxPartitionBytes", f"{2 * partition_mb}m")
    return n


def size_unless_set(spark: SparkSession, sf_dir: str) -> None:
    """Size shuffles from the bytes of the input folder, unless the session has a partition count of its own."""
    if spark.conf.get("spark.sql.shuffle.partitions") == "200":  # Spark's default
        n = max(200, -(-input_bytes(spark, [sf_dir]) // (128 * 1024 * 1024)))
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
