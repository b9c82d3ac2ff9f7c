"""Spark session and shared-storage helpers.

Everything here is configuration a Spark user would set: AQE on (runtime
coalescing and skew-join splitting), UTC session time zone, ANSI on, the UI
off, Arrow for pandas batches.  The scratch area for intermediate tables is
derived from ``spark.checkpoint.dir`` so that on a cluster it lives in the
shared folder the cluster names; a local default is set only when the
setting is absent (tests, local runs).
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


CLUSTER_SETTINGS = {
    # Start with many shuffle partitions and let AQE coalesce them to
    # ~advisoryPartitionSizeInBytes each: the right count at 100 TB is
    # thousands, at a test scale it is a handful.
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.minPartitionNum": "1",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Runtime broadcast only below a measured size (AQE uses the actual
    # shuffle statistics, not estimates).
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    # Survive executor loss without recomputing whole stages.
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "fiscalflow",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the library assumes."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or os.environ.get("SPARK_MASTER", f"local[{cpus}]")
    parts = shuffle_partitions or int(os.environ.get("SHUFFLE_PARTITIONS", cpus))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Workbooks and archives go through Arrow batches one file at a time.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application.

    Functions run in tasks are pickled by reference, so a worker must be able
    to import ``fiscalflow`` whatever folder or PYTHONPATH it starts with.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(here):  # else the package is itself imported from a shipped archive
        base = os.path.join(tempfile.mkdtemp(prefix="fiscalflow-src-"), "fiscalflow_src")
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(here), os.path.basename(here)))
    _shipped.add(app)


_local_root: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """The configured shared folder (``spark.checkpoint.dir``).

    Read from the session, never overridden.  Only when no setting exists
    (local runs, tests) is a temporary folder used, remembered for the
    process; ``spark.checkpoint.dir`` is a core setting a running session
    cannot change, so it is not written back.
    """
    global _local_root
    current = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if current:
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that all machines share; a local temporary folder is used with a local[...] master only")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="fiscalflow-ckpt-")
    return _local_root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables and ``checkpoint()``.

    The SparkContext's checkpoint folder is set once, under the configured
    root (Spark adds a per-application sub-folder); later calls reuse it.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(spark))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, spark: SparkSession, label: str) -> DataFrame:
    """Cut lineage by writing a Parquet table in the shared folder.

    Survives executor loss (the table is on shared storage), unlike
    ``localCheckpoint``; cheaper to re-read than ``checkpoint()`` because the
    reader gets column pruning and filter pushdown.
    """
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given test tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
