"""Spark session and shared-folder helpers."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sentsift") -> SparkSession:
    """Session with AQE on and the UI off.

    On a cluster the master and the checkpoint folder come from the launcher;
    locally ``local[$SENTSIFT_CPUS]`` (default all cores) is used.
    """
    cpus = os.environ.get("SENTSIFT_CPUS", "*")
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Text rows multiply into sentences and tokens: 64 MB input splits and
        # 64 MB shuffle partitions keep a task's working set moderate.
        .config("spark.sql.files.maxPartitionBytes", "64m")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SENTSIFT_DRIVER_MEMORY", "16g"))
    )
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or f"local[{cpus}]")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Uses ``spark.checkpoint.dir`` when the cluster names one; only when it is
    unset and all runs in one process (tests, a laptop) a fresh local folder is
    created. On a cluster a missing setting is an error: other machines do not
    see a folder of this one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all machines share")
        d = tempfile.mkdtemp(prefix="sentsift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def release_shuffles(spark: SparkSession) -> None:
    """Let the driver collect finished plans, so that their shuffle files leave the executors' disks."""
    gc.collect()
    spark._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sentsift`` importable in executor Python workers (like ``--py-files``).

    Operators whose tasks run Python call this once per SparkContext. In local
    mode the package is zipped on the driver and distributed by Spark; on a
    cluster it is expected from ``--py-files`` or the executor environment.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    shipped = spark.conf.get("spark.submit.pyFiles", "") or ""
    if "sentsift" in shipped or not sc.master.startswith("local"):
        # On a cluster the launcher ships the package (spark-submit --py-files
        # sentsift.zip) or it is installed on the executors.
        _SHIPPED.add(sc.applicationId)
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="sentsift-pkg-")
    archive = shutil.make_archive(os.path.join(out, "sentsift"), "zip", os.path.dirname(pkg), "sentsift")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
