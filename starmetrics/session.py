"""Spark session helpers.

The library never creates a cluster session by itself inside query code;
``get_session`` is for tests, the bench and command-line use.  Settings are
the ones that matter at scale: AQE (runtime coalescing, skew-join split,
broadcast conversion on *measured* sizes), UTC session time and ANSI mode.
"""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "starmetrics") -> SparkSession:
    master = master or os.environ.get("SPARK_MASTER", "local[*]")
    parts = shuffle_partitions or int(os.environ.get("STARMETRICS_SHUFFLE_PARTITIONS", "8"))
    b = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STARMETRICS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder and
    is used as is.  When it is unset, a local master (tests) gets a scratch folder
    and any other master an error.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: the server owns the checkpoint folder)
        sc = None
    if not cur and sc is not None:
        cur = sc.getCheckpointDir()
    if not cur:
        # unset: local runs and tests only; on a cluster every node would get a folder of its own
        if sc is None or not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cur = tempfile.mkdtemp(prefix="starmetrics-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", cur)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(cur)
    return cur


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def release(spark: SparkSession) -> None:
    """After a table is written: let go what its plan held.  Shuffle files and cached blocks stay on the executors' disks
    until the driver's JVM collects the objects that stand for them, which may be long after their last reader; the
    collection also gives back heap that the plans of earlier steps had grown."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: the server collects its garbage)
        return
    gc.collect()  # Python's handles of JVM objects first
    with contextlib.suppress(Py4JError):  # a plan hangs on the event of its end until the listeners get a later one: of a job without tasks
        sc._jsc.emptyRDD().count()
        sc._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    sc._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate table that has no reader left."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
