"""SparkSession helpers: a local builder for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "shelfcast", heap: str = "16g") -> SparkSession:
    """Session for tests and the local bench, with a JVM of `heap`. A cluster job passes its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", heap)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for `checkpoint()` / written intermediates.

    `spark.checkpoint.dir` of the session is used as it is. Only a purely local session
    (one process, so its temp folder is shared by definition) may go without the setting;
    on a cluster a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="shelfcast-ckpt-", dir=os.environ.get("SHELFCAST_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; the session's scratch goes when its JVM ends."""
    sc = spark.sparkContext
    top = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shelfcast-{sc.applicationId}"
    folder = sc._jvm.org.apache.hadoop.fs.Path(top)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return f"{top}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "stage"):
    """Write `df` once as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like `checkpoint()` but computes the plan a single time (an eager
    RDD checkpoint runs the plan twice unless it is cached). The files survive the loss
    of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*frames) -> None:
    """Delete the files of frames that `materialize` wrote and nothing reads any more."""
    for frame in frames:
        if path := getattr(frame, "_scratch", None):
            sc = frame.sparkSession.sparkContext
            folder = sc._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_shelfcast_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="shelfcast-zip-")) / "shelfcast.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, str(Path(root.name) / source.relative_to(root)))
    sc.addPyFile(str(target))
    sc._shelfcast_shipped = True
