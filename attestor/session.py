"""One place that builds a session with the settings the engine expects."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "attestor", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # Checkpoints go with the plans that read them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``; only a session on one machine may go without it."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return folder or f"file://{tempfile.gettempdir()}/attestor-checkpoints"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the session's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)  # only what exists is deleted on exit
    files.deleteOnExit(target)
    return path


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder: later plans start there and survive the loss of executors."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def grows(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the documents: it is shuffled, never sent through the driver.

    Texts made from a small file look small to the planner, however many they are.
    """
    return df.hint("merge")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers, once per application.

    Nothing happens where the package's folder is on PYTHONPATH already, as workers inherit it.
    """
    import os
    import shutil
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    known = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    app = spark.sparkContext.applicationId
    if str(root) in known or app in _SHIPPED:
        return spark
    folder = os.path.realpath(tempfile.mkdtemp())
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/attestor", "zip", root, "attestor"))
    _SHIPPED.add(app)
    return spark
