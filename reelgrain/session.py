"""Session construction and the one place that decides where lineage is cut."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "reelgrain", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session with the defaults that the operators are tuned for; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "8g"),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    return SparkSession.builder.appName(app).master(f"local[{cpus}]").config(map=settings).getOrCreate()


def file_system(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system that holds a path, and the path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    """Let the driver's file system delete a folder when the application ends."""
    files, where = file_system(spark, path)
    files.deleteOnExit(where)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Where that is unset a temporary folder is taken, if driver and executors are one machine, as in
    tests; elsewhere it is an error. What is written there is deleted when the application ends.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named is None and current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="reelgrain-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if current is None:
        context.setCheckpointDir(named)
        _drop_at_exit(spark, context.getCheckpointDir())  # a folder below the named one, of this application alone
    return named or current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call uses; it is deleted when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _drop_at_exit(spark, path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and keep in the shared folder, so that later reads survive the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
