"""Session builder and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the settings the library relies on.

    Everything that depends on the cluster (memory, shuffle partitions, split size) stays with
    spark-submit or ``conf``; only semantics and adaptive execution are pinned here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once per Spark context."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="millrace-code-"), "millrace")
    context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
    _shipped.add(context.applicationId)


_shipped: set[str] = set()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder.

    The cluster names that folder in ``spark.checkpoint.dir``. Where nothing is set, only a session whose driver runs every
    task itself may use a temporary folder; on a cluster that folder would be another one on each machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="millrace-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(_own(spark, base), f"{label}-{uuid.uuid4().hex}")


def _own(spark: SparkSession, base: str) -> str:
    """One folder per application below the shared one; it goes when the driver's JVM ends."""
    key = spark.sparkContext.applicationId, base
    if key not in _folders:
        path = os.path.join(base, f"millrace-{uuid.uuid4().hex}")
        context = spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(context._jsc.hadoopConfiguration())
        system.mkdirs(folder)
        system.deleteOnExit(folder)
        _folders[key] = path
    return _folders[key]


_folders: dict[tuple[str, str], str] = {}


def settle(df, label: str):
    """Write a DataFrame to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
