"""Session construction and the shared scratch location.

On a cluster the scratch location is the folder named by
``spark.checkpoint.dir`` (shared storage). Only when that setting is
absent -- local runs and tests -- do we create one of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "ventana",
              shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(_DEFAULTS)
    if master and master.startswith("local"):
        # local runs only: one JVM holds driver and executors (the 1g default
        # is too small for tree ensembles); on a cluster the deployment sets it
        settings["spark.driver.memory"] = "4g"
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Unset on a ``local`` master (tests, notebooks): a folder of our own is
    created. Unset on a cluster: an error, since a machine-local folder would
    be invisible to the other executors.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="ventana-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder (a URI or path Spark can open) of the shared checkpoint location."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name or 'work'}-{uuid.uuid4().hex[:12]}"


def materialise(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage in a way that survives lost executors. Returns (frame, path)."""
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`work_dir` once nothing reads it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
